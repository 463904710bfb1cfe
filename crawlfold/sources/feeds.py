"""Recorded JSON replies: lease feeds and probe replies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlfold import sinks
from crawlfold.schemas import LEASE_REPLY

# Order of the leases of a key.
ORDER = ("feed_id", "pos")


def _parsed(replies: DataFrame) -> DataFrame:
    return replies.withColumn("_r", F.from_json("body", LEASE_REPLY))


def leases(replies: DataFrame, lifetime_class: int = 1, scheme: str = "http") -> DataFrame:
    """Lease rows of all successful replies `(feed_id, status, received_at, body)`.

    `feed_id` and `pos`, the place in the reply, order the leases (`ORDER`, for `operators.leases`).
    An entry without an address or with a time that cannot be read is left to `lease_rejects`.
    """
    return _entries(replies).filter(F.col("_fault").isNull()).select(
        "feed_id",
        "pos",
        F.format_string("%s://%s:%s", F.lit(scheme), F.col("_d.ip"), F.col("_d.port")).alias("proxy"),
        F.col("_d.ip").alias("ip"),
        F.col("_d.port").alias("port"),
        F.lit(scheme).alias("scheme"),
        F.lit(lifetime_class).alias("lifetime_class"),
        F.col("received_at").alias("birth_time"),
        F.col("_d.expire_time").try_cast("timestamp_ntz").alias("expire_time"),
    )


def _entries(replies: DataFrame) -> DataFrame:
    """Entries of successful replies, with what is wrong with them."""
    good = _parsed(replies).filter((F.col("status") == 200) & F.col("_r.success"))
    rows = good.select("feed_id", "received_at", F.posexplode("_r.data").alias("pos", "_d"))
    fault = (
        F.when(F.col("_d.ip").isNull() | F.col("_d.port").isNull(), "no address")
        .when(F.col("_d.expire_time").try_cast("timestamp_ntz").isNull(), "no expiry")
    )
    return rows.withColumn("_fault", fault)


def append_leases(replies: DataFrame, log: str, batch_id: int, lifetime_class: int = 1) -> None:
    """Add the leases of a batch of replies to the lease log; a retry of the batch replaces it."""
    sinks.write_batch(leases(replies, lifetime_class), log, batch_id)


def lease_rejects(replies: DataFrame) -> DataFrame:
    """Replies that bring no lease: refused by the vendor, or not readable; and faulty entries of the others.

    Replies with another HTTP status than 200 say nothing about leases and are left out.
    """
    bad = _parsed(replies).filter(
        (F.col("status") == 200) & ~F.coalesce(F.col("_r.success"), F.lit(False))
    )
    reason = F.when(F.col("_r.success").isNull(), F.lit("malformed")).otherwise(F.lit("refused"))
    entries = _entries(replies).filter(F.col("_fault").isNotNull())
    return bad.select("feed_id", reason.alias("reason"), F.col("_r.msg").alias("msg")).unionByName(
        entries.select("feed_id", F.col("_fault").alias("reason"), F.to_json("_d").alias("msg")))


def probe_verdicts(replies: DataFrame, field: str = "origin") -> DataFrame:
    """Verdict per recorded probe `(probe_id, status, body)`.

    Status 200 is valid and shows the address seen by the probed site; no status means the
    connection failed and is invalid; any other status leaves the verdict open.
    """
    answered = F.col("status") == 200
    return replies.select(
        "probe_id",
        F.when(answered, True).when(F.col("status").isNull(), False).alias("valid"),
        F.when(answered, F.get_json_object("body", f"$.{field}")).alias("origin"),
    )
