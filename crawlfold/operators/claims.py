"""Work claims as an append-only event log, and the lock state folded from it."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlfold import params as P
from crawlfold.functions.timing import wall_clock
from crawlfold.operators import seeds, shops as shop_ops
from crawlfold.operators.ordering import numbered
from crawlfold.params import SITE, Site


# Ids that one task may merge.
MERGED_IDS = 10_000


def claim_batch(shops: DataFrame, n: int, *predicates: str, site: Site = SITE) -> DataFrame:
    """The `n` smallest claimable ids. One job claims them all, so no id goes out twice.

    Returns id, the claim code and the detail URL; append (id, code) with a time to the log.
    """
    ids = shop_ops.claimable(shops, *predicates)
    # A small batch is the merge of each task's n smallest; a large one is cut from a numbered order.
    taken = ids.orderBy("id").limit(n) if n <= MERGED_IDS else numbered(ids, ["id"], "_n").filter(F.col("_n") < n)
    return taken.select("id", F.lit(P.CLAIMED).alias("code"), seeds.detail_url(F.col("id"), site).alias("url"))


def lock_state(claims: DataFrame, as_of: dt.datetime | None = None,
               claim_ttl: dt.timedelta | None = None) -> DataFrame:
    """Latest code per id. With `claim_ttl`, claims older than that at `as_of` are free again."""
    # One order for claims and releases, whatever numbers their sources give: time, number, code.
    order = F.struct("ts", "seq", "code")
    latest = claims.groupBy("id").agg(F.max(order).alias("_last")).select(
        "id", F.col("_last.code").alias("code"), F.col("_last.ts").alias("since")
    )
    code = F.col("code")
    if claim_ttl is not None:
        if as_of is None:
            raise ValueError("claim_ttl needs as_of")
        expired = (code == P.CLAIMED) & (F.col("since") < wall_clock(as_of - claim_ttl))
        code = F.when(expired, P.FREE).otherwise(code)
    return latest.select("id", code.cast("int").alias("lock_"), "since")


def apply_locks(shops: DataFrame, locks: DataFrame) -> DataFrame:
    """Shop table with the lock codes of the log; shops without claims keep theirs."""
    latest = locks.select("id", F.col("lock_").alias("_lock"))
    return (
        shops.join(latest, "id", "left")
        .withColumn("lock_", F.coalesce("_lock", "lock_"))
        .drop("_lock")
    )


def release_codes(pages: DataFrame) -> DataFrame:
    """Release events of visited pages: fetched when usable, free again when blocked.

    Listing pages carry no shop id and release nothing. The log is ordered by time first; the
    fetch time in microseconds only stands for the arrival number.
    """
    code = F.when(F.col("status") == P.PAGE_OK, P.FETCHED).otherwise(P.FREE)
    shop_id = F.col("meta")["shopId"]
    return pages.filter(shop_id.isNotNull()).select(
        shop_id.alias("id"),
        F.unix_micros(F.col("fetched_at").cast("timestamp")).alias("seq"),
        F.col("fetched_at").alias("ts"),
        code.alias("code"),
    )


def requeue(attempts: DataFrame) -> DataFrame:
    """URLs whose latest attempt `(url, seq, status)` was blocked, with their block count.

    One aggregate replaces the anti join against fetched URLs and combines on the map side.
    """
    latest = attempts.groupBy("url").agg(
        F.max_by("status", "seq").alias("_status"),
        F.count_if(F.col("status") != P.PAGE_OK).alias("blocks"),
    )
    return latest.filter(F.col("_status") != P.PAGE_OK).select("url", "blocks")


def fetched_without_position(shops: DataFrame) -> DataFrame:
    """Shops released as fetched that still lack coordinates: nothing found, or not parsed."""
    return shops.filter(
        (F.col("lock_") == P.FETCHED) & (F.col("lon").isNull() | F.col("lat").isNull())
    ).select("id")
