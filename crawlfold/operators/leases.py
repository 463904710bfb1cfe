"""Lease history: a key may be leased again, and its older leases stay on record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from crawlfold.functions.timing import hundredths_of_seconds
from crawlfold.operators.skew import SEGMENT_ROWS, cut


def lease_id() -> Column:
    """Id of a lease: its key and its birth, which its key alone is not once the key is leased again."""
    return F.concat_ws("@", "proxy", F.date_format("birth_time", "yyyyMMddHHmmss.SSSSSS"))


def history(leases: DataFrame, segment_rows: int = SEGMENT_ROWS, order: tuple[str, ...] = ("seq",)) -> DataFrame:
    """Leases `(proxy, birth_time, ...)` with the moment the next one in `order` took their key.

    Adds superseded_at, is_current and stored_key: the plain key for the current lease, and
    the key with the hundredths of a second of the take-over for older ones.
    """
    segmented, any_hot = cut(leases, "proxy", list(order), segment_rows)
    inside = W.partitionBy("proxy", "seg").orderBy(*order)
    dated = segmented.withColumn("superseded_at", F.lead("birth_time").over(inside))
    if any_hot:
        firsts = (
            segmented.filter(F.col("seg") >= 0)
            .groupBy("proxy", "seg")
            .agg(F.min_by("birth_time", F.struct(*order)).alias("_first"))
        )
        across = W.partitionBy("proxy").orderBy("seg")
        following = firsts.select("proxy", "seg", F.lead("_first").over(across).alias("_next_first"))
        dated = (
            dated.join(following, ["proxy", "seg"], "left")
            .withColumn("superseded_at", F.coalesce("superseded_at", "_next_first"))
            .drop("_next_first")
        )
    dated = dated.drop("seg")
    hundredths = hundredths_of_seconds(F.col("superseded_at"))
    return dated.withColumns({
        "is_current": F.col("superseded_at").isNull(),
        "stored_key": F.concat_ws("_", F.col("proxy"), hundredths.cast("string")),
    })


def current(leases: DataFrame, segment_rows: int = SEGMENT_ROWS, order: tuple[str, ...] = ("seq",)) -> DataFrame:
    """Only the lease that holds its key now."""
    return history(leases, segment_rows, order).filter("is_current").drop("superseded_at", "is_current", "stored_key")
