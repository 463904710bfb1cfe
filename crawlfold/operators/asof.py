"""The last known value of a key at a moment: as-of attribution without a join.

Marks (what holds from a moment on) and events lie in one ordered stream per key, and the last mark is
carried forward. A key with L marks and N events costs L + N rows, where a join on the key costs L x N.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from crawlfold.operators.skew import SEGMENT_ROWS, cut


def carried(rows: DataFrame, key: str, order: list[str], value: str, name: str, segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """`rows` with the last `value` that is not NULL up to the row, in `order` within its key, as `name`.

    A hot key is cut into stretches by rank (`skew.cut`); a stretch starts with what the stretches before it
    carried out, one row each. Rows without a key are left out.
    """
    stretches, any_hot = cut(rows.filter(F.col(key).isNotNull()), key, order, segment_rows)
    so_far = W.partitionBy(key, "seg").orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    inside = stretches.withColumn(name, F.last(value, ignorenulls=True).over(so_far))
    if not any_hot:
        return inside.drop("seg")
    lasts = (
        stretches.filter((F.col("seg") >= 0) & F.col(value).isNotNull())
        .groupBy(key, "seg").agg(F.max_by(value, F.struct(*order)).alias("_last"))
    )
    # Stretches without a mark pass on what they were given.
    all_stretches = stretches.filter(F.col("seg") >= 0).select(key, "seg").distinct().join(lasts, [key, "seg"], "left")
    before = W.partitionBy(key).orderBy("seg").rowsBetween(W.unboundedPreceding, -1)
    given = all_stretches.select(key, "seg", F.last("_last", ignorenulls=True).over(before).alias("_given"))
    return (
        inside.join(given, [key, "seg"], "left")
        .withColumn(name, F.coalesce(name, "_given"))
        .drop("seg", "_given")
    )


def attributed(events: DataFrame, marks: DataFrame, key: str, at: str, value: Column, since: str, ties: list[Column],
               name: str, segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """`events` with the `value` of the mark that held their key at the moment `at`, NULL where none did, as `name`.

    A mark holds from `since` on, that moment included; of marks of one moment the last by `ties` holds. Events and
    marks without a key or a moment meet nothing; such events stay out.
    """
    tie_names = [f"_tie{i}" for i in range(len(ties))]
    held = marks.filter(F.col(since).isNotNull()).select(
        F.col(key).alias("_key"), F.col(since).alias("_when"), F.lit(0).alias("_late"),
        *[t.alias(n) for t, n in zip(ties, tie_names)], value.alias("_value"), F.lit(None).cast(_type(events)).alias("_event"))
    types = [held.schema[n].dataType for n in (*tie_names, "_value")]
    own = events.filter(F.col(at).isNotNull()).select(
        F.col(key).alias("_key"), F.col(at).alias("_when"), F.lit(1).alias("_late"),
        *[F.lit(None).cast(t).alias(n) for t, n in zip(types, (*tie_names, "_value"))], F.struct(*events.columns).alias("_event"))
    # Events of one moment need no order among themselves.
    found = carried(held.unionByName(own), "_key", ["_when", "_late", *tie_names], "_value", "_held", segment_rows)
    return found.filter(F.col("_late") == 1).select("_event.*", F.col("_held").alias(name))


def _type(events: DataFrame):
    return events.select(F.struct(*events.columns).alias("e")).schema["e"].dataType
