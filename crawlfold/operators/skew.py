"""Ways to keep a key that holds a large share of all rows out of a single task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlfold.operators.ordering import numbered
from crawlfold.session import written

# Rows of one key that one task may sort. The window rows are narrow, so this is well
# below an executor's memory.
SEGMENT_ROWS = 2_000_000

# Pieces a hot key is cut into where order does not matter.
SALTS = 512


def cut(rows: DataFrame, key: str, order: list[str], segment_rows: int = SEGMENT_ROWS) -> tuple[DataFrame, bool]:
    """Add `seg`: consecutive stretches of a hot key's rows in `order`, -1 for other keys; and whether any key is hot.

    A key is hot when it has more than `segment_rows` rows. Its stretches are cut by rank, so
    each holds at most that many rows, whatever numbers the order has. The hot keys, at most
    count(rows) / segment_rows, are counted once and stored; so are the ranked hot rows. Without
    hot keys nothing else is done.

    `rows` are read again for that: pass a stored table, not the end of a long plan.
    """
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > segment_rows)
    hot = written(counts.filter(F.col(key).isNotNull()).select(key))
    cold = F.lit(-1).cast("bigint")
    if hot.isEmpty():
        return rows.withColumn("seg", cold), False
    ranked = numbered(rows.join(hot, key, "left_semi"), [key, *order], "_row")
    first = ranked.groupBy(key).agg(F.min("_row").alias("_first"))
    seg = F.expr(f"(_row - _first) div {segment_rows}").cast("bigint")
    cut_up = ranked.join(first, key).withColumn("seg", seg).select(*rows.columns, "seg")
    return rows.join(hot, key, "left_anti").withColumn("seg", cold).unionByName(cut_up), True


def with_segments(rows: DataFrame, key: str, order: str, segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """The rows of `cut`."""
    return cut(rows, key, [order], segment_rows)[0]


def salt(*by: Column, salts: int = SALTS) -> Column:
    """A piece number that spreads the rows of one key evenly."""
    return F.pmod(F.xxhash64(*by), F.lit(salts)).cast("int")


def salted_lookup(rows: DataFrame, table: DataFrame, key: str, by: str, salts: int = SALTS) -> DataFrame:
    """Inner join of `rows` to `table` with hot keys of `rows` cut up.

    Only the (key, salt) pairs that occur are looked up, and they are collapsed before the
    shuffle, so neither side ever brings a hot key together in one task.
    """
    salted = rows.withColumn("_salt", salt(F.col(by), salts=salts))
    wanted = salted.select(key, "_salt").distinct().join(table, key)
    return salted.join(wanted, [key, "_salt"]).drop("_salt")
