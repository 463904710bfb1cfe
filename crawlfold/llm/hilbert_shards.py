"""Shards cut from a Hilbert curve over metadata, so that a filter on any of it skips most files.

Each dimension is quantised to `2**bits` cells at its own quantiles, counted over all rows; the cells
of a row give its place on the curve; rows are sorted by place and cut into runs. Strings are compared whole:
their distinct values are numbered in order, and a value's number stands for it.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlfold.operators.ordering import numbered
from crawlfold.session import written

DIMENSIONS = ("lang", "source", "n_chars")
BITS = 6


def curve_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of points with integer coordinates: (dimensions, rows) below 2**bits."""
    x = cells.astype(np.int64).copy()
    n = len(x)
    # From the top bit down, undo the reflections and swaps that the curve makes in each sub-cube.
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(n):
            inside = (x[i] & q) != 0
            swap = np.where(inside, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(inside, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):  # Gray code across the dimensions
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        turn = np.where(x[n - 1] & q, turn ^ (q - 1), turn)
        q >>= 1
    x ^= turn
    out = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            out = (out << 1) | ((x[i] >> b) & 1)
    return out


def ordered_number(df: DataFrame, name: str) -> Column:
    """A number that sorts as the column, not a string, does; NULL before all others."""
    col = F.col(f"`{name}`")
    kind = dict(df.dtypes)[name]
    if kind.startswith(("timestamp", "date")):
        value = F.unix_micros(col.cast("timestamp")).cast("double")
    else:
        value = col.cast("double")
    return F.coalesce(F.when(~F.isnan(value), value), F.lit(float("-inf")))


def _is_text(df: DataFrame, name: str) -> bool:
    return dict(df.dtypes)[name] in ("string", "binary")


def ranked(docs: DataFrame, name: str) -> DataFrame:
    """Distinct values of a string column, in the order of their bytes: `__value` and its place `__place`, stored."""
    values = docs.select(F.col(f"`{name}`").cast("binary").alias("__value")).filter("__value is not null").distinct()
    return written(numbered(values, ["__value"], "__place").select("__value", F.col("__place").cast("double").alias("__place")))


def curve_order(docs: DataFrame, dimensions=DIMENSIONS, bits: int = BITS) -> DataFrame:
    """`docs` with `__curve`: the place of each row on the curve over `dimensions`.

    The quantiles of all rows cut each dimension; there are at most `2**bits` cuts, and they are all
    that comes to the driver. Equal values share a cell. NULL has the first cell; an empty table has no cuts.
    """
    if len(dimensions) * bits > 62:
        raise ValueError("dimensions times bits must not exceed 62")
    columns, values = docs.columns, []
    for i, d in enumerate(dimensions):
        if _is_text(docs, d):
            places = ranked(docs.select(*(f"`{c}`" for c in columns)), d)
            places = places.select(F.col("__value").alias(f"__value{i}"), F.col("__place").alias(f"__place{i}"))
            docs = docs.join(places, F.col(f"`{d}`").cast("binary") == F.col(f"__value{i}"), "left").drop(f"__value{i}")
            values.append(F.coalesce(f"__place{i}", F.lit(float("-inf"))))
        else:
            values.append(ordered_number(docs, d))
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    exact = docs.select(*[v.alias(f"v{i}") for i, v in enumerate(values)]).agg(
        *[F.percentile_approx(f"v{i}", shares, 10_000).alias(f"v{i}") for i in range(len(values))]
    ).first()
    cuts = [np.array(sorted(x or []), float) for x in exact]

    @F.pandas_udf("long")
    def place(*columns: pd.Series) -> pd.Series:
        # A value that spans several quantiles takes the middle one, so that common values spread out too.
        cells = np.stack([(np.searchsorted(c, x, "left") + np.searchsorted(c, x, "right")) // 2
                          for c, x in zip(cuts, columns)])
        return pd.Series(curve_index(cells, bits))

    return docs.select(*(f"`{c}`" for c in columns), place(*values).alias("__curve"))


def cut_runs(rows: DataFrame, order: list, shards: int) -> DataFrame:
    """`rows` with `__shard` and `__slot`: runs of the order whose counts differ by at most one.

    An empty table gives no rows. Equal rows get different slots.
    """
    found = numbered(rows, order, "__row")
    total = found.agg(F.coalesce(F.max("__row") + 1, F.lit(0))).first()[0]
    shard = F.expr(f"(__row * {shards}) div {max(total, 1)}")
    start = F.expr(f"(__shard * {total} + {shards - 1}) div {shards}")
    return found.withColumn("__shard", shard.cast("int")).withColumn("__slot", F.col("__row") - start).drop("__row")


def assign(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, shards: int = 8,
           dimensions=DIMENSIONS, bits: int = BITS) -> DataFrame:
    """One row per document: id, `__size` (UTF-8 bytes of the text, NULL: none, plus 1), `__crc`, `__shard`, `__slot`.

    Law: shards hold equally many rows, at most one more or less. Along the curve equal places are
    ordered by checksum, so copies with the same metadata stand together, then by id. Texts stay where
    they are; only these few numbers are shuffled. NULL ids come first in their place; columns other
    than the dimensions, id and text do not matter.
    """
    data = F.coalesce(F.col(f"`{text_col}`").cast("binary"), F.lit(b""))
    short = docs.select(*[F.col(f"`{c}`") for c in dict.fromkeys([id_col, *dimensions])],
                        (F.octet_length(data) + 1).cast("long").alias("__size"), F.crc32(data).alias("__crc"))
    rows = curve_order(short, dimensions, bits).select(F.col(f"`{id_col}`"), "__size", "__crc", "__curve")
    return cut_runs(rows, ["__curve", "__crc", id_col], shards)


def write_shards(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", *, shards: int = 8,
                 dimensions=DIMENSIONS, bits: int = BITS) -> DataFrame:
    """Store `docs` as one folder per shard and return the manifest: per shard its rows and the range of each dimension.

    Rows with an equal id go where the first of them goes.
    """
    where = assign(docs, id_col, text_col, shards=shards, dimensions=dimensions, bits=bits)
    where = where.groupBy(F.col(f"`{id_col}`").alias("__id")).agg(F.min("__shard").alias("shard"))
    rows = docs.join(where, F.col(f"`{id_col}`").eqNullSafe(F.col("__id"))).drop("__id")
    rows.repartition("shard", F.pmod(F.xxhash64(f"`{id_col}`"), F.lit(8))).write.partitionBy("shard").parquet(path)
    stored = docs.sparkSession.read.parquet(path)
    return stored.groupBy("shard").agg(
        F.count("*").alias("rows"),
        *[f(f"`{d}`").alias(f"{name}_{d}") for d in dimensions for name, f in (("min", F.min), ("max", F.max))],
    )


def read_shards(spark: SparkSession, path: str, manifest: DataFrame, dimension: str, low, high) -> DataFrame:
    """Rows with `dimension` in [low, high]; only shards whose range meets it are read."""
    near = manifest.filter((F.col(f"max_{dimension}") >= low) & (F.col(f"min_{dimension}") <= high))
    chosen = [r["shard"] for r in near.select("shard").collect()]  # at most the number of shards
    return spark.read.parquet(path).filter(F.col("shard").isin(chosen) & F.col(dimension).between(low, high))


def op2_hilbert_shards(spark: SparkSession, sf: str) -> DataFrame:
    found = assign(spark.read.parquet(f"{sf}/documents.parquet"))
    return found.select(
        "doc_id", F.col("__size").alias("size"), F.col("__crc").alias("text_crc32"), F.lit("rows").alias("law"),
        F.col("__shard").alias("shard"), F.col("__slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
