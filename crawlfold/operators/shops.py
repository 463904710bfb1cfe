"""Shop table: completeness, work selection and the null-preserving upsert."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from crawlfold import params as P
from crawlfold.operators.skew import SEGMENT_ROWS
from crawlfold.session import written

# A shop worth a detail visit.
WORK_PREDICATES = (
    "stars > 0", "consumption_per_capita IS NOT NULL", "lon IS NULL", "lat IS NULL",
)


def claimable(shops: DataFrame, *predicates: str) -> DataFrame:
    """Distinct ids of free shops that meet every given SQL predicate."""
    tests = [F.col("lock_") == P.FREE] + [F.expr(p) for p in predicates]
    return shops.filter(reduce(Column.__and__, tests)).select("id").distinct()


def completeness_code() -> Column:
    """Code of a stored shop from type_, lon and lat."""
    position = F.col("lon").isNotNull() & F.col("lat").isNotNull()
    return (
        F.when(F.col("type_").isNull() & position, P.NO_BASICS_BUT_POSITION)
        .when(F.col("type_").isNull(), P.NO_BASICS)
        .when(~position, P.NO_POSITION)
        .otherwise(P.COMPLETE)
    )


def completeness(ids: DataFrame, shops: DataFrame) -> DataFrame:
    """One code per incoming id; ids that are not stored get the absent code.

    Incoming ids are made distinct first, which collapses repeated ids before the shuffle
    and leaves a join of unique keys.
    """
    graded = one_per_id(shops).select("id", completeness_code().alias("code"))
    return (
        ids.select("id").distinct()
        .join(graded, "id", "left")
        .select("id", F.coalesce("code", F.lit(P.ABSENT)).alias("code"))
    )


def one_per_id(shops: DataFrame) -> DataFrame:
    """One row per stored id: of several the greatest, compared column by column. Collapses on the
    map side, and leaves the rows where the join by id needs them."""
    rest = [c for c in shops.columns if c != "id"]
    if not rest:
        return shops.distinct()
    whole = shops.groupBy("id").agg(F.max(F.struct(*rest)).alias("_row"))
    return whole.select(*[F.col(c) if c == "id" else F.col(f"_row.{c}").alias(c) for c in shops.columns])


def fold_observations(observations: DataFrame, fields: list[str]) -> DataFrame:
    """Last known value of every field per id, each with the (ts, seq, url) it was seen at.

    A field's state is the greatest struct(ts, seq, url, value) over the rows that know the
    value, so two pages of the same moment do not mix. Observations without a URL have an
    empty one. Taking the greatest is associative, commutative and idempotent, so partial
    results of tasks, files or micro-batches can be folded again in any order, and the
    shuffle carries one row per id and task however often an id occurs.
    """
    url = F.coalesce("url", F.lit("")) if "url" in observations.columns else F.lit("")
    stamped = [
        F.max(F.when(F.col(f).isNotNull(), F.struct("ts", "seq", url.alias("url"), F.col(f).alias("value")))).alias(f)
        for f in fields
    ]
    return observations.filter(F.col("id").isNotNull()).groupBy("id").agg(*stamped)


def refold(states: DataFrame, fields: list[str]) -> DataFrame:
    """Combine states of `fold_observations` from several batches."""
    return states.groupBy("id").agg(*[F.max(f).alias(f) for f in fields])


def values(states: DataFrame, fields: list[str]) -> DataFrame:
    """Drop the stamps of folded fields."""
    return states.select("id", *[F.col(f)["value"].alias(f) for f in fields])


def merge(shops: DataFrame, updates: DataFrame, fields: list[str]) -> DataFrame:
    """Apply one row of updates per id: known new values win, NULL keeps the old value.

    `action` says what happened to the row: insert, update or keep. Rows that the stored table
    holds of one id are collapsed first, so both sides hold an id once and the join has no hot
    keys.
    """
    for name in fields:
        if name not in shops.columns:  # a field the stored table lacks is added to it
            shops = shops.withColumn(name, F.lit(None).cast(updates.schema[name].dataType))
    old = one_per_id(shops).withColumn("_old", F.lit(True)).alias("old")
    joined = old.join(updates.withColumn("_new", F.lit(True)).alias("new"), "id", "full_outer")
    columns: list[Column] = []
    for name in shops.columns:
        both = [F.col(f"new.{name}"), F.col(f"old.{name}")] if name in fields else [F.col(f"old.{name}")]
        if name == "lock_":
            columns.append(F.coalesce(*both, F.lit(P.FREE)).alias(name))
        elif name in fields:
            columns.append(F.coalesce(*both).alias(name))
        else:
            columns.append(F.col("id") if name == "id" else F.col(f"old.{name}"))
    action = (
        F.when(F.col("old._old").isNull(), "insert")
        .when(F.col("new._new"), "update")
        .otherwise("keep")
    )
    return joined.select(*columns, action.alias("action"))


def upsert(shops: DataFrame, observations: DataFrame, fields: list[str]) -> DataFrame:
    """Shop table after a batch of observations, with the action per row."""
    return merge(shops, values(fold_observations(observations, fields), fields), fields)


def same_listing_count(shops: DataFrame, segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """Add `n`: how many shops share name and address.

    Listings of more than `segment_rows` shops are found by a count that combines on the map side; their rows get the
    count by a join with these few listings, at most count(rows) / segment_rows. All other rows are counted by one
    window, so without hot listings the rows travel once. `shops` are read twice: pass a stored table.
    """
    keys = ["name", "address"]
    counts = shops.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > segment_rows)
    hot = written(counts)
    inside = F.count(F.lit(1)).over(W.partitionBy(*keys))
    if hot.isEmpty():
        return shops.withColumn("n", inside)
    left, right = shops.alias("l"), hot.alias("r")
    same = reduce(Column.__and__, [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys])
    cold = left.join(right, same, "left_anti").withColumn("n", inside)
    return cold.unionByName(left.join(right, same).select(*[F.col(f"l.{c}") for c in shops.columns], F.col("r.n")))
