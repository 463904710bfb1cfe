"""Pool of members: eligibility, sweep, gap, picks and the two reports."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from crawlfold.functions.timing import minutes_between, wall_clock
from crawlfold.operators.leases import lease_id
from crawlfold.params import PoolParams
from crawlfold.session import written

DEFAULTS = PoolParams()

# Members that may be broadcast: keys and numbers of this many stay far below 100 MB.
BROADCAST_MEMBERS = 500_000


def apply_state(members: DataFrame, state: DataFrame) -> DataFrame:
    """Members with their folded state in place of the one they carry; without outcomes they start at zero."""
    return _stated(members, state, F.col("proxy"))


def apply_lease_state(members: DataFrame, state: DataFrame) -> DataFrame:
    """As `apply_state`, with a state folded from `outcomes.by_lease`."""
    return _stated(members, state, lease_id())


def _stated(members: DataFrame, state: DataFrame, key: Column) -> DataFrame:
    counters = ("score", "ban", "using_n", "death")
    carried = (*counters, "death_time", "ban_death_time")
    found = state.select(F.col("key").alias("_key"), *(c for c in (*counters, "death_time")))
    joined = members.drop(*carried).withColumn("_key", key).join(found, "_key", "left").drop("_key")
    return joined.withColumns({c: F.coalesce(c, F.lit(0)) for c in counters})


def eligible(pool: DataFrame, params: PoolParams = DEFAULTS) -> DataFrame:
    """Members that may be handed out."""
    return pool.filter((F.col("death") < params.death_n) & (F.col("ban") < params.ban_n))


def sweep(pool: DataFrame, now: dt.datetime, params: PoolParams = DEFAULTS) -> DataFrame:
    """Pool after a refresh: live members over the block threshold die now."""
    over = (F.col("death") < params.death_n) & (F.col("ban") >= params.ban_n)
    return pool.withColumns({
        "swept": over,
        "death": F.when(over, params.death_n).otherwise(F.col("death")),
        "death_time": F.when(over, wall_clock(now)).otherwise(F.col("death_time")),
    })


def born_today(as_of: dt.datetime) -> Column:
    """Strictly after midnight; `as_of` is the midnight of the day in question."""
    return F.col("birth_time") > wall_clock(as_of)


def births_today(pool: DataFrame, as_of: dt.datetime) -> DataFrame:
    return pool.agg(F.count_if(born_today(as_of)).alias("n"))


def gap(pool: DataFrame, as_of: dt.datetime, params: PoolParams = DEFAULTS) -> DataFrame:
    """Births today, members alive, and how many are missing to the nominal size."""
    alive = F.count_if(F.col("death") < params.death_n)
    return pool.agg(
        F.count_if(born_today(as_of)).alias("born_today"),
        alive.alias("alive"),
        F.greatest(F.lit(params.pool_n) - alive, F.lit(0)).alias("gap"),
    )


def dead_members(pool: DataFrame, as_of: dt.datetime, exactly_once: bool = True) -> DataFrame:
    """Members born today that are dead, with measured and unused minutes.

    The reference view asks for one death exactly; `exactly_once=False` also keeps members
    that failed several probes.
    """
    dead = (F.col("death") == 1) if exactly_once else (F.col("death") >= 1)
    return pool.filter(born_today(as_of) & dead).select(
        "proxy", "birth_time", "death_time", "expire_time",
        minutes_between(F.col("birth_time"), F.col("death_time")).alias("lifetime_min"),
        minutes_between(F.col("death_time"), F.col("expire_time")).alias("unused_min"),
        "score", "ban",
    )


def report(pool: DataFrame, as_of: dt.datetime, params: PoolParams = DEFAULTS,
           all_or_nothing: bool = True) -> DataFrame:
    """Six measures of the day in one pass over the pool.

    The view this replaces multiplies six derived tables. Each average is over copies of
    the same rows, so conditional aggregates over one scan give the same values. The
    product is empty when there is no dead or no natural death; then all six are NULL,
    unless `all_or_nothing` is off.
    """
    young = born_today(as_of)
    dead = young & (F.col("death") == 1)
    natural = dead & (F.col("ban") < params.ban_n)
    minutes = minutes_between(F.col("birth_time"), F.col("death_time"))

    def mean(value: Column, condition: Column) -> Column:
        return F.round(F.avg(F.when(condition, value)), 6)

    measures = {
        "download_n": F.count_if(young),
        "nd_n": F.count_if(natural),
        "avg_score": mean(F.col("score"), dead),
        "avg_lifetime": mean(minutes, dead),
        "avg_score_nd": mean(F.col("score"), natural),
        "avg_lifetime_nd": mean(minutes, natural),
    }
    row = pool.agg(F.count_if(dead).alias("_dead"), *[m.alias(n) for n, m in measures.items()])
    if not all_or_nothing:
        return row.drop("_dead")
    present = (F.col("_dead") > 0) & (F.col("nd_n") > 0)
    return row.select(*[F.when(present, F.col(n)).alias(n) for n in measures])


def pick(pool: DataFrame, seed: str, n: int = 1, params: PoolParams = DEFAULTS) -> DataFrame:
    """`n` eligible members drawn evenly; the seed decides which."""
    order = F.md5(F.concat_ws("|", F.lit(seed), "proxy"))
    return eligible(pool, params).orderBy(order, "proxy").limit(n)


def numbered(members: DataFrame, key: str) -> DataFrame:
    """Number members from 0 in the order of their hashed key, without one global sort.

    Hash prefixes split the members into 4,096 even groups; a window over the group sizes
    gives each group's first number, and the rank inside the group completes it.
    """
    hashed = members.withColumn("_md5", F.md5(F.col(key))).withColumn("_group", F.substring("_md5", 1, 3))
    sizes = hashed.groupBy("_group").agg(F.count(F.lit(1)).alias("_size"))
    # At most 4,096 rows reach this window, whatever the member count.
    before = W.orderBy("_group").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("_group", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    rank = F.row_number().over(W.partitionBy("_group").orderBy("_md5", key)) - 1
    return (
        hashed.withColumn("_rank", rank)
        .join(F.broadcast(offsets), "_group")
        .withColumn("n", (F.col("_offset") + F.col("_rank")).cast("bigint"))
        .drop("_md5", "_group", "_offset", "_rank")
    )


def assign(work: DataFrame, pool: DataFrame, params: PoolParams = DEFAULTS) -> DataFrame:
    """Give each work item `(item)` one eligible member, evenly by the item's hash.

    The eligible members are stored once, because numbering reads them twice. Their count
    is needed for the hash anyway, so it also decides the join: a small pool is broadcast, since its few members would otherwise be hot keys; with a large one
    every member gets a small share of the work and both sides are shuffled.
    """
    stored = written(eligible(pool, params).select("proxy"))
    members, total = numbered(stored, "proxy"), stored.count()
    hashed = F.conv(F.substring(F.md5(F.col("item").cast("string")), 1, 15), 16, 10).cast("bigint")
    placed = work.withColumn("n", F.pmod(hashed, F.lit(max(total, 1))))
    side = F.broadcast(members) if total <= BROADCAST_MEMBERS else members
    return placed.join(side, "n").select("item", "proxy")
