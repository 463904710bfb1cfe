"""Request outcomes folded into member state: score, failure streak, use and death.

Outcomes `(key, seq, ts, kind)` are ordered per key by the unique arrival number `seq`.
Kinds: handout, ok, block, kill, and timeout for a hand-out that nobody answered. A stretch of a key's outcomes folds into one summary row,
and summaries of consecutive stretches chain into the state of the whole key. A stretch is
a piece of a hot key (see `skew.cut`) or a micro-batch of a stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from crawlfold.operators.asof import attributed
from crawlfold.operators.skew import SEGMENT_ROWS, cut
from crawlfold.operators.leases import lease_id
from crawlfold.params import BAN_N, PAGE_OK


# Arrival number and time.
MOMENTS = "array<struct<seq:bigint,ts:timestamp_ntz>>"
# Arrival order; two outcomes of one key with the same number follow their time, then their kind.
ORDER = ("seq", "ts", "kind")


def _is(kind: str) -> Column:
    return F.col("kind") == kind


def _used() -> Column:
    return F.when(_is("handout"), 1).when(F.col("kind").isin("ok", "block", "timeout"), -1).otherwise(0)


def _with_runs(segmented: DataFrame) -> DataFrame:
    """Add `run`, the failures since the last success inside the stretch, and `after_ok`.

    Both windows share one sort; the run is the block count minus the count at the last ok.
    """
    w = W.partitionBy("key", "seg").orderBy(*ORDER).rowsBetween(W.unboundedPreceding, W.currentRow)
    counted = segmented.withColumn("_blocks", F.count_if(_is("block")).over(w))
    at_ok = F.max(F.when(_is("ok"), F.col("_blocks"))).over(w)
    return (
        counted.withColumn("_at_ok", at_ok)
        .withColumn("run", F.col("_blocks") - F.coalesce("_at_ok", F.lit(0)))
        .withColumn("after_ok", F.col("_at_ok").isNotNull())
        .drop("_blocks", "_at_ok")
    )


def summarise(outcomes: DataFrame, ban_n: int = BAN_N, segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """One row per key and stretch; a key has one stretch unless it is hot.

    `lead` holds the blocks before the first ok that could complete a run begun earlier,
    `own_death` the first block that completes a run inside the stretch.
    """
    return _summarise_runs(_with_runs(_cut(outcomes, segment_rows)[0]), ban_n)


def _cut(outcomes: DataFrame, segment_rows: int) -> tuple[DataFrame, bool]:
    return cut(outcomes.filter(F.col("key").isNotNull()), "key", list(ORDER), segment_rows)


def _summarise_runs(runs: DataFrame, ban_n: int) -> DataFrame:
    moment = F.struct("seq", "ts")
    leading = _is("block") & ~F.col("after_ok")

    def earliest(condition: Column) -> Column:
        return F.min(F.when(condition, moment))

    lead = [earliest(leading & (F.col("run") == i)) for i in range(1, ban_n)]
    return runs.groupBy("key", "seg").agg(
        F.count_if(_is("ok")).alias("score"),
        F.sum(_used()).alias("using_n"),
        F.count_if(_is("kill")).alias("kills"),
        earliest(_is("kill")).alias("first_kill"),
        F.max(F.when(_is("kill"), moment)).alias("last_kill"),
        F.max("after_ok").alias("has_ok"),
        F.max_by("run", F.struct(*ORDER)).alias("trailing"),
        F.array(*lead).cast(MOMENTS).alias("lead"),
        earliest(_is("block") & (F.col("run") >= ban_n)).alias("own_death"),
        F.min("seq").alias("first_seq"),
        F.max("seq").alias("last_seq"),
    )


def _chain(summaries: DataFrame, order: list[str]) -> DataFrame:
    """Add `carry`, the streak a stretch starts with, and `streak`, the one it ends with."""
    by_key = W.partitionBy("key").orderBy(*order)
    so_far = by_key.rowsBetween(W.unboundedPreceding, W.currentRow)
    total = summaries.withColumn("_total", F.sum("trailing").over(so_far))
    before = F.max(F.when(F.col("has_ok"), F.col("_total") - F.col("trailing"))).over(so_far)
    ended = total.withColumn("streak", F.col("_total") - F.coalesce(before, F.lit(0)))
    return ended.withColumn("carry", F.lag("streak", 1, 0).over(by_key)).drop("_total")


def compacted(summaries: DataFrame, ban_n: int = BAN_N, order: tuple[str, ...] = ("seg",)) -> DataFrame:
    """One summary per key that stands for all stretches up to now.

    The first stretch of a key starts without a streak, so the summary needs no `lead`.
    """
    chained = _chain(summaries, list(order))
    # With a streak already begun, the run is complete at an earlier leading block.
    carried = [F.when(F.col("carry") == ban_n - i, F.col("lead")[i - 1]) for i in range(1, ban_n)]
    death = F.least(F.coalesce(*carried), F.col("own_death")) if carried else F.col("own_death")
    return chained.withColumns({"_death": death, "_at": F.struct(*order)}).groupBy("key").agg(
        F.lit(-1).cast("bigint").alias("seg"),
        F.sum("score").alias("score"),
        F.sum("using_n").alias("using_n"),
        F.sum("kills").alias("kills"),
        F.min("first_kill").alias("first_kill"),
        F.max("last_kill").alias("last_kill"),
        F.lit(True).alias("has_ok"),
        F.max_by("streak", "_at").alias("trailing"),
        F.array().cast(MOMENTS).alias("lead"),
        F.min("_death").alias("own_death"),
        F.min("first_seq").alias("first_seq"),
        F.max("last_seq").alias("last_seq"),
    )


def fold(summaries: DataFrame, ban_n: int = BAN_N, order: tuple[str, ...] = ("seg",)) -> DataFrame:
    """State per key from its summaries, chained in `order`.

    Columns: key, score, ban (current streak), using_n, death, death_time, ban_death_time.
    A sweep follows every block, so a live member dies when its streak first reaches
    `ban_n`; failed probes count further deaths and move the death time.
    """
    state = compacted(summaries, ban_n, order)
    ban_death, first_kill = F.col("own_death"), F.col("first_kill")
    swept = ban_death.isNotNull() & (first_kill.isNull() | (ban_death["seq"] < first_kill["seq"]))
    return state.select(
        "key", "score", F.col("trailing").alias("ban"), "using_n",
        (F.col("kills") + F.when(swept, 1).otherwise(0)).alias("death"),
        F.coalesce("last_kill.ts", "own_death.ts").alias("death_time"),
        F.col("own_death.ts").alias("ban_death_time"),
    )


def member_state(outcomes: DataFrame, ban_n: int = BAN_N, segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """State per key from its whole outcome log."""
    return fold(summarise(outcomes, ban_n, segment_rows), ban_n)


def running_streak(outcomes: DataFrame, segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """Every outcome with the failure streak right after it, as `streak`.

    Stretches of hot keys start from the streak carried out of the stretch before; only
    those are looked up, by the partitioning the window already has.
    """
    segmented, any_hot = _cut(outcomes, segment_rows)
    runs = _with_runs(segmented)
    if not any_hot:
        return runs.select("key", "seq", "ts", "kind", F.col("run").alias("streak"))
    stretches = (
        runs.filter(F.col("seg") >= 0)
        .groupBy("key", "seg")
        .agg(F.max("after_ok").alias("has_ok"), F.max_by("run", F.struct(*ORDER)).alias("trailing"))
    )
    carried = _chain(stretches, ["seg"]).select("key", "seg", "carry")
    start = F.when(F.col("after_ok"), 0).otherwise(F.coalesce("carry", F.lit(0)))
    return (
        runs.join(carried, ["key", "seg"], "left")
        .select("key", "seq", "ts", "kind", (F.col("run") + start).alias("streak"))
    )


def first_death(outcomes: DataFrame, ban_n: int = BAN_N, segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """Keys whose streak reached `ban_n`, with the first moment it did."""
    return (
        member_state(outcomes, ban_n, segment_rows)
        .filter(F.col("ban_death_time").isNotNull())
        .select("key", F.col("ban_death_time").alias("death_time"))
    )


def of_pages(pages: DataFrame) -> DataFrame:
    """Completed outcomes of judged pages `(status, fetched_at, meta)` that went through a member.

    The verdict decides, so a page that is not usable never counts as a success. The fetch
    time in microseconds stands for the arrival number.
    """
    key = F.col("meta")["proxy"]
    return pages.filter(key.isNotNull()).select(
        key.alias("key"),
        F.unix_micros(F.col("fetched_at").cast("timestamp")).alias("seq"),
        F.col("fetched_at").alias("ts"),
        F.when(F.col("status") == PAGE_OK, "ok").otherwise("block").alias("kind"),
    )


def with_lease(outcomes: DataFrame, leases: DataFrame, segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """Outcomes with `lease`, the id of the lease that held their key at the time; NULL where none did.

    `leases` are those of `leases.history`. A lease holds its key from its birth until the next one takes it
    over; of two born at one moment the one that was not taken over at once. Births and outcomes are one
    ordered stream per key, so a key with many leases and many outcomes costs their sum, not their product.
    """
    held = leases.withColumn("_lease", F.struct(lease_id().alias("id"), F.col("superseded_at").alias("to"))).select(
        F.col("proxy").alias("key"), "birth_time", "_lease")
    # A lease that lasts, or the one taken over last, wins.
    ties = [F.col("_lease.to").isNull(), F.col("_lease.to")]
    found = attributed(outcomes, held, "key", "ts", F.col("_lease"), "birth_time", ties, "_held", segment_rows)
    open_ = F.col("_held.to").isNull() | (F.col("ts") < F.col("_held.to"))
    return found.withColumn("lease", F.when(open_, F.col("_held.id"))).drop("_held")


def by_lease(outcomes: DataFrame, leases: DataFrame, segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """Outcomes under the lease that held their key: `key` becomes the lease's id (`leases.lease_id`).

    A new lease starts without the outcomes of older ones. Outcomes of a key without a lease at that time
    count for none.
    """
    found = with_lease(outcomes, leases, segment_rows).filter(F.col("lease").isNotNull())
    return found.select(F.col("lease").alias("key"), "seq", "ts", "kind")


def in_use(outcomes: DataFrame) -> DataFrame:
    """Open hand-outs per key: plus one per hand-out, minus one per outcome, a timeout included."""
    return outcomes.groupBy("key").agg(F.sum(_used()).alias("using_n"))


def late_keys(summaries: DataFrame, order: tuple[str, ...] = ("batch_id", "seg")) -> DataFrame:
    """Keys whose stretches overlap in arrival order; their summaries do not chain, their outcomes do."""
    before = W.partitionBy("key").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    seen = summaries.withColumn("_seen", F.max("last_seq").over(before))
    return seen.filter(F.col("first_seq") <= F.col("_seen")).select("key").distinct()
