"""Streams over stored files: extraction, shop upsert and the pool fold.

Each micro-batch is folded to one row per key and stored under its batch id. Reading folds
the stored rows once more, so a batch costs its own size, not the size of the table, and a
retried batch replaces its own output. All jobs stop when the input is used up.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from crawlfold import sinks
from crawlfold.operators import detail, listing, outcomes as oc, shops as shop_ops, verdict
from crawlfold.operators.skew import SEGMENT_ROWS
from crawlfold.params import BAN_N, PAGE_OK
from crawlfold.schemas import OUTCOMES
from crawlfold.session import written

# How logged summaries follow each other.
BATCHES = ("batch_id", "seg")
# Folder of the outcomes themselves, inside a pool log.
RAW = "outcomes"
# Slices of a raw log by key, and tasks that write one slice of a batch.
SLICES, SLICE_TASKS = 32, 4


def run_batches(stream: DataFrame, checkpoint: str, store: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Feed all available input through `store`, batch by batch, and wait for the end."""
    query = (
        stream.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def append(records: DataFrame, out: str, checkpoint: str, counts: str | None = None) -> StreamingQuery:
    """Append all available records to files and wait for the end; with `counts`, store what the stream observed."""
    spark = records.sparkSession
    listener = _Observed()
    if counts:
        spark.streams.addListener(listener)
    try:
        query = (
            records.writeStream.format("parquet")
            .option("path", out)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    finally:
        if counts:
            spark.streams.removeListener(listener)
    if counts:
        listener.store(spark, query, counts)
    return query


class _Observed(StreamingQueryListener):
    """What the batches of a query have counted while they ran (`DataFrame.observe`)."""

    def __init__(self):
        self.rows: dict[str, dict[int, dict[str, int]]] = {}

    def _add(self, progress) -> None:
        found = {f"{name}.{k}": v for name, row in progress.observedMetrics.items() for k, v in row.asDict().items()}
        if found:
            self.rows.setdefault(str(progress.runId), {})[progress.batchId] = found

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self._add(event.progress)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def store(self, spark: SparkSession, query: StreamingQuery, counts: str) -> None:
        """Append one row per batch and count. The query itself still knows its latest batches, should the listener be behind."""
        for progress in query.recentProgress:
            self._add(progress)
        rows = [(batch, name, int(n)) for batch, found in self.rows.get(str(query.runId), {}).items() for name, n in found.items()]
        if rows:
            spark.createDataFrame(rows, "batch_id long, name string, n long").coalesce(1).write.mode("append").parquet(counts)


def read_counts(spark: SparkSession, counts: str) -> DataFrame:
    """Counts per batch, `name` being what was observed. A batch that ran again after a failure counts once."""
    return spark.read.parquet(counts).groupBy("batch_id", "name").agg(F.max("n").alias("n"))


def _first_deliveries(pages: DataFrame, within: str | None) -> DataFrame:
    """`within` drops a URL delivered again within that time; the watermark bounds the state this needs."""
    if not within:
        return pages
    # A watermark needs a zoned timestamp.
    timed = pages.withColumn("_at", pages["fetched_at"].cast("timestamp"))
    return timed.withWatermark("_at", within).dropDuplicatesWithinWatermark(["url"]).drop("_at")


def extract_details(pages: DataFrame, out: str, checkpoint: str, dedup_within: str | None = None,
                    counts: str | None = None) -> StreamingQuery:
    """Append the detail records of every usable page as it arrives."""
    return append(detail.extract(_judged(_first_deliveries(pages, dedup_within))), out, checkpoint, counts)


def _judged(pages: DataFrame) -> DataFrame:
    """Usable pages; those that came and those that may be parsed are counted as `pages`."""
    ok = F.col("status") == PAGE_OK
    counted = verdict.with_verdict(pages).observe("pages", F.count(F.lit(1)).alias("seen"), F.count_if(ok).alias("usable"))
    return counted.filter(ok)


def extract_listings(pages: DataFrame, out: str, checkpoint: str, dedup_within: str | None = None,
                     counts: str | None = None) -> StreamingQuery:
    """Append the observations of every usable listing page as it arrives; cards are counted as `cards`."""
    read = listing.parse_cards(listing.cards(_judged(_first_deliveries(pages, dedup_within))))
    faulty = F.col("missing").isNotNull()
    counted = read.observe("cards", F.count(F.lit(1)).alias("seen"), F.count_if(faulty).alias("rejected"))
    return append(counted.filter(~faulty).drop("missing").withColumnRenamed("pos", "seq"), out, checkpoint, counts)


def upsert_shops(observations: DataFrame, fields: list[str], log: str, checkpoint: str) -> StreamingQuery:
    """Fold every batch of observations to one stamped row per id and log it."""
    def store(batch: DataFrame, batch_id: int) -> None:
        sinks.write_batch(shop_ops.fold_observations(batch, fields), log, batch_id)

    return run_batches(observations, checkpoint, store)


def read_shop_updates(spark: SparkSession, log: str, fields: list[str], snapshots: str | None = None) -> DataFrame:
    """Current field values per id from all logged batches, in whatever order they came."""
    return shop_ops.values(shop_ops.refold(sinks.read_log(spark, log, snapshots), fields), fields)


def compact_shop_updates(spark: SparkSession, log: str, fields: list[str], snapshots: str, retire: bool = False) -> int | None:
    """Fold the logged batches into one stamped row per id."""
    return sinks.compact(spark, log, snapshots, lambda rows: shop_ops.refold(rows, fields), retire)


def _slice() -> Column:
    """Which folder of a raw log a key's outcomes lie in."""
    return F.pmod(F.xxhash64("key"), F.lit(SLICES)).cast("int").alias("slice")


def _clustered(rows: DataFrame) -> DataFrame:
    """Outcomes dealt by slice, a hot slice over several tasks, and sorted by key."""
    dealt = rows.withColumn("slice", _slice()).withColumn("_salt", F.pmod(F.xxhash64("seq"), F.lit(SLICE_TASKS)))
    return dealt.repartition("slice", "_salt").sortWithinPartitions("slice", "key", "seq").drop("_salt")


def fold_pool(outcomes: DataFrame, log: str, checkpoint: str, ban_n: int = BAN_N,
              segment_rows: int = SEGMENT_ROWS) -> StreamingQuery:
    """Log the summaries of every batch of outcomes, and the outcomes as they are in a folder inside.

    The outcomes are kept because a key whose batches come out of arrival order has to be folded
    from them again; they lie in slices by key, so that a late key costs its own slice. A batch is written
    once and its summaries are made from what was written.
    """
    def store(batch: DataFrame, batch_id: int) -> None:
        rows = batch.select(*(f.name for f in OUTCOMES.fields))
        sinks.write_batch(_clustered(rows), f"{log}/{RAW}", batch_id, by="slice")
        stored = batch.sparkSession.read.schema(rows.schema).parquet(f"{log}/{RAW}/batch_id={batch_id}")
        sinks.write_batch(oc.summarise(stored, ban_n, segment_rows), log, batch_id)

    return run_batches(outcomes, checkpoint, store)


def raw_outcomes(spark: SparkSession, log: str, keys: DataFrame, snapshots: str | None = None) -> DataFrame:
    """The stored outcomes of a table of keys. Only the slices these keys lie in are read; of `snapshots` (`compact_raw`) too."""
    slices = [r["slice"] for r in keys.select(_slice()).distinct().collect()]  # at most SLICES numbers
    raw = sinks.read_log(spark, f"{log}/{RAW}", snapshots).filter(F.col("slice").isin(slices))
    return raw.drop("batch_id", "slice").join(keys, "key", "left_semi")


def read_pool_state(spark: SparkSession, log: str, ban_n: int = BAN_N, snapshots: str | None = None,
                    segment_rows: int = SEGMENT_ROWS, raw_snapshots: str | None = None) -> DataFrame:
    """Member state from all logged batches, in whatever order they came.

    Keys whose batches overlap in arrival order are folded from their outcomes; a snapshot does
    not change that, since it knows the numbers it covers.
    """
    summaries = sinks.read_log(spark, log, snapshots)
    if summaries is None:
        return oc.member_state(spark.createDataFrame([], OUTCOMES), ban_n)
    late = written(oc.late_keys(summaries, BATCHES))
    state = oc.fold(summaries.join(late, "key", "left_anti"), ban_n, order=BATCHES)
    if late.isEmpty():
        return state
    return state.unionByName(oc.member_state(raw_outcomes(spark, log, late, raw_snapshots), ban_n, segment_rows))


def compact_raw(spark: SparkSession, log: str, snapshots: str, retire: bool = False) -> int | None:
    """Gather the outcomes of all committed batches into one set of slices, so that a late key does not read a file per
    batch. A batch that still runs is not among them. With `retire` the batches' own files go; from then on pass
    `snapshots` as `raw_snapshots` when reading."""
    return sinks.compact(spark, f"{log}/{RAW}", snapshots, lambda rows: _clustered(rows.drop("batch_id", "slice")), retire, by="slice")


def compact_pool(spark: SparkSession, log: str, snapshots: str, ban_n: int = BAN_N, retire: bool = False) -> int | None:
    """Fold the logged summaries into one per key. Keys that are late already stay as they are, to be found again."""
    def fold(rows: DataFrame) -> DataFrame:
        late = written(oc.late_keys(rows, BATCHES))
        kept = rows.join(late, "key", "left_semi")
        folded = oc.compacted(rows.join(late, "key", "left_anti"), ban_n, BATCHES)
        # Two overlapping summaries keep a late key late, whatever comes.
        first = oc.compacted(kept, ban_n, BATCHES)
        return folded.unionByName(first).unionByName(first.withColumn("seg", F.col("seg") + 1))

    return sinks.compact(spark, log, snapshots, fold, retire)
