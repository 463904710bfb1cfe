"""Streams over many files end with the result of the batch operators."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from crawlfold import sinks
from crawlfold.operators import detail, outcomes as oc, shops as shop_ops, verdict
from crawlfold.schemas import OUTCOMES, PAGES
from crawlfold.streaming import jobs
from driver import bindings as b
from test_outcomes import random_log, replay


def in_files(df, path, order, n):
    """Write `df` as n files that a file source reads one after the other."""
    import os
    import time

    rows = df.orderBy(order).collect()
    size = -(-len(rows) // n)
    for i in range(n):
        part = df.sparkSession.createDataFrame(rows[i * size:(i + 1) * size], df.schema)
        part.coalesce(1).write.mode("append").parquet(str(path))
        time.sleep(0.01)
        for f in os.listdir(path):
            full = os.path.join(path, f)
            if f.startswith("part-") and not os.path.exists(full + ".seen"):
                os.utime(full, (1_700_000_000 + i, 1_700_000_000 + i))
                open(full + ".seen", "w").close()
    for f in os.listdir(path):
        if f.endswith(".seen"):
            os.remove(os.path.join(path, f))


def stream(spark, path, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(path))


def test_pool_fold(spark, tmp_path):
    log = random_log(300, 31)
    in_files(spark.createDataFrame(log, OUTCOMES), tmp_path / "in", "seq", 5)
    query = jobs.fold_pool(stream(spark, tmp_path / "in", OUTCOMES), str(tmp_path / "log"), str(tmp_path / "cp"), segment_rows=20)
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 5
    assert sum(p["numInputRows"] for p in query.recentProgress) == 300
    members, _ = replay(log, 3)
    state = jobs.read_pool_state(spark, str(tmp_path / "log"))
    assert {r["key"]: (r["score"], r["ban"], r["death"], r["death_time"], r["using_n"]) for r in state.collect()} == {
        k: (m["score"], m["ban"], m["death"], m["death_time"], m["using_n"]) for k, m in members.items()}
    assert oc.late_keys(sinks.read_log(spark, str(tmp_path / "log"))).count() == 0
    # Nothing new arrives, so a restart of the job changes nothing.
    jobs.fold_pool(stream(spark, tmp_path / "in", OUTCOMES), str(tmp_path / "log"), str(tmp_path / "cp"))
    assert jobs.read_pool_state(spark, str(tmp_path / "log")).count() == len(members)


def test_shop_upsert(spark, sf, tmp_path):
    seen = b.observations(spark, sf)
    # Files in the order of a hash: batches do not follow the arrival order.
    shuffled = seen.withColumn("_h", F.xxhash64("seq"))
    in_files(shuffled, tmp_path / "in", "_h", 4)
    source = stream(spark, tmp_path / "in", shuffled.schema)
    jobs.upsert_shops(source, b.OBSERVED, str(tmp_path / "log"), str(tmp_path / "cp"))
    updates = jobs.read_shop_updates(spark, str(tmp_path / "log"), b.OBSERVED)
    streamed = shop_ops.merge(b.shops(spark, sf), updates, b.OBSERVED)
    batch = shop_ops.upsert(b.shops(spark, sf), seen, b.OBSERVED)
    assert sorted(map(str, streamed.collect())) == sorted(map(str, batch.collect()))


def test_a_retried_batch_replaces_itself(spark, sf, tmp_path):
    part = oc.summarise(b.outcomes(spark, sf)).cache()
    for _ in range(2):
        sinks.write_batch(part, str(tmp_path), 0)
    assert sinks.read_log(spark, str(tmp_path)).count() == part.count()


@pytest.mark.parametrize("dedup", [None, "1 hour"])
def test_detail_extract(spark, sf, tmp_path, dedup):
    pages = b.detail_pages(spark, sf)
    in_files(pages, tmp_path / "in", "fetched_at", 3)
    source = stream(spark, tmp_path / "in", PAGES)
    jobs.extract_details(source, str(tmp_path / "out"), str(tmp_path / "cp"), dedup)
    streamed = spark.read.parquet(str(tmp_path / "out"))
    batch = detail.extract(verdict.usable(pages))
    assert sorted(map(str, streamed.collect())) == sorted(map(str, batch.collect()))


def test_pages_delivered_twice(spark, tmp_path):
    t = dt.datetime(2024, 1, 1)
    rows = [("u", "<title>x</title>", 200, t, {"shopId": "1"}), ("u", "<title>x</title>", 200, t + dt.timedelta(minutes=5), {"shopId": "1"})]
    in_files(spark.createDataFrame(rows, PAGES), tmp_path / "in", "fetched_at", 2)
    jobs.extract_details(stream(spark, tmp_path / "in", PAGES), str(tmp_path / "out"), str(tmp_path / "cp"), "1 hour")
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1


def test_compacted_logs_read_the_same(spark, sf, tmp_path):
    log = random_log(300, 41)
    pool_log, pool_snaps = str(tmp_path / "pool"), str(tmp_path / "pool-snapshots")
    observed = b.observations(spark, sf)
    shop_log, shop_snaps = str(tmp_path / "shops"), str(tmp_path / "shop-snapshots")
    for i in range(6):
        part = spark.createDataFrame(log[i * 50:(i + 1) * 50], OUTCOMES)
        sinks.write_batch(oc.summarise(part, 3, 5), pool_log, i)
        some = observed.filter(F.pmod(F.xxhash64("seq"), F.lit(6)) == i)
        sinks.write_batch(shop_ops.fold_observations(some, b.OBSERVED), shop_log, i)
        if i in (1, 3):
            assert jobs.compact_pool(spark, pool_log, pool_snaps) == i
            assert jobs.compact_shop_updates(spark, shop_log, b.OBSERVED, shop_snaps) == i
    text = lambda df: sorted(map(str, df.collect()))
    assert text(jobs.read_pool_state(spark, pool_log, snapshots=pool_snaps)) == text(jobs.read_pool_state(spark, pool_log))
    assert text(jobs.read_shop_updates(spark, shop_log, b.OBSERVED, shop_snaps)) == text(
        shop_ops.values(shop_ops.fold_observations(observed, b.OBSERVED), b.OBSERVED))
    rows = sinks.read_log(spark, pool_log, pool_snaps)
    assert {r["batch_id"] for r in rows.select("batch_id").distinct().collect()} == {3, 4, 5}
    members, _ = replay(log, 3)
    state = jobs.read_pool_state(spark, pool_log, snapshots=pool_snaps)
    assert {r["key"]: (r["ban"], r["death"], r["death_time"]) for r in state.collect()} == {
        k: (m["ban"], m["death"], m["death_time"]) for k, m in members.items()}


def test_late_keys_read_their_slices(spark, tmp_path):
    """Batches that reach back behind each other: only the slices of late keys are read, before and after compaction."""
    log = random_log(300, 41)
    hot = [r for r in log if r[0] == "hot"]
    rest = [r for r in log if r[0] != "hot"]
    parts = [hot[::2] + rest, hot[1::2]]
    for i, part in enumerate(parts):
        in_files(spark.createDataFrame(part, OUTCOMES), tmp_path / f"in{i}", "seq", 1)
        jobs.fold_pool(stream(spark, tmp_path / "in*", OUTCOMES), str(tmp_path / "log"), str(tmp_path / "cp"), segment_rows=20)
    members, _ = replay(log, 3)
    want = {k: (m["score"], m["ban"], m["death"], m["death_time"], m["using_n"]) for k, m in members.items()}

    def state(**snapshots):
        rows = jobs.read_pool_state(spark, str(tmp_path / "log"), **snapshots).collect()
        return {r["key"]: (r["score"], r["ban"], r["death"], r["death_time"], r["using_n"]) for r in rows}

    assert state() == want
    keys = spark.createDataFrame([("hot",)], "key string")
    raw = jobs.raw_outcomes(spark, str(tmp_path / "log"), keys)
    assert "PartitionFilters: [isnotnull(slice" in (plan := raw._jdf.queryExecution().executedPlan().toString()) or "PartitionFilters: [(slice" in plan
    assert raw.count() == len(hot)
    files = lambda df: df.select(F.input_file_name()).distinct().count()
    assert files(raw) < files(sinks.read_log(spark, f"{tmp_path}/log/{jobs.RAW}"))
    assert jobs.compact_raw(spark, str(tmp_path / "log"), str(tmp_path / "raw"), retire=True) == 1
    assert state(raw_snapshots=str(tmp_path / "raw")) == want
    in_files(spark.createDataFrame([("hot", 1000, dt.datetime(2025, 1, 1), "ok")], OUTCOMES), tmp_path / "in2", "seq", 1)
    jobs.fold_pool(stream(spark, tmp_path / "in*", OUTCOMES), str(tmp_path / "log"), str(tmp_path / "cp"), segment_rows=20)
    assert state(raw_snapshots=str(tmp_path / "raw"))["hot"][0] == want["hot"][0] + 1
