"""The fold against a row-by-row replay, with hot keys cut into many stretches."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from crawlfold.operators import outcomes as oc
from crawlfold.operators.skew import with_segments
from crawlfold.schemas import OUTCOMES

T0 = dt.datetime(2024, 1, 1)
KINDS = ["ok", "block", "block", "block", "handout", "kill"]


def random_log(n, seed, hot=0.4):
    r = random.Random(seed)
    weights = [3, 4, 4, 4, 3, 1]
    return [
        ("hot" if r.random() < hot else f"k{r.randrange(12)}", s, T0 + dt.timedelta(seconds=s),
         r.choices(KINDS, weights)[0])
        for s in range(n)
    ]


def replay(log, ban_n):
    """The reference behaviour, one update after the other, with a sweep after each block."""
    members, running = {}, {}
    for key, seq, ts, kind in log:
        m = members.setdefault(key, dict(score=0, ban=0, using_n=0, death=0, death_time=None, ban_death_time=None))
        if kind == "handout":
            m["using_n"] += 1
        elif kind == "ok":
            m["using_n"] -= 1
            m["score"] += 1
            m["ban"] = 0
        elif kind == "block":
            m["using_n"] -= 1
            m["ban"] += 1
            if m["ban"] >= ban_n and m["ban_death_time"] is None:
                m["ban_death_time"] = ts
            if m["ban"] >= ban_n and m["death"] < 1:
                m["death"], m["death_time"] = 1, ts
        elif kind == "kill":
            m["death"] += 1
            m["death_time"] = ts
        running[seq] = m["ban"]
    return members, running


def table(spark, log):
    return spark.createDataFrame(log, OUTCOMES).repartition(3)


@pytest.mark.parametrize("seed,ban_n,segment_rows", [
    (1, 3, 10**6), (2, 3, 7), (3, 3, 2), (4, 3, 1), (5, 1, 5), (6, 2, 3), (7, 5, 4), (8, 4, 1),
])
def test_state_equals_replay(spark, seed, ban_n, segment_rows):
    log = random_log(400, seed)
    members, _ = replay(log, ban_n)
    state = oc.member_state(table(spark, log), ban_n, segment_rows)
    assert {r["key"]: {c: r[c] for c in next(iter(members.values()))} for r in state.collect()} == members


@pytest.mark.parametrize("seed,segment_rows", [(11, 10**6), (12, 9), (13, 1)])
def test_running_streak_equals_replay(spark, seed, segment_rows):
    log = random_log(400, seed)
    _, running = replay(log, 3)
    got = oc.running_streak(table(spark, log), segment_rows)
    assert {r["seq"]: r["streak"] for r in got.collect()} == running


@pytest.mark.parametrize("cuts", [1, 2, 5, 40])
def test_batches_chain(spark, cuts):
    log = random_log(300, 21)
    members, _ = replay(log, 3)
    size = -(-len(log) // cuts)
    parts = [
        oc.summarise(table(spark, log[i * size:(i + 1) * size]), 3, 10).withColumn("batch_id", F.lit(i))
        for i in range(cuts) if log[i * size:(i + 1) * size]
    ]
    together = parts[0]
    for p in parts[1:]:
        together = together.unionByName(p)
    together = together.checkpoint() if cuts > 10 else together
    state = oc.fold(together, 3, order=("batch_id", "seg"))
    assert {r["key"]: (r["score"], r["ban"], r["death"], r["death_time"]) for r in state.collect()} == {
        k: (m["score"], m["ban"], m["death"], m["death_time"]) for k, m in members.items()
    }
    assert oc.late_keys(together).count() == 0


def test_late_batches_are_found(spark):
    log = random_log(100, 5, hot=1.0)
    early, late = log[::2], log[1::2]
    parts = [oc.summarise(table(spark, part)).withColumn("batch_id", F.lit(i)) for i, part in enumerate((early, late))]
    assert [r["key"] for r in oc.late_keys(parts[0].unionByName(parts[1])).collect()] == ["hot"]


def test_no_stretch_is_larger_than_asked(spark):
    log = random_log(500, 3, hot=0.7)
    sizes = with_segments(table(spark, log), "key", "seq", 20).groupBy("key", "seg").count().collect()
    assert max(r["count"] for r in sizes) <= 20
    cold = {r["key"] for r in sizes if r["seg"] == -1}
    assert "hot" not in cold and cold


def test_rows_without_a_key_are_left_out(spark):
    schema = "key string, seq long, ts timestamp_ntz, kind string"
    log = spark.createDataFrame([(None, 1, T0, "ok"), ("a", 2, T0, "ok")], schema)
    assert [r["key"] for r in oc.member_state(log).collect()] == ["a"]
