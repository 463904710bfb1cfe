"""Outcomes meet the lease of their time without a join of the two."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from crawlfold.operators import asof, leases, outcomes as oc
from crawlfold.schemas import OUTCOMES

T0 = dt.datetime(2024, 1, 1)


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def held(spark, rows):
    return leases.history(spark.createDataFrame(rows, "proxy string, seq long, birth_time timestamp_ntz"))


def replay(outcomes, births):
    """(key, seq) to the lease's birth, by walking a key's births."""
    out = {}
    for key, seq, ts, _ in outcomes:
        own = sorted((b, s) for k, s, b in births if k == key and ts is not None and b <= ts)
        out[key, seq] = f"{key}@{own[-1][0]:%Y%m%d%H%M%S.%f}" if own else None
    return out


@pytest.mark.parametrize("segment_rows", [10**6, 40, 7])
def test_leases_of_a_hot_key(spark, segment_rows):
    rng = random.Random(segment_rows)
    births = [("hot", i, at(3 * i)) for i in range(300)] + [("cold", 1000, at(50))] + [("twice", 2000, at(5)), ("twice", 2001, at(5))]
    keys = ["hot"] * 8 + ["cold", "twice", "none"]
    events = [(rng.choice(keys), i, at(rng.randrange(-5, 1000)), "ok") for i in range(600)]
    got = oc.with_lease(spark.createDataFrame(events, OUTCOMES), held(spark, births), segment_rows)
    assert {(r["key"], r["seq"]): r["lease"] for r in got.collect()} == replay(events, births)


def test_ten_thousand_leases_make_no_pairs(spark):
    births = spark.range(10_000).selectExpr("'k' proxy", "id seq", "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, id) birth_time")
    events = spark.range(20_000).selectExpr(
        "'k' key", "id seq", "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, id div 2, 30) ts", "'ok' kind")
    got = oc.by_lease(events, leases.history(births))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Cartesian" not in plan
    counts = got.groupBy("key").count()
    assert counts.count() == 10_000 and {r["count"] for r in counts.collect()} == {2}


def test_moments_at_the_edges(spark):
    births = [("a", 1, at(10)), ("a", 2, at(20))]
    events = [("a", 1, at(9), "ok"), ("a", 2, at(10), "ok"), ("a", 3, at(20), "block"), ("a", 4, None, "ok")]
    frame = spark.createDataFrame(events, "key string, seq long, ts timestamp_ntz, kind string").union(
        spark.createDataFrame([(None, 5, at(15), "ok")], "key string, seq long, ts timestamp_ntz, kind string"))
    got = {r["seq"]: r["lease"] for r in oc.with_lease(frame, held(spark, births)).collect()}
    assert got == {1: None, 2: "a@20240101001000.000000", 3: "a@20240101002000.000000"}
    assert oc.by_lease(frame.limit(0), held(spark, births)).count() == 0
    assert oc.by_lease(frame, held(spark, births).limit(0)).count() == 0


def test_a_lease_that_ended_without_a_successor_holds_nothing_more(spark):
    ended = spark.createDataFrame([("a", at(0), at(10))], "proxy string, birth_time timestamp_ntz, superseded_at timestamp_ntz")
    events = spark.createDataFrame([("a", 1, at(5), "ok"), ("a", 2, at(10), "ok")], OUTCOMES)
    assert [r["seq"] for r in oc.by_lease(events, ended).collect()] == [1]


def test_columns_of_the_events_are_kept(spark):
    events = spark.createDataFrame([("a", 5, "x")], "key string, at int, note string")
    marks = spark.createDataFrame([("a", 1, "m"), ("a", 4, "n"), ("a", 6, "o")], "key string, since int, what string")
    got = asof.attributed(events, marks, "key", "at", F.col("what"), "since", [], "what")
    assert [r.asDict() for r in got.collect()] == [{"key": "a", "at": 5, "note": "x", "what": "n"}]
