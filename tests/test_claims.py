"""Claims are disjoint, released with a code, and may expire."""

import datetime as dt

from crawlfold.operators import claims
from crawlfold.schemas import CLAIMS, PAGES
from test_shops import shop, shops

T0 = dt.datetime(2024, 1, 1)


def log(spark, *events):
    return spark.createDataFrame([(i, n, T0 + dt.timedelta(hours=n), c) for n, (i, c) in enumerate(events)], CLAIMS)


def test_batches_are_disjoint_and_complete(spark):
    table = shops(spark, *[shop(f"{i:02d}") for i in range(25)])
    taken, events = [], []
    while True:
        batch = [r["id"] for r in claims.claim_batch(table, 10).collect()]
        if not batch:
            break
        assert not set(batch) & set(taken)
        taken += batch
        events += [(i, 1) for i in batch]
        table = claims.apply_locks(table.drop("_lock"), claims.lock_state(log(spark, *events)))
    assert sorted(taken) == [f"{i:02d}" for i in range(25)]


def test_latest_code_holds(spark):
    state = claims.lock_state(log(spark, ("a", 1), ("b", 1), ("a", 20), ("b", 0), ("c", 1)))
    assert {r["id"]: r["lock_"] for r in state.collect()} == {"a": 20, "b": 0, "c": 1}


def test_a_crashed_claim_stays_unless_it_expires(spark):
    events = log(spark, ("a", 1), ("b", 20), ("c", 1))
    as_of = T0 + dt.timedelta(hours=3)
    assert {r["id"]: r["lock_"] for r in claims.lock_state(events).collect()}["a"] == 1
    freed = claims.lock_state(events, as_of, dt.timedelta(hours=2))
    assert {r["id"]: r["lock_"] for r in freed.collect()} == {"a": 0, "b": 20, "c": 1}


def test_release_by_page(spark):
    rows = [("u1", "", 200, T0, {"shopId": "1"}), ("u2", "", 403, T0, {"shopId": "2"}), ("list", "", 200, T0, {})]
    got = claims.release_codes(spark.createDataFrame(rows, PAGES))
    assert {(r["id"], r["code"]) for r in got.collect()} == {("1", 20), ("2", 0)}


def test_requeue(spark):
    rows = [("a", 1, 403), ("a", 2, 200), ("b", 3, 200), ("b", 4, 403), ("c", 5, 403), ("c", 6, 403)]
    got = claims.requeue(spark.createDataFrame(rows, "url string, seq long, status int"))
    assert {(r["url"], r["blocks"]) for r in got.collect()} == {("b", 1), ("c", 2)}


def test_fetched_without_position(spark):
    table = shops(spark, shop("1", 20, lon=1.0, lat=1.0), shop("2", 20, lon=1.0), shop("3", 0))
    assert [r["id"] for r in claims.fetched_without_position(table).collect()] == ["2"]
