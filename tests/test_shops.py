"""Upsert, completeness and work selection."""

import datetime as dt
import random

import pytest

from crawlfold.operators import shops as ops
from crawlfold.schemas import SHOPS

FIELDS = ["name", "type_", "lon"]
START = dt.datetime(2024, 1, 1)


def shop(id, lock_=0, **known):
    return tuple({**dict.fromkeys(SHOPS.names), "id": id, "lock_": lock_, **known}[n] for n in SHOPS.names)


def shops(spark, *rows):
    return spark.createDataFrame(list(rows), SHOPS)


def observations(spark, rows):
    """Rows (id, seq, name, type_, lon); every three share a time."""
    timed = [(i, START + dt.timedelta(seconds=s // 3), s, n, t, lon) for i, s, n, t, lon in rows]
    return spark.createDataFrame(timed, "id string, ts timestamp_ntz, seq long, name string, type_ string, lon double")


def random_observations(n=400, seed=7):
    r = random.Random(seed)
    maybe = lambda v: v if r.random() < 0.4 else None
    return [
        # A third of the rows belong to one id.
        ("hot" if r.random() < 0.33 else str(r.randrange(30)), s,
         maybe(f"n{s}"), maybe(f"t{s}"), maybe(float(s)))
        for s in range(n)
    ]


def by_hand(rows):
    state = {}
    for id_, _, *values in rows:
        old = state.get(id_, [None] * 3)
        state[id_] = [o if v is None else v for o, v in zip(old, values)]
    return state


def as_dict(df):
    return {r["id"]: [r[f] for f in FIELDS] for r in df.collect()}


def test_last_known_value_wins(spark):
    rows = random_observations()
    got = ops.values(ops.fold_observations(observations(spark, rows), FIELDS), FIELDS)
    assert as_dict(got) == by_hand(rows)


@pytest.mark.parametrize("seed", [1, 2])
def test_batches_in_any_order_give_the_same(spark, seed):
    rows = random_observations(seed=seed)
    shuffled = rows[:]
    random.Random(seed).shuffle(shuffled)
    batches = [shuffled[i::3] for i in range(3)]
    states = [ops.fold_observations(observations(spark, b), FIELDS) for b in batches]
    together = states[0].unionByName(states[1]).unionByName(states[2]).unionByName(states[1])
    assert as_dict(ops.values(ops.refold(together, FIELDS), FIELDS)) == by_hand(rows)


def test_upsert_keeps_known_values(spark):
    table = shops(spark, shop("1", 20, name="A", lon=1.0, address="x"), shop("2", name="B"), shop("3", name="C"))
    seen = observations(spark, [("1", 0, None, "t", None), ("2", 1, None, None, None), ("4", 2, "D", None, 2.0)])
    rows = {r["id"]: r for r in ops.upsert(table, seen, FIELDS).collect()}
    assert {i: r["action"] for i, r in rows.items()} == {"1": "update", "2": "update", "3": "keep", "4": "insert"}
    assert (rows["1"]["name"], rows["1"]["type_"], rows["1"]["lon"], rows["1"]["address"]) == ("A", "t", 1.0, "x")
    assert rows["2"]["name"] == "B"
    assert (rows["4"]["name"], rows["4"]["lock_"], rows["4"]["address"]) == ("D", 0, None)
    assert rows["1"]["lock_"] == 20


def test_upsert_is_idempotent(spark):
    table = shops(spark, shop("1", name="A"))
    seen = observations(spark, [("1", 0, None, "t", None), ("2", 1, "B", None, None)])
    first = ops.upsert(table, seen, FIELDS).drop("action")
    again = ops.upsert(first, seen, FIELDS).drop("action")
    assert sorted(map(str, again.collect())) == sorted(map(str, first.collect()))


def test_values_are_data_not_sql(spark):
    table = shops(spark, shop('a"b', name="x"), shop("007", name="y"))
    seen = observations(spark, [('a"b', 0, 'O"Hara; --', None, None), ("7", 1, "z", None, None)])
    rows = {r["id"]: (r["name"], r["action"]) for r in ops.upsert(table, seen, FIELDS).collect()}
    assert rows == {'a"b': ('O"Hara; --', "update"), "007": ("y", "keep"), "7": ("z", "insert")}


def test_completeness(spark):
    table = shops(
        spark, shop("1", type_="t", lon=1.0, lat=2.0), shop("2", type_="t", lon=1.0), shop("3", type_="t"),
        shop("4", lon=1.0, lat=2.0), shop("5", lon=1.0), shop("6"),
    )
    ids = spark.createDataFrame([(str(i),) for i in [1, 2, 3, 4, 5, 6, 7, 7]], "id string")
    got = {r["id"]: r["code"] for r in ops.completeness(ids, table).collect()}
    assert got == {"1": 200, "2": 301, "3": 301, "4": 499, "5": 400, "6": 400, "7": 100}


def test_claimable(spark):
    good = dict(stars=35, consumption_per_capita=10.0)
    table = shops(
        spark, shop("1", **good), shop("1", **good), shop("2", 1, **good), shop("3", stars=0, consumption_per_capita=1.0),
        shop("4", stars=10), shop("5", lon=1.0, **good), shop("6", lat=1.0, **good),
    )
    assert [r["id"] for r in ops.claimable(table, *ops.WORK_PREDICATES).collect()] == ["1"]
    assert {r["id"] for r in ops.claimable(table).collect()} == {"1", "3", "4", "5", "6"}
    assert {r["id"] for r in ops.claimable(table, "stars > 0", "lon IS NULL").collect()} == {"1", "4", "6"}


@pytest.mark.parametrize("segment_rows", [10**6, 8, 0])
def test_same_listing_count(spark, segment_rows):
    """No listing is hot, some are, all are; a NULL address is an address."""
    rows = [shop(str(i), name="hot" if i % 3 == 0 else f"n{i % 7}", address=None if i % 2 else "a") for i in range(60)]
    table = shops(spark, *rows)
    counted = ops.same_listing_count(table, segment_rows)
    groups = {}
    for r in rows:
        groups[r[1], r[2]] = groups.get((r[1], r[2]), 0) + 1
    assert {r["id"]: r["n"] for r in counted.collect()} == {r[0]: groups[r[1], r[2]] for r in rows}
    assert counted.columns == [*table.columns, "n"]


def test_upsert_collapses_before_the_shuffle(spark):
    seen = observations(spark, random_observations(20))
    plan = ops.fold_observations(seen, FIELDS)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_max") > plan.index("Exchange")


def test_item_names_become_columns():
    from crawlfold.schemas import ITEM_COLUMNS

    assert set(ITEM_COLUMNS.values()) | {"lock_"} == set(SHOPS.names)
