"""Whole rounds: requests, stop conditions, merge and release."""

import datetime as dt

from crawlfold.operators import pool as pool_ops, verdict
from crawlfold.params import PoolParams
from crawlfold.plans import rounds
from crawlfold.schemas import OUTCOMES, PAGES
from crawlfold.operators import outcomes as oc
from test_listing import card, page
from test_pool import TODAY, member, pool
from test_shops import shop, shops

T0 = dt.datetime(2024, 1, 1)
GOOD = dict(stars=35, consumption_per_capita=10.0)
POSITION = '<script>shopGlat: "31.5" shopGlng: "121.5"</script>'


def test_requests_stop_without_work_or_members(spark):
    table = shops(spark, shop("1", **GOOD), shop("2", **GOOD))
    live, dead = pool(spark, member("a")), pool(spark, member("a", death=1, died=2))
    assert rounds.detail_requests(table, live, 5).count() == 2
    assert rounds.detail_requests(table, live, 1).count() == 1
    assert rounds.detail_requests(table, dead, 5).count() == 0
    assert rounds.detail_requests(table, dead, 5, PoolParams(pool_n=0)).count() == 2
    assert rounds.detail_requests(shops(spark, shop("1", 1, **GOOD)), live, 5).count() == 0


def test_detail_round(spark):
    table = shops(spark, *[shop(str(i), 1, name=f"n{i}") for i in range(4)])
    rows = [
        ("u0", POSITION, 200, T0, {"shopId": "0"}),
        ("u1", "<title>验证</title>" + POSITION, 200, T0, {"shopId": "1"}),
        ("u2", "<p>nothing</p>", 200, T0, {"shopId": "2"}),
        ("list", POSITION, 200, T0, {}),
        # A second visit of the same shop finds nothing and takes nothing away.
        ("u0", "<p></p>", 200, T0 + dt.timedelta(1), {"shopId": "0"}),
    ]
    after = {r["id"]: (r["lon"], r["lat"], r["lock_"], r["name"]) for r in rounds.detail_round(
        table, spark.createDataFrame(rows, PAGES)).collect()}
    assert after == {
        "0": (121.5, 31.5, 20, "n0"), "1": (None, None, 0, "n1"), "2": (None, None, 20, "n2"), "3": (None, None, 1, "n3")}


def test_listing_observations(spark):
    rows = [("a", page(card("1", name="old"), card("2")), 200, T0, {}),
            ("b", page(card("1", name="new")), 200, T0 + dt.timedelta(1), {}),
            ("c", "<title>验证</title>" + page(card("3")), 200, T0, {})]
    seen = rounds.listing_observations(spark.createDataFrame(rows, PAGES))
    from crawlfold.operators import shops as shop_ops

    merged = {r["id"]: r for r in shop_ops.upsert(shops(spark, shop("9")), seen, rounds.LISTING_FIELDS).collect()}
    assert set(merged) == {"1", "2", "9"} and merged["1"]["name"] == "new"


def test_a_blocked_page_counts_against_its_member(spark):
    rows = [(f"u{i}", "<title>验证</title>" if i < 3 else "", 200, T0 + dt.timedelta(seconds=i), {"proxy": "a"}) for i in range(3)]
    rows += [("v", "", 200, T0, {"proxy": "b"}), ("w", "", 200, T0, {})]
    judged = verdict.with_verdict(spark.createDataFrame(rows, PAGES))
    state = oc.member_state(oc.of_pages(judged))
    assert {r["key"]: (r["score"], r["ban"], r["death"]) for r in state.collect()} == {"a": (0, 3, 1), "b": (1, 0, 0)}


def test_pool_round(spark):
    members = pool(spark, member("a"), member("b"), member("c")).drop("score", "ban", "using_n", "death", "death_time")
    log = [("a", i, T0, "block") for i in range(3)] + [("b", 5, T0, "ok")]
    state = oc.member_state(spark.createDataFrame(log, OUTCOMES))
    swept, gap = rounds.pool_round(members, state, TODAY, TODAY, PoolParams(pool_n=5))
    assert {r["proxy"]: (r["score"], r["ban"], r["death"]) for r in swept.collect()} == {
        "a": (0, 3, 1), "b": (1, 0, 0), "c": (0, 0, 0)}
    assert gap.first()["gap"] == 3
    assert pool_ops.eligible(swept).count() == 2
