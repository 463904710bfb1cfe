"""Eligibility, sweep, gap, picks, assignment and reports."""

import datetime as dt

import pytest

from crawlfold.operators import leases, pool as ops
from crawlfold.params import PoolParams
from crawlfold.schemas import POOL
from crawlfold.sources import feeds

TODAY = dt.datetime(2024, 1, 10)


def member(proxy, born=1.0, died=None, death=0, score=0, ban=0, using_n=0, expires=25):
    hours = lambda h: None if h is None else TODAY + dt.timedelta(hours=h)
    return (proxy, None, None, "http", 1, hours(born), hours(expires), hours(died), death, score, ban, using_n)


def pool(spark, *members):
    return spark.createDataFrame(list(members), POOL)


def test_eligible_and_sweep(spark):
    p = pool(spark, member("a"), member("b", ban=2), member("c", ban=3), member("d", death=1, died=2), member("e", ban=9, death=2, died=3))
    assert {r["proxy"] for r in ops.eligible(p).collect()} == {"a", "b"}
    now = TODAY + dt.timedelta(hours=5)
    swept = {r["proxy"]: (r["death"], r["death_time"]) for r in ops.sweep(p, now).collect()}
    assert swept["c"] == (1, now)
    assert swept["a"] == (0, None)
    assert swept["e"] == (2, TODAY + dt.timedelta(hours=3))
    strict = PoolParams(ban_n=2)
    assert {r["proxy"] for r in ops.eligible(p, strict).collect()} == {"a"}


def test_the_zone_of_the_session_does_not_matter(spark):
    p = pool(spark, member("a", born=1, died=3, death=1, score=2), member("b", born=-1))
    expected = tuple(ops.report(p, TODAY).first())
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert tuple(ops.report(p, TODAY).first()) == expected
        assert expected[:2] == (1, 1)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_births_are_strictly_after_midnight(spark):
    p = pool(spark, member("a", born=0), member("b", born=0.001), member("c", born=-3))
    assert ops.births_today(p, TODAY).first()["n"] == 1


@pytest.mark.parametrize("nominal,gap", [(5, 3), (2, 0), (1, 0)])
def test_gap(spark, nominal, gap):
    p = pool(spark, member("a"), member("b"), member("c", death=1, died=2))
    row = ops.gap(p, TODAY, PoolParams(pool_n=nominal)).first()
    assert (row["born_today"], row["alive"], row["gap"]) == (3, 2, gap)


def test_dead_once_or_more(spark):
    p = pool(spark, member("a", died=2, death=1), member("b", died=3, death=2), member("c"))
    once = ops.dead_members(p, TODAY).collect()
    assert [(r["proxy"], r["lifetime_min"], r["unused_min"]) for r in once] == [("a", 60.0, 23 * 60.0)]
    assert {r["proxy"] for r in ops.dead_members(p, TODAY, exactly_once=False).collect()} == {"a", "b"}


def by_product(rows, ban_n=3):
    """The six measures from the product of the six derived tables."""
    young = [r for r in rows if r[5] > TODAY]
    dead = [r for r in young if r[8] == 1]
    natural = [r for r in dead if r[10] < ban_n]
    if not dead or not natural:
        return (None,) * 6
    minutes = lambda rs: [int((r[7] - r[5]).total_seconds()) / 60 for r in rs]
    mean = lambda v: round(sum(v) / len(v), 6)
    return (len(young), len(natural), mean([r[9] for r in dead]), mean(minutes(dead)),
            mean([r[9] for r in natural]), mean(minutes(natural)))


@pytest.mark.parametrize("members", [
    [member("a", died=2, death=1, score=3), member("b", died=4.5, death=1, score=8, ban=3), member("c"), member("d", born=-1, died=1, death=1)],
    [member("a"), member("b")],
    [member("a", died=2, death=1, score=3, ban=3)],
])
def test_report_equals_the_product(spark, members):
    assert tuple(ops.report(pool(spark, *members), TODAY).first()) == by_product(members)


def test_lenient_report_keeps_what_is_known(spark):
    row = ops.report(pool(spark, member("a", died=2, death=1, score=3, ban=3)), TODAY, all_or_nothing=False).first()
    assert (row["download_n"], row["nd_n"], row["avg_score"], row["avg_score_nd"]) == (1, 0, 3.0, None)


def test_picks_depend_only_on_the_seed(spark):
    p = pool(spark, *[member(f"m{i}") for i in range(20)], member("dead", death=1, died=2))
    pick = lambda seed: ops.pick(p, seed).first()["proxy"]
    assert pick("1") == pick("1")
    chosen = {pick(str(s)) for s in range(12)}
    assert len(chosen) > 4 and "dead" not in chosen


def test_numbers_run_without_gaps(spark):
    p = pool(spark, *[member(f"m{i}") for i in range(300)])
    assert sorted(r["n"] for r in ops.numbered(p, "proxy").collect()) == list(range(300))


def test_assignment_is_balanced(spark):
    p = pool(spark, *[member(f"m{i}") for i in range(4)], member("dead", death=1, died=2))
    work = spark.range(4000).withColumnRenamed("id", "item")
    counts = {r["proxy"]: r["count"] for r in ops.assign(work, p).groupBy("proxy").count().collect()}
    assert set(counts) == {"m0", "m1", "m2", "m3"} and sum(counts.values()) == 4000
    assert min(counts.values()) > 900


def test_empty_pool_assigns_nothing(spark):
    p = pool(spark, member("dead", death=1, died=2))
    assert ops.assign(spark.range(10).withColumnRenamed("id", "item"), p).count() == 0


@pytest.mark.parametrize("segment_rows", [10**6, 4, 1])
def test_lease_history(spark, segment_rows):
    rows = [("hot" if s % 3 else f"p{s % 5}", s, TODAY + dt.timedelta(seconds=s, milliseconds=s * 7), s % 2) for s in range(60)]
    df = spark.createDataFrame(rows, "proxy string, seq long, birth_time timestamp_ntz, death int")
    got = {r["seq"]: r for r in leases.history(df, segment_rows).collect()}
    following = {}
    for proxy, seq, born, death in reversed(rows):
        nxt = following.get(proxy)
        assert got[seq]["superseded_at"] == nxt
        assert got[seq]["is_current"] == (nxt is None)
        assert got[seq]["death"] == death
        if nxt is None:
            assert got[seq]["stored_key"] == proxy
        else:
            stamp = int((nxt - dt.datetime(1970, 1, 1)) / dt.timedelta(milliseconds=10))
            assert got[seq]["stored_key"] == f"{proxy}_{stamp}"
        following[proxy] = born
    # A lease that lost its key is neither alive nor eligible, though nobody killed it.
    now = {r["proxy"] for r in leases.current(df, segment_rows).collect()}
    assert now == {r[0] for r in rows} and leases.current(df, segment_rows).count() == len(now)


def test_feeds(spark):
    good = '{"success": true, "msg": "", "data": [{"ip": "1.2.3.4", "port": "80", "expire_time": "2024-01-10 01:00:00"}, {"ip": "1.2.3.5", "port": 81, "expire_time": "soon"}]}'
    rows = [(1, 200, TODAY, good), (2, 200, TODAY, '{"success": false, "msg": "no money"}'), (3, 500, TODAY, good),
            (4, 200, TODAY, "<html>"), (5, 200, TODAY, '{"success": true, "data": []}')]
    replies = spark.createDataFrame(rows, "feed_id long, status int, received_at timestamp_ntz, body string")
    assert [(r["feed_id"], r["pos"]) for r in feeds.leases(replies).collect()] == [(1, 0)]
    got = [(r["feed_id"], r["proxy"], r["expire_time"]) for r in feeds.leases(replies).collect()]
    assert got == [(1, "http://1.2.3.4:80", TODAY + dt.timedelta(hours=1))]
    bad = {r["feed_id"]: (r["reason"], r["msg"]) for r in feeds.lease_rejects(replies).collect()}
    entry = '{"ip":"1.2.3.5","port":"81","expire_time":"soon"}'  # its time cannot be read
    assert bad == {1: ("no expiry", entry), 2: ("refused", "no money"), 4: ("malformed", None)}
