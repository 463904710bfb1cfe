"""Claims and hand-outs that end by themselves, duplicates within a watermark, and counts of streams."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from crawlfold.operators import claims, outcomes as oc
from crawlfold.schemas import CLAIMS, PAGES
from crawlfold.streaming import expiry, jobs

T0 = dt.datetime(2024, 1, 1)
HANDOUTS, ANSWERS = "request string, key string, id string, ts timestamp_ntz", "request string, at timestamp_ntz"


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def add(spark, folder, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(folder))


def stream(spark, folder, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(folder))


def expire(spark, path, ttl=10, late_by="1 minute"):
    query = expiry.expire_claims(stream(spark, path / "in", CLAIMS), str(path / "out"), str(path / "cp"), dt.timedelta(minutes=ttl), late_by)
    log = spark.read.parquet(str(path / "out"))
    return query, {r["id"]: (r["lock_"], r["since"]) for r in claims.lock_state(log).collect()}


def test_claims_end_across_restarts(spark, tmp_path):
    add(spark, tmp_path / "in", [("a", 1, at(0), 1), ("b", 2, at(1), 1), ("b", 3, at(2), 20), ("c", 4, at(3), 1)], CLAIMS)
    assert expire(spark, tmp_path)[1] == {"a": (1, at(0)), "b": (20, at(2)), "c": (1, at(3))}
    add(spark, tmp_path / "in", [("d", 5, at(11.5), 1)], CLAIMS)  # time is 10.5 now: nothing is older than 10 minutes but a
    assert expire(spark, tmp_path)[1] == {"a": (0, at(10)), "b": (20, at(2)), "c": (1, at(3)), "d": (1, at(11.5))}
    add(spark, tmp_path / "in", [("c", 6, at(12), 1), ("a", 7, at(12), 1)], CLAIMS)  # claimed anew, before and after its end
    query, state = expire(spark, tmp_path)
    assert state == {"a": (1, at(12)), "b": (20, at(2)), "c": (1, at(12)), "d": (1, at(11.5))}
    schema = "id string, seq long, ts timestamp_ntz, code int"
    add(spark, tmp_path / "in", [(None, 0, at(100), 0)], schema)
    query, state = expire(spark, tmp_path)
    assert state == {"a": (0, at(22)), "b": (20, at(2)), "c": (0, at(22)), "d": (0, at(21.5))}
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] > 0


def test_claims_in_any_order_equal_the_batch(spark, tmp_path):
    rng = random.Random(3)
    rows = [(rng.choice("abcdefgh"), i, at(rng.randrange(0, 500)), rng.choice([0, 1, 1, 20])) for i in range(200)]
    for i in range(4):
        add(spark, tmp_path / "in", rows[i::4], CLAIMS)
    add(spark, tmp_path / "in", [(None, 0, at(500 + 1000), 0)], "id string, seq long, ts timestamp_ntz, code int")
    _, state = expire(spark, tmp_path, ttl=60, late_by="1000 minutes")
    batch = claims.lock_state(spark.createDataFrame(rows, CLAIMS), at(500), dt.timedelta(minutes=60))
    assert {k: v[0] for k, v in state.items()} == {r["id"]: r["lock_"] for r in batch.collect()}


def test_unanswered_handouts(spark, tmp_path):
    given = [("1", "m", "x", at(0)), ("2", "m", "y", at(1)), ("3", "n", None, at(2)), ("4", "m", "z", at(3)), ("5", "n", "w", at(200))]
    answers = [("2", at(5)), ("2", at(6)), ("3", at(40)), ("4", at(33)), ("9", at(4))]  # in time, twice, too late, at the last moment
    batch = expiry.unanswered(spark.createDataFrame(given[:4], HANDOUTS), spark.createDataFrame(answers, ANSWERS), "30 minutes")
    want = [("1", "m", "x", at(30)), ("3", "n", None, at(32))]
    assert sorted(map(tuple, batch.collect())) == want
    for rows, name, schema, tick in ((given, "h", HANDOUTS, (expiry.TICK, None, None, at(300))), (answers, "o", ANSWERS, (expiry.TICK, at(300)))):
        for i in range(3):
            add(spark, tmp_path / name, rows[2 - i :: 3], schema)
        add(spark, tmp_path / name, [tick], schema)
    expiry.release_unanswered(stream(spark, tmp_path / "h", HANDOUTS), stream(spark, tmp_path / "o", ANSWERS),
                              str(tmp_path / "out"), str(tmp_path / "cp"), "30 minutes", "250 minutes")
    ended = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(map(tuple, ended.collect())) == want  # the last one could still be answered
    log = spark.createDataFrame([(k, "handout") for _, k, _, _ in given], "key string, kind string").unionByName(
        expiry.as_outcomes(ended).select("key", "kind")).unionByName(spark.createDataFrame([("m", "ok")], "key string, kind string"))
    assert {r["key"]: r["using_n"] for r in oc.in_use(log).collect()} == {"m": 1, "n": 1}
    assert [(r["id"], r["code"], r["ts"]) for r in expiry.as_releases(ended).collect()] == [("x", 0, at(30))]


def page(url, minute):
    return (url, "<p>x</p>", 200, at(minute), {"shopId": url})


def test_duplicates_within_a_watermark(spark, tmp_path):
    def run():
        query = jobs.extract_details(stream(spark, tmp_path / "in", PAGES), str(tmp_path / "out"), str(tmp_path / "cp"),
                                     dedup_within="60 minutes", counts=str(tmp_path / "counts"))
        return query, sorted((r["url"], r["ts"]) for r in spark.read.parquet(str(tmp_path / "out")).select("url", "ts").collect())

    add(spark, tmp_path / "in", [page("a", 0), page("a", 0), page("b", 10)], PAGES)
    assert run()[1] == [("a", at(0)), ("b", at(10))]
    add(spark, tmp_path / "in", [page("a", 50), page("c", 50)], PAGES)  # after a restart, from the checkpoint
    assert run()[1] == [("a", at(0)), ("b", at(10)), ("c", at(50))]
    add(spark, tmp_path / "in", [page("d", 500)], PAGES)
    query, rows = run()
    state = [p["stateOperators"][0] for p in query.recentProgress if p["stateOperators"]]
    assert sum(s["numRowsRemoved"] for s in state) >= 3  # a, b and c are forgotten
    add(spark, tmp_path / "in", [page("a", 501), page("late", 100)], PAGES)  # a is new again; the other is too late
    query, rows = run()
    assert [u for u, _ in rows] == ["a", "a", "b", "c", "d"]
    assert sum(p["stateOperators"][0]["numRowsDroppedByWatermark"] for p in query.recentProgress if p["stateOperators"]) == 1
    counts = jobs.read_counts(spark, str(tmp_path / "counts")).groupBy("name").agg(F.sum("n").alias("n")).collect()
    assert {r["name"]: r["n"] for r in counts} == {"pages.seen": 5, "pages.usable": 5}


def test_counts_of_a_stream_without_input(spark, tmp_path):
    add(spark, tmp_path / "in", [], PAGES)
    jobs.extract_listings(stream(spark, tmp_path / "in", PAGES), str(tmp_path / "out"), str(tmp_path / "cp"), counts=str(tmp_path / "counts"))


@pytest.mark.parametrize("counts", [None, "counts"])
def test_listings_are_counted(spark, tmp_path, counts):
    from test_listing import card
    from test_probes import LIST

    html = LIST.format("<ul>" + card("1") + card(rank=None) + "</ul>")
    add(spark, tmp_path / "in", [("u", html, 200, T0, None), ("v", html, 500, T0, None)], PAGES)
    add(spark, tmp_path / "in", [("w", "<p>", 200, T0, None)], PAGES)
    jobs.extract_listings(stream(spark, tmp_path / "in", PAGES), str(tmp_path / "out"), str(tmp_path / "cp"), counts=counts and str(tmp_path / counts))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1
    if counts:
        total = jobs.read_counts(spark, str(tmp_path / counts)).groupBy("name").agg(F.sum("n").alias("n")).collect()
        assert {r["name"]: r["n"] for r in total} == {"pages.seen": 3, "pages.usable": 2, "cards.seen": 2, "cards.rejected": 1}
