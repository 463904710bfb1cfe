"""What the last review found: nothing is lost silently, one order for all, any order of batches."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from crawlfold import sinks
from crawlfold.functions import html as H
from crawlfold.operators import claims, detail, frontier, leases, listing, outcomes as oc, pool as pool_ops, shops as shop_ops, verdict
from crawlfold.operators.ordering import numbered
from crawlfold.operators.skew import cut
from crawlfold.plans import rounds
from crawlfold.schemas import CLAIMS, OUTCOMES, PAGES, POOL
from crawlfold.sources import feeds
from crawlfold.streaming import jobs
from test_listing import card
from test_shops import shop, shops

T0 = dt.datetime(2024, 1, 1)
LIST = '<div id="shop-all-list">{}</div><ul><li><div class="txt">foreign</div></li></ul>'


def pages(spark, *htmls, status=200):
    rows = [(f"http://x/{i}", h, status, T0, {"shopId": str(i)}) for i, h in enumerate(htmls)]
    return spark.createDataFrame(rows, PAGES)


def ids(table):
    return [r["id"] for r in listing.extract(table).orderBy("url", "pos").collect()]


@pytest.mark.parametrize("inner", [
    "<p>sort</p><ul>{0}{1}</ul>", '<div class="sort"><ul><li><div class="txt">x</div></li></ul></div><ul>{0}{1}</ul>',
    "<ul>{0}</ul><ul>{1}</ul>", "<ul>{0}</ul> text <ul class='b'>{1}", "<UL>{0}{1}</UL>",
])
def test_every_card_of_every_list(spark, inner):
    assert ids(pages(spark, LIST.format(inner.format(card("1"), card("2"))))) == ["1", "2"]


def test_a_list_inside_a_card_does_not_end_it(spark):
    nested = card("1").replace('<div class="tag-addr">', '<ul><li><div class="txt">x</div></li></ul><div class="tag-addr">')
    open_item = card("2").replace("</li>", "")
    table = pages(spark, LIST.format("<ul>" + nested + open_item + card("3") + card(rank=None) + "</ul>"))
    assert ids(table) == ["1", "2", "3"] and listing.rejects(table).count() == 1 and listing.cards(table).count() == 4


def test_price_with_escaped_sign_and_nested_block(spark):
    rows = listing.extract(pages(spark, LIST.format("<ul>" + card("1", price="&#165;85.5") + card("2", price="&yen;8") + card(
        "3").replace('<div class="comment">', '<div class="comment"><div><div>x</div></div>') + "</ul>"))).collect()
    assert {r["id"]: (r["consumption_per_capita"], r["comments_n"]) for r in rows} == {"1": (85.5, 812), "2": (8.0, 812), "3": (85.5, 812)}


def test_references(spark):
    df = spark.createDataFrame([("&#x4E2D;&middot;&#20013;",), ("&#55357;&#0;&#9999999999;&#x110000;",), ("&#038;lt; &amp;#65;",), ("plain",)], "t string")
    assert [r[0] for r in H.unescaped(df, "t").collect()] == ["中·中", "�" * 4, "&lt; &#65;", "plain"]


def test_key_words_of_all_blocks_and_no_other(spark):
    wrap = '<div id="summaryfilter-wrapper">{}</div><div class="content"><span><a>foreign</a></span></div>'
    block = '<div class="content">{}</div>'
    table = pages(
        spark, wrap.format(block.format("<span><a>A</a></span><div><a>x</a></div><a>y</a><span><a>B</a></span>") + block.format("<span><a>C</a></span>")),
        wrap.format(""), wrap.format("<div><div>" + block.format("<span><a>D</a></span><div class='content'><span><a>E</a></span></div><span><a>F</a></span>") + "</div></div>"))
    assert [r["key_words"] for r in detail.extract(table).orderBy("id").collect()] == ["A|B|C", None, "D|E|F"]  # in page order


def test_stored_refusals_are_no_success(spark):
    table = pages(spark, "<p>ok</p>", status=403).union(pages(spark, "<p>ok</p>", status=500)).union(pages(spark, "<p>ok</p>", status=None))
    assert sorted(r["status"] for r in verdict.with_verdict(table).collect()) == [200, 403, 500]
    assert verdict.usable(table).count() == 1
    released = claims.release_codes(verdict.with_verdict(table)).collect()
    assert sorted(r["code"] for r in released) == [0, 0, 20]


def test_every_edge_and_the_newest_link(spark):
    edges = spark.createDataFrame([("a", "b"), ("a", "c"), ("c", "d"), ("d", "a")], "url string, next_url string")
    seeds = spark.createDataFrame([("a",)], "url string")
    assert {r["url"]: r["depth"] for r in frontier.depth(edges, seeds, 4).collect()} == {"a": 0, "b": 1, "c": 1, "d": 2}
    link = '<div class="page"><div>x</div><a class="next" href="{}">n</a></div>'
    rows = [("p", link.format("old"), 200, T0, {}), ("p", link.format("new"), 200, T0 + dt.timedelta(1), {}),
            ("q", link.format("gone"), 200, T0, {}), ("q", "<p></p>", 200, T0 + dt.timedelta(1), {})]
    assert [tuple(r) for r in frontier.next_links(spark.createDataFrame(rows, PAGES)).collect()] == [("p", "new")]


def test_one_order_for_claims_and_releases(spark):
    micros = 1_700_000_000_000_000
    log = spark.createDataFrame([("a", micros, T0, 20), ("a", 7, T0 + dt.timedelta(1), 1), ("b", 7, T0, 1), ("b", 7, T0, 20)], CLAIMS)
    assert {r["id"]: r["lock_"] for r in claims.lock_state(log).collect()} == {"a": 1, "b": 20}


def test_a_large_batch_is_cut_from_a_numbered_order(spark, monkeypatch):
    table = shops(spark, *[shop(f"{i:03d}") for i in range(60)])
    small = sorted(r["id"] for r in claims.claim_batch(table, 25).collect())
    monkeypatch.setattr(claims, "MERGED_IDS", 5)
    assert sorted(r["id"] for r in claims.claim_batch(table, 25).collect()) == small == [f"{i:03d}" for i in range(25)]


def test_numbers_have_no_gaps(spark):
    got = numbered(spark.range(1000).withColumn("k", F.col("id") % 3), ["k", "id"], "n").orderBy("k", "id").collect()
    assert [r["n"] for r in got] == list(range(1000))


def test_merge_keeps_fields_and_ids(spark):
    stored = spark.createDataFrame([("1", "a", None), ("1", "b", None), ("2", "c", 1)], "id string, name string, lock_ int")
    new = spark.createDataFrame([("1", 5.0), ("3", 6.0)], "id string, lon double")
    got = {r["id"]: (r["name"], r["lon"], r["lock_"], r["action"]) for r in shop_ops.merge(stored, new, ["lon"]).collect()}
    assert got == {"1": ("b", 5.0, 0, "update"), "2": ("c", None, 1, "keep"), "3": (None, 6.0, 0, "insert")}


def test_pages_of_one_moment_do_not_mix(spark):
    rows = [("1", T0, 0, "u1", "z", "a"), ("1", T0, 0, "u2", "a", "z")]
    df = spark.createDataFrame(rows, "id string, ts timestamp_ntz, seq long, url string, name string, tag string")
    assert tuple(shop_ops.values(shop_ops.fold_observations(df, ["name", "tag"]), ["name", "tag"]).first()) == ("1", "a", "z")


def test_sparse_numbers_of_a_hot_key(spark):
    rows = [("hot", i * 5_000_000, T0, "block") for i in range(100)] + [("hot", 7, T0, "ok")] * 3 + [("cold", 1, T0, "ok")]
    df, any_hot = cut(spark.createDataFrame(rows, OUTCOMES), "key", list(oc.ORDER), 20)
    sizes = {(r["key"], r["seg"]): r["count"] for r in df.groupBy("key", "seg").count().collect()}
    assert any_hot and len(sizes) == 1 + 6 and max(sizes.values()) == 20 and sizes["cold", -1] == 1
    assert not cut(spark.createDataFrame(rows, OUTCOMES), "key", ["seq"], 1000)[1]


def test_a_key_leased_again_starts_anew(spark):
    held = spark.createDataFrame([("k", 1, T0), ("k", 2, T0 + dt.timedelta(1))], "proxy string, seq long, birth_time timestamp_ntz")
    log = [("k", i, T0 + dt.timedelta(hours=i), "block") for i in range(3)] + [("k", 30, T0 + dt.timedelta(hours=30), "ok"), ("x", 1, T0, "ok")]
    history = leases.history(held)
    state = oc.member_state(oc.by_lease(spark.createDataFrame(log, OUTCOMES), history))
    members = spark.createDataFrame([("k", None, None, "http", 1, T0, None, None, 0, 0, 0, 0),
                                     ("k", None, None, "http", 1, T0 + dt.timedelta(1), None, None, 1, 9, 9, 9)], POOL)
    got = {r["birth_time"]: (r["score"], r["ban"], r["death"]) for r in pool_ops.apply_lease_state(members, state).collect()}
    assert got == {T0: (0, 3, 1), T0 + dt.timedelta(1): (1, 0, 0)}


def test_faulty_lease_entries_are_rejected(spark):
    body = '{"success": true, "data": [{"port": "1", "expire_time": "2024-01-01 00:00:00"}, {"ip": "1", "port": "2", "expire_time": "soon"}, {"ip": "1", "port": "3", "expire_time": "2024-01-01 00:00:00"}]}'
    replies = spark.createDataFrame([(1, 200, T0, body)], "feed_id long, status int, received_at timestamp_ntz, body string")
    assert [r["proxy"] for r in feeds.leases(replies).collect()] == ["http://1:3"]
    assert sorted(r["reason"] for r in feeds.lease_rejects(replies).collect()) == ["no address", "no expiry"]


def test_leases_are_logged_once_per_batch(spark, tmp_path):
    body = '{"success": true, "data": [{"ip": "1", "port": "3", "expire_time": "2024-01-01 00:00:00"}]}'
    replies = spark.createDataFrame([(1, 200, T0, body)], "feed_id long, status int, received_at timestamp_ntz, body string")
    for batch in (0, 1, 1):
        feeds.append_leases(replies, str(tmp_path), batch)
    assert sinks.read_log(spark, str(tmp_path)).count() == 2


def _feed(spark, folder, parts):
    for i, part in enumerate(parts):
        spark.createDataFrame(part, OUTCOMES).coalesce(1).write.mode("append").parquet(f"{folder}/in/{i}")
    return spark.readStream.schema(OUTCOMES).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in/*")


def test_batches_out_of_order_and_compaction(spark, tmp_path):
    """Block, block, block, ok, split so that the second batch lies inside the first."""
    rng = random.Random(4)
    log = [("p", i, T0 + dt.timedelta(i), k) for i, k in enumerate(("block", "block", "block", "ok"))]
    log += [(f"q{i % 5}", 10 + i, T0 + dt.timedelta(i), rng.choice(("ok", "block", "block", "handout"))) for i in range(60)]
    parts = [log[0:1] + log[3:4] + log[4::2], log[1:3] + log[5::2]]
    jobs.fold_pool(_feed(spark, tmp_path, parts), f"{tmp_path}/log", f"{tmp_path}/cp", segment_rows=7)
    want = {tuple(r) for r in oc.member_state(spark.createDataFrame(log, OUTCOMES)).collect()}
    assert {tuple(r) for r in jobs.read_pool_state(spark, f"{tmp_path}/log").collect()} == want
    newest = jobs.compact_pool(spark, f"{tmp_path}/log", f"{tmp_path}/snap", retire=True)
    assert newest == 1 and sinks.read_log(spark, f"{tmp_path}/log") is None  # folders that the snapshot covers are gone
    assert {tuple(r) for r in jobs.read_pool_state(spark, f"{tmp_path}/log", snapshots=f"{tmp_path}/snap").collect()} == want


def test_uncommitted_batches_are_not_read(spark, tmp_path):
    sinks.write_batch(spark.range(3), str(tmp_path), 0)
    sinks.write_batch(spark.range(3), str(tmp_path), 1)
    (tmp_path / "batch_id=1" / "_SUCCESS").unlink()
    assert sinks.read_log(spark, str(tmp_path)).count() == 3


def test_detail_round_scans_once_and_joins_once(spark, tmp_path):
    pages(spark, "<p>x</p>").write.parquet(str(tmp_path / "p"))
    table = spark.read.schema(PAGES).parquet(str(tmp_path / "p"))
    plan = rounds.detail_round(shops(spark, shop("0", 1)), table)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1 and plan.count("Join ") == 1


def test_a_round_counts_what_it_writes(spark, tmp_path):
    merged = rounds.detail_round(shops(spark, shop("0", 1)), pages(spark, '<script>shopGlat: "31.5" shopGlng: "121.5"</script>', "<p></p>"))
    assert rounds.store_round(merged, str(tmp_path), 1) == {"rows": 2, "inserted": 1, "updated": 1}
