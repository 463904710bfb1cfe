"""One scan for pages of several kinds, and rules and reports by name in SQL."""

import datetime as dt

from pyspark.sql import functions as F

from crawlfold import sql
from crawlfold.operators import detail, listing, pool as pool_ops, shops as shop_ops
from crawlfold.plans import mixed
from crawlfold.schemas import PAGES
from driver import bindings as b
from test_detail import SCRIPT, WORDS
from test_listing import card
from test_probes import LIST

T0 = dt.datetime(2024, 1, 1)


def rows(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=str)


def test_equal_to_the_separate_rounds(spark, sf, tmp_path):
    lists, details = b.listing_pages(spark, sf, faults=True), b.detail_pages(spark, sf, statuses=True)
    lists.unionByName(details).write.parquet(str(tmp_path / "pages"))
    routed = mixed.routed(spark.read.parquet(str(tmp_path / "pages")))
    plan = routed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan
    tables = mixed.write_tables(routed, str(tmp_path / "out"))
    cards = listing.extract(lists)
    assert rows(tables["card"], *cards.columns) == rows(cards, *cards.columns)
    assert rows(tables["reject"], "url", "pos", "id", "missing") == rows(listing.rejects(lists), "url", "pos", "id", "missing")
    from crawlfold.operators import verdict
    records = detail.extract(verdict.usable(details))
    assert rows(tables["record"], *records.columns) == rows(records, *records.columns)
    assert tables["refused"].count() == verdict.with_verdict(details).filter("status <> 200").count()


def test_pages_of_no_kind_or_without_cards_give_no_row(spark):
    html = LIST.format("<ul>" + card("1") + "</ul>")
    pages = spark.createDataFrame([
        ("a", html, 200, T0, None), ("b", "<p>", 200, T0, None), ("c", html, 200, T0, {"shopId": "7"}), ("d", None, 200, T0, None),
        ("e", SCRIPT.format(lat="31.5", lon="121.5") + WORDS.format("<span><a>w</a></span>"), 200, T0, {"shopId": "8"}),
        ("f", html, 403, T0, None)], PAGES)
    assert rows(mixed.routed(pages), "kind", "url", "id", "lon", "key_words", "status") == [
        ("card", "a", "1", None, None, 200), ("record", "c", "7", None, None, 200), ("record", "e", "8", 121.5, "w", 200),
        ("refused", "f", None, None, None, 403)]
    only = mixed.routed(pages, F.when(F.col("url") == "a", "listing").otherwise("other"))
    assert rows(only, "kind", "url") == [("card", "a")]


def test_sql_names(spark, sf):
    b.pool(spark, sf).createOrReplaceTempView("some_pool")
    names = sql.register(spark, "some_pool")
    as_of = dt.datetime(2024, 1, 11)
    report = spark.sql("SELECT * FROM pool_report(TIMESTAMP_NTZ'2024-01-11')")
    assert rows(report, "*") == rows(pool_ops.report(b.pool(spark, sf), as_of), *report.columns)
    dead = spark.sql("SELECT * FROM dead_members(TIMESTAMP_NTZ'2024-01-11')")
    assert rows(dead, "*") == rows(pool_ops.dead_members(b.pool(spark, sf), as_of), *dead.columns)
    empty = spark.sql("SELECT * FROM pool_report(TIMESTAMP_NTZ'2030-01-01')").first()
    assert set(empty) == {None}
    b.full_shops(spark, sf).createOrReplaceTempView("some_shops")
    codes = spark.sql("SELECT id, completeness_code(type_, lon, lat) AS code FROM some_shops")
    assert rows(codes, "*") == rows(b.full_shops(spark, sf).select("id", shop_ops.completeness_code().alias("code")), "*")
    one = spark.sql("""SELECT star_tenths('sml-str0') a, star_tenths('sml-str35') b, url_id('http://x/9') c,
        shop_lon('<!-- <script>shopGlat shopGlng: "111.1"</script> --><script>shopGlat shopGlng: "121.5"</script>') d,
        page_status('<title>x</title><button>去首页</button>') e, page_status('<p>') f""").first()
    assert tuple(one) == (0, 35, "9", 121.5, 403, 200)
    assert {"pool_report", "star_tenths"} <= set(names)
