"""Golden detail pages, block notices and classifiers."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from crawlfold.functions import html as H
from crawlfold.operators import detail, verdict
from crawlfold.schemas import PAGES

SCRIPT = '<script>window.x = {{shopGlat: "{lat}", cityId: 1, shopGlng:"{lon}"}}</script>'
WORDS = '<div id="summaryfilter-wrapper"><div class="head"><a>no</a></div><div class="content">{}</div></div>'


@pytest.fixture
def pages(spark):
    def build(*htmls):
        rows = [(f"http://x/shop/{i}", h, 200, dt.datetime(2024, 1, 1), {"shopId": str(i)})
                for i, h in enumerate(htmls)]
        return spark.createDataFrame(rows, PAGES)
    return build


def positions(table):
    return [(r["lon"], r["lat"]) for r in detail.extract(table).orderBy("id").collect()]


def test_position(pages):
    table = pages(
        SCRIPT.format(lat="31.23", lon="121.47"),
        SCRIPT.format(lat=" 31.23 ", lon="  121.4737 "),
        "<script>var a=1</script>",
        SCRIPT.format(lat="31.23", lon="121x47"),
        SCRIPT.format(lat="31.23", lon="99.5"),
    )
    assert positions(table) == [
        (121.47, 31.23), (121.4737, 31.23), (None, None), (None, 31.23), (None, 31.23)
    ]


def test_first_script_with_both_names_counts(pages):
    table = pages(
        "<script>shopGlat = 0</script>" + SCRIPT.format(lat="bad", lon="bad") + SCRIPT.format(lat="31.5", lon="121.5"),
        "<script>shopGlat</script><script type='x'>y</script>" + SCRIPT.format(lat="31.5", lon="121.5"),
    )
    assert positions(table) == [(None, None), (121.5, 31.5)]


def test_key_words(pages):
    table = pages(
        WORDS.format("<span><a href='#'>fresh</a></span><span class='g'><a>busy &amp; loud</a></span>"),
        WORDS.format(""),
        "<div class='content'><span><a>elsewhere</a></span></div>",
    )
    found = [r["key_words"] for r in detail.extract(table).orderBy("id").collect()]
    assert found == ["fresh|busy & loud", None, None]


def test_new_shop(pages):
    html = '<div class="b" id="basic-info"><h1 class="shop-name"> \n　Noodle &amp; Co  <a>x</a></h1></div>'
    rows = detail.extract_new(pages(html, "<h1 class='shop-name'>other</h1>")).orderBy("id").collect()
    assert [(r["id"], r["name"]) for r in rows] == [("0", "Noodle & Co"), ("1", None)]


def test_verdict(pages):
    table = pages(
        "<title>验证中心</title>", "<title>shop</title><button class='b'>去首页</button>",
        "<title>shop</title><button>去首页 now</button>", "<p>验证</p>",
    )
    found = [r["status"] for r in verdict.with_verdict(table).orderBy("url").collect()]
    assert found == [403, 403, 200, 200]
    assert verdict.usable(table).count() == 2


def test_classifier_of_the_caller(pages):
    table = pages("a", "b")
    one = verdict.with_verdict(table, lambda p: F.when(p["html"] == "a", 503))
    assert [r["status"] for r in one.orderBy("url").collect()] == [503, 200]
    for other in (lambda p: F.lit("403"), lambda p: F.lit(4.5), lambda p: F.lit(True), None):
        assert {r["status"] for r in verdict.with_verdict(table, other).collect()} == {200}


def test_last_segment_and_strip(spark):
    df = spark.createDataFrame([("http://x/shop/12", " \t a b　\n"), ("http://x/", "")], "u string, t string")
    rows = df.select(H.last_segment(F.col("u")), H.strip(F.col("t"))).collect()
    assert [tuple(r) for r in rows] == [("12", "a b"), ("", "")]
