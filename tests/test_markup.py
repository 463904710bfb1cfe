"""What looks like a tag inside comments, scripts and values is none."""

import pytest
from pyspark.sql import functions as F

from crawlfold.functions import markup as M
from crawlfold.operators import detail, listing
from test_listing import card
from test_probes import LIST, ids, pages

TWO = "<ul>" + card("1") + card("2") + "</ul>"


@pytest.mark.parametrize("html", [
    LIST.format('<!-- <div class="old"> -->' + TWO),
    LIST.format('<script>document.write("<div class=x>")</script>' + TWO),
    "<!-- </div> -->" + LIST.format("<!-- </div> -->" + TWO),
    LIST.format("<style>li { } /* <ul> */</style><p title='</div>' data-x=it's>all</p>" + TWO),
    LIST.format("<ul>" + card("1").replace("</li>", "") + card("2").replace("</li>", "") + "</ul>"),
    LIST.format("<ul>" + card("1").replace("</div></li>", "") + card("2") + "</ul>"),  # the card's own block stays open
    "<!-- " + LIST.format("<ul>" + card("9") + "</ul>") + " -->" + LIST.format(TWO),
    LIST.format("<!---><!-->" + TWO + "<!-- never ended <div>"),
    LIST.format("<SCRIPT type='a>b'>'</script >'</SCRIPT><textarea><div></textarea>" + TWO),
])
def test_both_cards_are_found(spark, html):
    assert ids(pages(spark, html)) == ["1", "2"]
    assert listing.rejects(pages(spark, html)).count() == 0


@pytest.mark.parametrize("inner,words", [
    ("<span><span>n</span><a>y</a></span>", "y"),
    ("<!-- </div> --><span><a>y</a></span>", "y"),
    ("<span><a>x<a>y</a></span><span><i><a>z</a></i></span>", "x|y|z"),
    ("<span><a>x</a><span><a>inner</a></span><a>y</a></span>", "x|y"),
    ("<script>'</div></div>'</script><span title='</span>'><a href='>'>y</a></span></div><div><span><a>no</a></span>", "y"),
    ("<span><a></a></span>", None),
])
def test_keywords(spark, inner, words):
    html = f'<div id="summaryfilter-wrapper"><div class="content">{inner}</div></div><div class="content"><span><a>no</a></span></div>'
    assert [r["key_words"] for r in detail.with_details(pages(spark, html)).collect()] == [words]


def test_scripts_in_comments_do_not_count(spark):
    good = '<script src="x>y">shopGlat: "31.5" shopGlng: "121.5"</script>'
    bad = '<!-- <script>shopGlat: "11.5" shopGlng: "111.5"</script> -->'
    rows = detail.with_position(pages(spark, bad + good, "<script>'<!--'</script>" + good, bad)).orderBy("url").collect()
    assert [(r["lon"], r["lat"]) for r in rows] == [(121.5, 31.5), (121.5, 31.5), (None, None)]


def test_pieces_keep_every_letter(spark):
    """Cut up and put together again a text is whole, whatever is in it."""
    texts = ["", "no tag", "<div", "<div <", "a<b<c", "<div a='>' b=\"<p>\" c=it's><p>x</p></DIV\n>y", "<divan></div/><li/>" * 50, "<" * 3000,
             "<p x=" + "'" * 3001 + ">", "<div " + "a=b " * 5000 + ">" + "<p>" * 5000]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select("t", M.pieces(F.col("t"), "div", "li").alias("p")).collect()
    assert [r["t"] for r in got] == ["".join(r["p"]) for r in got]
    assert [len(r["p"]) for r in got if r["t"].startswith("<div a")] == [2, 1]


def test_long_comments_and_scripts(spark):
    html = "<!--" + "<div>" * 100_000 + "-->" + "<script>" + "<ul>'\"" * 100_000 + "</script>" + LIST.format(TWO)
    assert ids(pages(spark, html)) == ["1", "2"]
