"""Golden listing pages: optional fields, rank classes, entities, faulty cards."""

import datetime as dt

import pytest

from crawlfold.operators import frontier, listing
from crawlfold.schemas import PAGES

LINK = '<a href="/x" data-shopid="{id}" target="_blank" data-hippo-type="shop"><h4>{name}</h4></a>'


def card(id="1", name="Noodle House", rank="sml-rank-stars sml-str35", comments="812", price="￥85.5",
         tags=("noodles", "riverside"), addr="1 Some Rd", ratings=("8.3", "7.9", "8.0"), link=LINK):
    parts = ['<li class=""><div class="pic"><img></div><div class="txt">',
             '<div class="tit">', link.format(id=id, name=name), "</div>", '<div class="comment">']
    if rank:
        parts.append(f'<span class="{rank}" title="x"></span>')
    if comments:
        parts.append(f"""<a class="review-num" onclick="LXAnalytics('shopreview')"><b>{comments}</b> 条点评</a>""")
    if price:
        parts.append(f'<em>|</em><a class="mean-price">\n 人均\n <b>{price}</b></a>')
    parts.append('</div><div class="tag-addr">')
    parts += [f'<a href="#"><span class="tag">{t}</span></a>' for t in tags]
    if addr:
        parts.append(f'<span class="addr">{addr}</span>')
    parts.append("</div>")
    if ratings:
        named = zip(("口味", "环境", "服务"), ratings)
        parts.append('<span class="comment-list">' + "".join(
            f"<span>{n}<b>{r}</b></span>" for n, r in named if r) + "</span>")
    parts.append("</div></li>")
    return "".join(parts)


def page(*cards, pager='<a class="next" title="next" href="http://x/p2?a=1&amp;b=2">next</a>'):
    return ('<html><body><ul><li><div class="txt">not a shop</div></li></ul>'
            f'<div class="shop-list" id="shop-all-list">\n <ul>{"".join(cards)}</ul></div>'
            f'<div class="page"><a class="prev" href="#">prev</a>{pager}</div></body></html>')


@pytest.fixture
def pages(spark):
    def build(*htmls):
        rows = [(f"http://x/{i}", h, 200, dt.datetime(2024, 1, 1), {}) for i, h in enumerate(htmls)]
        return spark.createDataFrame(rows, PAGES)
    return build


def extracted(pages, *cards):
    return {r["id"]: r for r in listing.extract(pages(page(*cards))).collect()}


def test_all_fields(pages):
    row = extracted(pages, card())["1"]
    assert row.asDict() == {
        "url": "http://x/0", "ts": dt.datetime(2024, 1, 1), "pos": 0, "id": "1", "name": "Noodle House",
        "address": "1 Some Rd", "type_": "noodles", "tag": "riverside", "comments_n": 812,
        "consumption_per_capita": 85.5, "stars": 35, "flavor": 8.3, "envir": 7.9, "service": 8.0,
    }


def test_each_optional_field_may_be_absent(pages):
    rows = extracted(
        pages, card("1", comments=None), card("2", price=None), card("3", ratings=None),
        card("4", ratings=("8.1", None, "7.7")), card("5", comments=None, price=None, ratings=None),
    )
    assert rows["1"]["comments_n"] is None and rows["1"]["consumption_per_capita"] == 85.5
    assert rows["2"]["consumption_per_capita"] is None and rows["2"]["comments_n"] == 812
    assert (rows["3"]["flavor"], rows["3"]["envir"], rows["3"]["service"]) == (None, None, None)
    assert (rows["4"]["flavor"], rows["4"]["envir"], rows["4"]["service"]) == (8.1, None, 7.7)
    assert rows["5"]["stars"] == 35


@pytest.mark.parametrize("css,stars", [("sml-str0", 0), ("sml-str5", 5), ("sml-str35", 35), ("sml-str50", 50)])
def test_stars(pages, css, stars):
    assert extracted(pages, card(rank=f"sml-rank-stars {css}"))["1"]["stars"] == stars


def test_quotes_and_entities(pages):
    rows = extracted(
        pages, card("1", name="""Joe's "Best" """), card("2", name="A &amp; B &lt;C&gt; &quot;D&quot;&#39;s &#26159;"),
        card("3", name="&amp;lt; &#38;lt;"),
    )
    assert rows["1"]["name"] == """Joe's "Best" """
    assert rows["2"]["name"] == """A & B <C> "D"'s 是"""
    assert rows["3"]["name"] == "&lt; &lt;"


def test_faulty_cards_are_rejected_alone(pages):
    no_id = '<a data-hippo-type="shop"><h4>x</h4></a>'
    not_a_shop = '<a data-shopid="9"><h4>x</h4></a>'
    cards = [card("1"), card(link=no_id), card("3", tags=("one",)), card("4", rank=None),
             card("5", name=""), card("6", addr=None), card(link=not_a_shop), card("8")]
    table = pages(page(*cards))
    assert [r["id"] for r in listing.extract(table).orderBy("pos").collect()] == ["1", "8"]
    missing = {r["pos"]: r["missing"] for r in listing.rejects(table).collect()}
    assert missing == {1: "id", 2: "tags", 3: "stars", 4: "name", 5: "address", 6: "id"}


def test_only_the_first_two_tags_count(pages):
    row = extracted(pages, card(tags=("a", "b", "c")))["1"]
    assert (row["type_"], row["tag"]) == ("a", "b")


def test_text_that_is_no_number_is_unknown(pages):
    row = extracted(pages, card(comments="many", price="￥-", ratings=("good", "7.9", "8.0")))["1"]
    assert (row["comments_n"], row["consumption_per_capita"], row["flavor"]) == (None, None, None)


def test_pages_without_a_list(pages):
    assert listing.extract(pages("<html></html>", "", page())).count() == 0


def test_long_page_is_read_to_its_end(pages):
    table = pages(page(*[card(str(i), addr="x" * 200) for i in range(2000)]))
    assert listing.extract(table).count() == 2000


def test_next_link(pages):
    table = pages(page(card()), page(card(), pager=""))
    assert [tuple(r) for r in frontier.next_links(table).collect()] == [("http://x/0", "http://x/p2?a=1&b=2")]


def test_filter_does_not_repeat_patterns(pages):
    plan = listing.extract(pages(page(card())))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("data-shopid") == 1 and plan.count("id\\s*=") == 2
