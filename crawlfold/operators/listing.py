"""Listing pages to typed shop rows: one row per card, and rejects with a reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlfold.functions import html as H, markup as M
from crawlfold.schemas import ITEM_COLUMNS

# Markers in the page text.
PER_HEAD = "人均"
FLAVOR, ENVIRONMENT, SERVICE = "口味", "环境", "服务"


def _places(codes: Column) -> Column:
    """Where cards begin and end among the pieces of the shop list, given by the letters of their tags.

    u, l, d are open lists, items and blocks; t is a block of class `txt`. A card is a t inside an item of a list
    directly below the list's block, as many lists as there are; it ends with its own closing tag, with its item, or
    with the page. The list ends with the closing tag of its own block.
    """
    def walk(state: Column, code: Column) -> Column:
        path = state["path"]
        now = (
            F.when(code == "", path)
            .when(code.isin("d", "t"), F.concat(path, F.lit("d")))
            .when(code == "u", F.concat(path, F.lit("u")))
            .when(code == "l", F.concat(M.closed(path, "l", "u"), F.lit("l")))
            .when(code == "D", M.closed(path, "d"))
            .when(code == "U", M.closed(path, "u"))
            .otherwise(M.closed(path, "l", "u"))
        )
        over = state["over"] | ((code == "D") & ~path.contains("d"))
        begun = state["from"].isNotNull()
        ends = begun & (over | ~now.startswith("uld"))
        begins = ~over & (code == "t") & (now == "uld")
        done = F.when(ends, F.concat(state["cards"], F.array(F.struct(state["from"].alias("a"), state["i"].alias("b"))))
                      ).otherwise(state["cards"])
        began = F.when(begins, state["i"]).when(ends, F.lit(None).cast("int")).otherwise(state["from"])
        return F.struct((state["i"] + 1).alias("i"), now.alias("path"), over.alias("over"), began.alias("from"), done.alias("cards"))

    start = F.struct(
        F.lit(1).alias("i"), F.lit("").alias("path"), F.lit(False).alias("over"), F.lit(None).cast("int").alias("from"),
        F.array().cast("array<struct<a:int,b:int>>").alias("cards"))
    return F.aggregate(codes, start, walk, lambda s: F.when(
        s["from"].isNotNull(), F.concat(s["cards"], F.array(F.struct(s["from"].alias("a"), s["i"].alias("b"))))
    ).otherwise(s["cards"]))


def cards(pages: DataFrame) -> DataFrame:
    """One row per card of the shop list, with its position on the page and the page's time.

    Comments, scripts and styles are no part of a card, and what looks like a tag inside them is none.
    """
    shown = H.once(pages.select("url", F.col("fetched_at").alias("ts"), M.visible(F.col("html")).alias("_html")))
    return split_cards(shown, ["url", "ts"])


def split_cards(shown: DataFrame, keep: list[str], outer: bool = False) -> DataFrame:
    """The columns `keep` of pages without comments and scripts (`_html`), and `pos` and `card` of each card. With `outer`
    a page without cards is one row without either."""
    behind = H.after(F.col("_html"), H.opening("div", "id", "shop-all-list"))
    cut = H.once(shown.select(*keep, M.pieces(behind, "ul", "li", "div").alias("_pieces")))
    letters = {"u": "u", "l": "l", "d": "d"}
    text_block = {"d": ("t", H.opening("div", "class", "txt"))}
    codes = F.transform("_pieces", lambda p: M.code(p, letters, text_block))
    found = H.once(cut.select(*keep, "_pieces", _places(codes).alias("_cards")))
    explode = F.posexplode_outer if outer else F.posexplode
    split = found.select(*keep, "_pieces", explode("_cards").alias("pos", "_c"))
    whole = F.array_join(F.slice("_pieces", F.col("_c.a"), F.col("_c.b") - F.col("_c.a")), "")
    # Without the card's own opening tag.
    return split.select(*keep, "pos", H.after(whole, H.opening("div", "class", "txt")).alias("card"))


def stars(css_class: Column) -> Column:
    """Tenths of a star from the rank class: `str0` is 0, `str35` is 35."""
    one_digit = F.substring(css_class, -2, 1) == "r"
    digits = F.when(one_digit, F.substring(css_class, -1, 1)).otherwise(F.substring(css_class, -2, 2))
    return digits.try_cast("int")


def _ratings(card: Column) -> Column:
    """The rated texts of a card, each up to its number, in one short string."""
    marker = f"(?:{FLAVOR}|{ENVIRONMENT}|{SERVICE})"
    rated = H.opening("span") + rf"([^<]*{marker}[^<]*" + H.opening("b") + "[^<]+)<"
    return F.array_join(H.every(card, rated), "<")


def _rating(marker: str) -> Column:
    return H.first(F.col("_ratings"), rf"{marker}[^<]*" + H.opening("b") + "([^<]+)")


def parse_cards(card_rows: DataFrame, keep: list[str] = []) -> DataFrame:
    """Typed fields of every card, plus `missing`: the required fields it lacks.

    Columns: url, ts, pos, those of `keep`, missing and the eleven listing fields under their shop names.
    """
    place = ["url", "ts", "pos", *keep]
    title, comment, tags = F.col("_title"), F.col("_comment"), F.col("_tags")
    blocks = card_rows.select(
        *place,
        _ratings(F.col("card")).alias("_ratings"),
        H.block(F.col("card"), "div", "class", "tit").alias("_title"),
        H.block(F.col("card"), "div", "class", "comment").alias("_comment"),
        H.block(F.col("card"), "div", "class", "tag-addr").alias("_address"),
    )
    price = H.opening("a") + rf"[^<]*{PER_HEAD}"
    rank = H.opening("span", "class", "sml-rank-stars sml-str", part=True)
    pieces = blocks.select(
        *place,
        H.first(title, H.opening("a", "data-hippo-type"), 0).alias("_link"),
        H.text(title, "h4").alias("NAME"),
        H.block(comment, "a", "onclick", "shopreview", part=True).alias("_review"),
        H.before(H.after(comment, price), "</a>").alias("_price"),
        H.first(comment, rank, 0).alias("_rank"),
        H.text(F.col("_address"), "span", "class", "addr").alias("ADDRESS"),
        H.texts(F.col("_address"), "span", "class", "tag").alias("_tags"),
        _rating(FLAVOR).alias("FLA"),
        _rating(ENVIRONMENT).alias("ENV"),
        _rating(SERVICE).alias("SER"),
    )
    raw = pieces.select(
        *place, "NAME", "ADDRESS", "FLA", "ENV", "SER",
        H.attribute(F.col("_link"), "data-shopid").alias("ID"),
        H.text(F.col("_review"), "b").alias("COMMENTS_N"),
        H.text(F.col("_price"), "b").alias("CPC"),
        H.attribute(F.col("_rank"), "class").alias("_rank"),
        F.coalesce(F.try_element_at(tags, F.lit(1)), F.lit("")).alias("TYPE"),
        F.coalesce(F.try_element_at(tags, F.lit(2)), F.lit("")).alias("TAG"),
    )
    plain = H.unescaped(H.once(raw), "ID", "NAME", "ADDRESS", "TYPE", "TAG", "CPC")
    required = {"id": "ID", "name": "NAME", "address": "ADDRESS", "tags": "TAG", "stars": "_rank"}
    lacking = [F.when(F.col(c) == "", F.lit(name)) for name, c in required.items()]
    items = plain.select(
        *place,
        H.known(F.concat_ws(",", *lacking)).alias("missing"),
        *[H.known(F.col(c)).alias(c) for c in ("ID", "NAME", "ADDRESS", "TYPE", "TAG")],
        F.col("COMMENTS_N").try_cast("int").alias("COMMENTS_N"),
        # The first character is the currency sign.
        F.substr("CPC", F.lit(2)).try_cast("double").alias("CPC"),
        stars(F.col("_rank")).alias("STARS"),
        *[F.col(c).try_cast("double").alias(c) for c in ("FLA", "ENV", "SER")],
    )
    return items.withColumnsRenamed(ITEM_COLUMNS)


def extract(pages: DataFrame) -> DataFrame:
    """Shop rows of all listing pages. A faulty card costs only itself, not its page."""
    return parse_cards(cards(pages)).filter(F.col("missing").isNull()).drop("missing")


def rejects(pages: DataFrame) -> DataFrame:
    """Cards that lack a required field, with the names of what they lack."""
    return (
        parse_cards(cards(pages))
        .filter(F.col("missing").isNotNull())
        .select("url", "pos", "id", "missing")
    )
