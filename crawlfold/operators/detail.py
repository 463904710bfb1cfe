"""Detail pages to coordinates, review keywords and headings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlfold.functions import html as H, markup as M

# Patterns of the coordinates inside the page script.
LON = r'shopGlng: *" *(\d{3}.\d+) *"'
LAT = r'shopGlat: *" *(\d{2}.\d+) *"'


def position_script(page: Column) -> Column:
    """First script that names both coordinates, NULL when no script does."""
    both = F.filter(M.scripts(page), lambda s: s.contains("shopGlat") & s.contains("shopGlng"))
    return F.try_element_at(both, F.lit(1))


def with_position(pages: DataFrame) -> DataFrame:
    """Add lon and lat. A script whose value is no number gives NULL, not an error."""
    def number(pattern: str) -> Column:
        return F.regexp_extract(F.col("_script"), pattern, 1).try_cast("double")

    return (
        pages.withColumn("_script", position_script(F.col("html")))
        .withColumns({"lon": number(LON), "lat": number(LAT)})
        .drop("_script")
    )


def link_words(section: Column) -> Column:
    """All link texts of a section joined by a vertical bar, NULL when there are none."""
    return H.known(H.unescape(F.array_join(H.texts(section, "a"), "|")))


def key_words(shown: Column) -> Column:
    """Texts of the links directly inside the spans of every content block of the wrapper of the review keywords, in
    page order; `shown` is the page without comments and scripts."""
    wrapper = H.after(shown, H.opening("div", "id", "summaryfilter-wrapper"))
    content = {"d": ("c", H.opening("div", "class", "content"))}
    tags = F.transform(M.pieces(wrapper, "div", "span", "a"), lambda p: F.struct(
        M.code(p, {"d": "d", "s": "s", "a": "a"}, content).alias("code"), p.alias("piece")))

    def walk(state: Column, tag: Column) -> Column:
        path, code = state["path"], tag["code"]
        now = (
            F.when(code == "", path)
            .when(code == "a", F.concat(M.closed(path, "a", "cds"), F.lit("a")))
            .when(code == "A", M.closed(path, "a", "cd"))
            .when(code == "S", M.closed(path, "s", "cd"))
            .when(code == "D", M.closed(path, "cd"))
            .otherwise(F.concat(path, code))
        )
        over = state["over"] | ((code == "D") & ~path.rlike("[cd]"))
        word = M.leading_text(tag["piece"])
        found = F.when(~over & (code == "a") & now.endswith("csa"), F.concat(state["words"], F.array(word))).otherwise(state["words"])
        return F.struct(now.alias("path"), over.alias("over"), found.alias("words"))

    start = F.struct(F.lit("").alias("path"), F.lit(False).alias("over"), F.array().cast("array<string>").alias("words"))
    return F.filter(F.aggregate(tags, start, walk)["words"], lambda w: w != "")


def extract(pages: DataFrame) -> DataFrame:
    """Detail records: id from the request, lon, lat and key_words from the page."""
    return with_details(pages).select(
        F.col("meta")["shopId"].alias("id"), F.col("fetched_at").alias("ts"), "url", "lon", "lat", "key_words")


def with_details(pages: DataFrame) -> DataFrame:
    """Add lon, lat and key_words."""
    shown = H.once(pages.withColumn("_shown", M.visible(F.col("html"))))
    words = H.once(shown.withColumn("_words", F.array_join(key_words(F.col("_shown")), "|")).drop("_shown"))
    return with_position(words).withColumn("key_words", H.known(H.unescape(F.col("_words")))).drop("_words")


def heading(page: Column) -> Column:
    """Raw shop name of a detail page: the leading text of its heading."""
    return H.text(H.after(M.visible(page), H.opening("div", "id", "basic-info")), "h1", "class", "shop-name")


def with_heading(pages: DataFrame) -> DataFrame:
    """Add the shop name, trimmed; NULL when the page has no heading."""
    named = H.unescaped(pages.withColumn("name", heading(F.col("html"))), "name")
    return named.withColumn("name", H.known(H.strip(F.col("name"))))


def extract_new(pages: DataFrame) -> DataFrame:
    """Shops found through inner links: id from the URL, name and coordinates from the page."""
    return with_heading(with_position(pages)).select(
        H.last_segment(F.col("url")).alias("id"), "name", "lon", "lat"
    )
