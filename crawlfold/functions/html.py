"""Column functions that read stored HTML with built-in regular expressions.

They never leave the JVM. The layout they assume: attributes are quoted. A pattern only ever
describes an opening tag or a run of text; the end of a block is found by a plain search, or
by counting tags where elements of its name nest, because lazy quantifiers over a whole page
cost many times as much.

What is not found is the empty string until `known` turns it into NULL. Catalyst copies an
expression into every place that uses it, so build these in steps: give each pattern its own
column and let the next `select` refer to that column.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def opening(tag: str, attr: str | None = None, value: str | None = None, part: bool = False) -> str:
    """Pattern of an opening tag, optionally with an attribute equal to or containing `value`.

    Attributes are looked for from the left, which mostly ends at the first one.
    """
    if attr is None:
        return rf"<{tag}\b[^>]*>"
    named = rf"<{tag}\s(?:[^>]*?\s)?{attr}"
    if value is None:
        return named + r"(?=[\s=/>])[^>]*>"
    text = re.escape(value)
    if part:
        return named + rf"""\s*=\s*(?:"[^"]*{text}|'[^']*{text})[^>]*>"""
    return named + rf"""\s*=\s*["']{text}["'][^>]*>"""


def first(html: Column, pattern: str, group: int = 1) -> Column:
    """First match of `pattern`, empty when there is none."""
    return F.regexp_extract(html, "(?s)" + pattern, group)


def every(html: Column, pattern: str, group: int = 1) -> Column:
    """All matches of `pattern`, an empty array when there is none."""
    return F.regexp_extract_all(html, F.lit("(?s)" + pattern), F.lit(group))


def after(html: Column, pattern: str) -> Column:
    """Everything behind the first match of `pattern`, empty when there is none."""
    return first(html, pattern + "(.*)")


def before(html: Column, end: str) -> Column:
    """Everything in front of the first `end`, all of it when there is none."""
    return F.substring_index(html, end, 1)


def _tag_pieces(html: Column, tag: str) -> Column:
    """The text cut in front of every opening and closing tag of the name."""
    return F.split(html, rf"(?i)(?=</?{tag}[\s/>])")


def _step(piece: Column, tag: str) -> Column:
    """Change of depth that a piece of `_tag_pieces` begins with."""
    head = F.lower(F.substring(piece, 1, len(tag) + 2))
    return F.when(head == f"</{tag}", -1).when(head.startswith(f"<{tag}"), 1).otherwise(0)


def inside(html: Column, tag: str) -> Column:
    """Everything in front of the closing tag that matches an opening tag just read; all of it when there is none."""
    def walk(state: Column, piece: Column) -> Column:
        depth = state["depth"] + _step(piece, tag)
        done = state["end"].isNotNull() | (depth < 0)
        end = F.coalesce(state["end"], F.when(depth < 0, state["size"]))
        return F.struct(F.when(done, 0).otherwise(depth).alias("depth"), (state["size"] + F.length(piece)).alias("size"), end.alias("end"))

    start = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("size"), F.lit(None).cast("int").alias("end"))
    end = F.aggregate(_tag_pieces(html, tag), start, walk)["end"]
    nested = html.rlike(rf"(?is)^(?:(?!</{tag}[\s/>]).)*?<{tag}[\s/>]")
    return F.when(nested, F.coalesce(F.substring(html, F.lit(1), end), html)).otherwise(before(html, f"</{tag}>"))


def block(html: Column, tag: str, attr: str | None = None, value: str | None = None,
          part: bool = False) -> Column:
    """Inner HTML of the first matching element, up to its own closing tag."""
    return inside(after(html, opening(tag, attr, value, part)), tag)


def attribute(tag_text: Column, name: str) -> Column:
    """Value of an attribute in the text of one opening tag."""
    return first(tag_text, rf"""\s{name}\s*=\s*["']([^"']*)["']""")


def text(html: Column, tag: str, attr: str | None = None, value: str | None = None) -> Column:
    """Leading text of the first matching element that starts with text."""
    return first(html, opening(tag, attr, value) + r"([^<]+)<")


def texts(html: Column, tag: str, attr: str | None = None, value: str | None = None) -> Column:
    """Leading texts of all matching elements, in document order."""
    return every(html, opening(tag, attr, value) + r"([^<]+)<")


def known(col: Column) -> Column:
    """NULL instead of the empty string."""
    return F.nullif(col, F.lit(""))


# Named references besides those resolved last.
ENTITIES = {
    "nbsp": "\u00a0", "yen": "¥", "middot": "·", "hellip": "…", "mdash": "—", "ndash": "–", "lsquo": "‘", "rsquo": "’",
    "ldquo": "“", "rdquo": "”", "times": "×", "copy": "©", "reg": "®", "trade": "™", "euro": "€", "pound": "£",
    "cent": "¢", "deg": "°", "bull": "•", "laquo": "«", "raquo": "»", "lt": "<", "gt": ">", "quot": '"', "apos": "'",
}


def unescape(col: Column) -> Column:
    """Resolve numeric references, decimal or hexadecimal, and the named ones of `ENTITIES`.

    A number that is no character gives U+FFFD. The ampersand comes last, so that text escaped
    twice is resolved once.
    """
    def character(whole: Column, reference: Column) -> Column:
        hexadecimal = F.lower(F.substring(reference, 1, 1)) == "x"
        code = F.coalesce(
            F.when(hexadecimal, F.conv(F.substring(reference, 2, 100), 16, 10)).otherwise(reference)
            .try_cast("decimal(38,0)").try_cast("bigint"), F.lit(0))
        no_letter = (code <= 0) | (code > 0x10FFFF) | code.between(0xD800, 0xDFFF)
        letter = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        resolved = F.when(no_letter, "\ufffd").when(code == 38, "&amp;").otherwise(letter)
        return F.replace(whole, F.concat(F.lit("&#"), reference, F.lit(";")), resolved)

    references = F.array_distinct(F.regexp_extract_all(col, F.lit(r"&#([xX][0-9a-fA-F]+|\d+);"), F.lit(1)))
    plain = F.when(col.contains("&#"), F.aggregate(references, col, character)).otherwise(col)
    for entity, letter in (*ENTITIES.items(), ("amp", "&")):
        plain = F.replace(plain, F.lit(f"&{entity};"), F.lit(letter))
    # Most texts have no reference at all; they cost one search.
    return F.when(col.contains("&"), plain).otherwise(col)


def unescaped(df: DataFrame, *names: str) -> DataFrame:
    """Resolve entities in the named columns."""
    return df.withColumns({n: unescape(F.col(n)) for n in names})


def once(df: DataFrame) -> DataFrame:
    """Fix the columns here, so that a later filter does not run their patterns again.

    Catalyst pushes a filter below the projections it refers to and evaluates their
    expressions there a second time. It cannot push one below a generator.
    """
    fixed = F.inline_outer(F.array(F.struct(*df.columns)))
    return df.select(fixed)


def strip(col: Column) -> Column:
    """Remove white space of any script at both ends."""
    return F.regexp_replace(col, r"(?U)^\s+|\s+$", "")


def last_segment(url: Column) -> Column:
    """What follows the last slash; empty when the URL ends with one."""
    return F.element_at(F.split(url, "/"), -1)
