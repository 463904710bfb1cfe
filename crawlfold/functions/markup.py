"""Tags in their order and nesting, read with built-in functions.

One pattern per page reads comments, script and style bodies, tags with quoted values, and text, so that nothing
that merely looks like a tag counts as one. `pieces` cuts a page in front of the tags of the names asked for;
`code` gives each piece a letter, and a fold over the letters keeps the open elements as a string of letters, so
it compares short texts and runs no pattern per tag.

Elements that HTML lets stay open are closed by the rules for them: a list item ends where the next one of its list
begins, a link where the next link begins, and whatever is still open inside an element ends with it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What follows a tag's name. A quote opens a value only right after an equals sign; a tag may be cut off by the page's end.
_REST = r"""(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+>?+"""
_COMMENT = r"<!--(?:-?>|.*?(?:--!?>|\z))"
#: Elements whose content is text, whatever it looks like.
_RAW = r"script|style|textarea|xmp|iframe|noembed|noframes"


#: A script's body, or nothing for a comment.
SCRIPT = rf"(?is){_COMMENT}|<script(?=[\s/>]){_REST}(.*?)(?:</script|\z)"


def visible(html: Column) -> Column:
    """The page without comments and without elements that hold raw text, scripts among them."""
    hidden = rf"(?is){_COMMENT}|<({_RAW})(?=[\s/>]){_REST}.*?(?:</\1(?=[\s/>]){_REST}|\z)|(</?[a-z]{_REST})"
    some = html.contains("<!--") | html.rlike(rf"(?i)<(?:{_RAW})[\s/>]")
    return F.when(some, F.regexp_replace(html, hidden, "$2")).otherwise(html)


def scripts(html: Column) -> Column:
    """Bodies of all scripts that are not commented out, in order. What is no script gives the empty text."""
    return F.regexp_extract_all(html, F.lit(SCRIPT), F.lit(1))


def pieces(shown: Column, *names: str) -> Column:
    """A `visible` text cut in front of every opening and closing tag of the names; what stands in front of the first such tag is a piece too."""
    tag = rf"</?(?:{'|'.join(names)})(?=[\s/>])"
    other = rf"[^<]++|<(?!/?(?:{'|'.join(names)})[\s/>])(?:/?[a-z]{_REST})?+"
    return F.regexp_extract_all(shown, F.lit(rf"(?is)(?:{tag}{_REST}|\A)(?:{other})*+"), F.lit(0))


def leading_text(piece: Column) -> Column:
    """The text right behind the tag that a piece begins with, empty when another tag follows."""
    return F.regexp_extract(piece, rf"(?is)^</?[a-z][^\s/>]*+{_REST}([^<]+)", 1)


def code(piece: Column, letters: dict[str, str], special: dict[str, tuple[str, str]] = {}) -> Column:
    """Letter of the tag a piece begins with: small for an opening tag, capital for its closing tag, else empty.

    `letters` maps the first letter of a name, which has to tell the names apart, to the letter to use. `special`
    maps it to another letter for opening tags that match a pattern.
    """
    table = F.create_map(*[F.lit(x) for k, v in letters.items() for x in (f"<{k}", v, f"</{k}", v.upper())])
    key = F.lower(F.when(piece.startswith("</"), F.substring(piece, 1, 3)).otherwise(F.substring(piece, 1, 2)))
    found = F.coalesce(F.try_element_at(table, key), F.lit(""))
    for name, (letter, pattern) in special.items():
        found = F.when((key == f"<{name}") & piece.rlike(f"(?s)^(?:{pattern})"), F.lit(letter)).otherwise(found)
    return found


def closed(path: Column, letters: str, stops: str = "") -> Column:
    """`path`, the open elements from outside in, after a closing tag: the innermost element written as one of
    `letters` ends, and all inside it. Without one, or with one of `stops` further inside, nothing does."""
    return F.regexp_replace(path, f"[{letters}][^{letters}{stops}]*$", "")
