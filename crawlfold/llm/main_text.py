"""Main text of web pages by paths on which the pages of a host agree.

1. Every page scores its containers and votes for the generalised path (tags and classes from the
   root) of the best one.
2. Spark adds up per host the votes for a path and the pages that have it; several paths win.
3. Every page is read again: the text under the best of the winning paths that it has, or under its own
   best container where it has none of them, or where that stands out and other pages do not vote it down.
"""

from __future__ import annotations

import html
import re
from collections import Counter

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from crawlfold.llm.exchange import as_text
from crawlfold.session import written

# Elements of the HTML standard by their part in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes".split())
BLOCK = frozenset((
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section summary table tbody td tfoot "
    "th thead tr ul"
).split())
BOILER = frozenset("nav header footer aside button select dialog menu head svg math object audio video canvas".split())
#: Elements that end where one of these begins, unless one of the others stands between: the rules for end tags left out.
ENDS = {
    "li": ({"li"}, BLOCK - {"li", "address", "div", "p"}), "dt": ({"dt", "dd"}, BLOCK - {"dt", "dd", "address", "div", "p"}),
    "td": ({"td", "th", "caption"}, {"table"}), "tr": ({"tr", "caption"}, {"table"}), "tbody": ({"tbody", "thead", "tfoot", "caption"}, {"table"}),
}
ENDS |= {"dd": ENDS["dt"], "th": ENDS["td"], "thead": ENDS["tbody"], "tfoot": ENDS["tbody"]}
CONTAINER = frozenset("article main section div td body".split())
CLOSES_P = BLOCK - {"html", "body"}
#: A path wins with two votes, a quarter of the pages that have it, and one percent of the host's votes.
MIN_VOTES = 2
MIN_PERCENT_OF_HOLDERS = 25
MIN_PERCENT_OF_HOST = 1
#: A page's own container stands against winning paths if it is an `article` or `main`, or scores so many times as much.
STANDS_OUT = 4
#: What a container adds of its score to the one around it.
DECAY = 0.95
# Words that mark what is not main text, where a class, id or role consists of them and of words
# that say nothing about it.
MARKS = frozenset((
    "ad ads advert advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus "
    "footer header menu modal nav navbar navigation newsletter notice overlay pager pagination popup promo promoted "
    "related reply replies respond share sharing sidebar signup skip social sponsor sponsored subscribe toolbar widget"
).split())
NEUTRAL = frozenset((
    "area areas bar bars block blocks bottom box boxes button buttons col container group inner item items left link links list lists "
    "outer panel post posts right row section sections site slot slots top user users wrap wrapper"
).split())
#: A quote opens a value only right after an equals sign, and only if it is closed.
_TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)(?:>|\Z)", re.S)
_ATTR = re.compile(r"""([^\s/>="'][^\s/>=]*+)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s>]++))?""")
_ASKED = frozenset("class id role hidden style aria-hidden".split())
_LETTERS = re.compile(r"[a-z]+")
_SPACE = re.compile(r"[\x20\x09-\x0D\xa0]+")
_DIGITS = re.compile(r"\d+")
_END = {name: re.compile(rf"</{name}[\s/>]", re.I) for name in RAW}


def _attributes(text: str) -> dict[str, str]:
    """The attributes that count, the first of each name."""
    out: dict[str, str] = {}
    if text and not text.isspace():
        for name, value in _ATTR.findall(text):
            if (name := name.lower()) in _ASKED:
                out.setdefault(name, value[1:-1] if value[:1] in ("'", '"') and value[-1:] == value[:1] else value)
    return out


def _step(name: str, attrs: dict[str, str]) -> str:
    """A step of a path: the tag and its sorted classes, numbers taken out."""
    classes = sorted(set(_DIGITS.sub("", attrs.get("class", "").lower()).split()))
    return ".".join([name, *classes])


def _hidden(attrs: dict[str, str]) -> bool:
    if not attrs:
        return False
    style = attrs.get("style", "").replace(" ", "").lower()
    return "hidden" in attrs or attrs.get("aria-hidden", "").lower() == "true" or "display:none" in style


def _marked(attrs: dict[str, str]) -> bool:
    """Whether a class, id or role, like `ad-1`, `cookie-notice` or `comment-list` but not `has-sidebar`, marks the element."""
    for said in (attrs.get("class", ""), attrs.get("id", ""), attrs.get("role", "")) if attrs else ():
        for value in said.lower().split():
            parts = _LETTERS.findall(value)
            if any(p in MARKS for p in parts) and all(p in MARKS or p in NEUTRAL for p in parts):
                return True
    return False


#: Letters of a path, and of one step, that are written out; a hash stands for what comes before, or for the classes.
_WRITTEN = 400


def _path(around: str, step: str) -> str:
    """Path of an element: that of the one around it and its own step. Its length does not grow with depth."""
    if len(step) > _WRITTEN:
        step = f"{step.partition('.')[0]}.#{xxhash.xxh64_hexdigest(step)}"
    if len(around) > _WRITTEN:
        around = f"#{xxhash.xxh64_hexdigest(around)}"
    return f"{around}/{step}"


def _tag(path: str) -> str:
    return path.rpartition("/")[2].partition(".")[0]


class Page:
    """Blocks of a page in order, each with the containers it stands in; boilerplate left out.

    One run over the tags. `blocks` are (container number, text); container 0 is the whole page.
    Marked elements, and forms, are left out once the whole page is known, see `_settle`; `article` and `main` never by a mark.
    """

    def __init__(self, source: str):
        self.paths, self.parents, self.links = [""], [-1], [0]
        self.blocks: list[tuple[int, str]] = []
        stack: list[tuple[str, int, bool, str, int]] = []  # name, container, dropped, path, marked element
        box, dropped, path, mark = 0, False, "", 0
        found: list[tuple[int, int, str]] = []  # marked element, container, text
        marks = [-1]  # the marked element around each marked element; 0 is none
        linked: dict[tuple[int, int], int] = {}
        heads: list[int] = []
        parts: list[str] = []
        in_link = 0

        def flush() -> None:
            if parts:
                text = _SPACE.sub(" ", html.unescape("".join(parts))).strip(" ")
                if text:
                    found.append((mark, box, text))
                parts.clear()

        at, n = 0, len(source)
        while at < n:
            m = _TOKEN.search(source, at)
            if m is None:
                if not dropped:
                    parts.append(source[at:])
                break
            if m.start() > at and not dropped:
                parts.append(source[at : m.start()])
                if in_link:
                    linked[mark, box] = linked.get((mark, box), 0) + m.start() - at
            at = m.end()
            name = m.group(2)
            if name is None:
                continue
            name = name.lower()
            if m.group(1):  # closing tag: closes the nearest open element of its name
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == name:
                        if name in BLOCK or any(s[0] in BLOCK for s in stack[i:]) or (stack[i - 1][4] if i else 0) != mark:
                            flush()
                        del stack[i:]
                        box, dropped, path, mark = (stack[-1][1:] if stack else (0, False, "", 0))
                        break
                if name == "a":
                    in_link = 0
                continue
            if name == "br":
                if not dropped:
                    parts.append(" ")
                continue
            attrs = _attributes(m.group(3))
            if name in RAW:
                end = _END[name].search(source, at)
                at = end.start() if end else n
                continue
            if name in VOID:
                if name == "hr":
                    flush()
                continue
            if name in BLOCK:
                flush()
                if name in ENDS:
                    ended, stops = ENDS[name]
                    for i in range(len(stack) - 1, -1, -1):
                        if stack[i][0] in ended:
                            del stack[i:]
                            box, dropped, path, mark = (stack[-1][1:] if stack else (0, False, "", 0))
                            break
                        if stack[i][0] in stops:
                            break
                if name in CLOSES_P:  # an open paragraph ends where a block begins
                    for i in range(len(stack) - 1, -1, -1):
                        if stack[i][0] == "p":
                            del stack[i:]
                            box, dropped, path, mark = (stack[-1][1:] if stack else (0, False, "", 0))
                            break
                        if stack[i][0] in CONTAINER or stack[i][0] in ("li", "table", "blockquote"):
                            break
            if m.group(3).endswith("/") and name not in BLOCK:
                continue
            if name == "a":
                in_link = 1
            # The header of an article has its headline.
            boiler = name in BOILER and not (name == "header" and any(x[0] in ("article", "main") for x in stack))
            gone = dropped or boiler or (name not in ("html", "body") and _hidden(attrs))
            odd = not gone and name not in ("html", "body", "article", "main") and (name == "form" or _marked(attrs))
            if odd or (gone and not dropped):
                flush()
            if odd:
                marks.append(mark)
                mark = len(marks) - 1
            step = _path(path, _step(name, attrs)) if name in BLOCK else path
            if name in CONTAINER and not gone:
                self.paths.append(step)
                self.parents.append(box)
                self.links.append(0)
                box = len(self.paths) - 1
            if name == "h1" and not gone:
                heads.append(box)
            stack.append((name, box, gone, step, mark))
            dropped, path = gone, step
        flush()
        left_out = self._settle(found, marks, heads)
        self.blocks = [(box, text) for mark, box, text in found if not left_out[mark]]
        for (mark, box), n in linked.items():
            if not left_out[mark]:
                self.links[box] += n

    def _settle(self, found: list[tuple[int, int, str]], marks: list[int], heads: list[int]) -> list[bool]:
        """Which marked elements are left out.

        One stays if it holds most of the page's text, or one `article` or `main` and more text than stands
        outside marks, unless the page has its main text elsewhere: an `article` or `main` without a mark around
        it, or a container with an `h1` and more. All stay if nothing else is left.
        """
        if len(marks) == 1:
            return [False]
        size = [0] * len(marks)
        proper: list[set[int]] = [set() for _ in marks]
        for mark, box, text in found:
            around = {b for b in self._around(box) if _tag(self.paths[b]) in ("article", "main")}
            while mark >= 0:
                size[mark] += len(text)
                proper[mark] |= around
                mark = marks[mark]
        heads = [b for b in heads if _tag(self.paths[b]) not in ("body", "")]
        out = [False] + [True] * (len(marks) - 1)

        def elsewhere() -> bool:
            under = dict.fromkeys(heads, 0)
            for mark, box, _ in found:
                if not out[mark]:
                    for b in self._around(box):
                        if _tag(self.paths[b]) in ("article", "main"):
                            return True
                        if b in under:
                            under[b] += 1
            return any(n > 1 for n in under.values())

        for i in range(1, len(marks)):
            if not out[marks[i]] and (2 * size[i] > size[0] or (
                    len(proper[i]) == 1 and size[i] > sum(len(t) for mark, _, t in found if not out[mark]))):
                out[i] = elsewhere()
        return out if any(not out[mark] for mark, _, _ in found) else [False] * len(marks)

    def _around(self, box: int):
        while box >= 0:
            yield box
            box = self.parents[box]

    def scores(self) -> list[float]:
        """Per container its text that is not in links, and nearly all that its containers, at any depth, score.

        So a container of two blocks beats the longer one, unless the other is under a twentieth of it, and a
        wrapper of one block does not. `article` and `main` count more. Lists of links add nothing further up.
        """
        score = [0.0] * len(self.paths)
        for box, text in self.blocks:
            score[box] += len(text) + 20
        for i in range(len(score) - 1, 0, -1):  # containers come before those inside
            score[i] -= 2 * self.links[i]
            score[self.parents[i]] += DECAY * max(score[i], 0.0)
        score[0] -= 2 * self.links[0]
        weight = {"article": 4.0, "main": 3.0, "body": 0.5, "": 0.5}
        return [x * weight.get(_tag(path), 1.0) for x, path in zip(score, self.paths)]

    def best(self, score: list[float] | None = None) -> int:
        """The container with the greatest score, or the nearest `article` or `main` around it."""
        score = score or self.scores()
        top = max(score)
        if top <= 0:
            return 0
        box = score.index(top)
        return next((b for b in self._around(box) if _tag(self.paths[b]) in ("article", "main")), box)

    def under(self, chosen: set[int]) -> str:
        inside: dict[int, bool] = {-1: False}
        for i, parent in enumerate(self.parents):
            inside[i] = i in chosen or inside[parent]
        return "\n".join(text for box, text in self.blocks if inside[box])

    def held(self) -> set[str]:
        """Paths of the containers that have text."""
        boxes: set[int] = set()
        for box, _ in self.blocks:
            for b in self._around(box):
                if b in boxes:
                    break
                boxes.add(b)
        return {self.paths[b] for b in boxes}

    def text(self, winners: list[str] | None, denied: list[str] | None = None) -> str:
        """Text under all containers with the best of the winning paths by the page's own scores, or under its own best."""
        score = self.scores()
        own = self.best(score)
        path = self.paths[own]
        present = self.held().intersection(winners or ())
        if not present:
            return self.under({own})
        if path not in present:
            at, box = max((x, -i) for i, (x, p) in enumerate(zip(score, self.paths)) if p in present)
            stands = _tag(path) in ("article", "main") or score[own] >= STANDS_OUT * at
            if stands and path not in (denied or ()):
                return self.under({own})
            path = self.paths[-box]
        return self.under({i for i, p in enumerate(self.paths) if p == path})


def host_of(url: Column) -> Column:
    """Host of a URL in small letters, empty if there is none."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def _votes(batches):
    for batch in batches:
        votes: Counter = Counter()
        held: Counter = Counter()
        for host, source in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
            page = Page((source or b"").decode("utf-8", "replace"))
            votes[host, page.paths[page.best()]] += 1
            held.update((host, path) for path in page.held())
        keys = list(votes.keys() | held.keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()),
             pa.array([votes[k] for k in keys], pa.int64()), pa.array([held[k] for k in keys], pa.int64())],
            names=["host", "path", "votes", "held"])


def _texts(n_own: int):
    def extract(batches):
        for batch in batches:
            found = []
            for source, winners, denied in zip(*(batch.column(n_own + i).to_pylist() for i in range(3))):
                found.append(Page((source or b"").decode("utf-8", "replace")).text(winners, denied).encode("utf-8", "replace"))
            names = [batch.schema.field(i) for i in range(n_own)] + [pa.field("__main", pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(n_own)] + [as_text(found)], schema=pa.schema(names))

    return extract


def _judged_paths(pages: DataFrame, url_col: str, html_col: str) -> DataFrame:
    """`host`, `path`, `votes`, `held` (pages with text at the path), `wins`: winning paths, and those voted down.

    A path is voted down if it has a vote and does not win, though other pages have it. Paths that fewer pages
    have than one percent of the host's votes are not judged, so a host has at most a hundred winners. The pages of
    host "" do not belong together and do not vote. Votes are added up on the map side, so a hot host is a few
    rows per task.
    """
    asked = pages.select(host_of(F.col(f"`{url_col}`")).alias("host"), F.col(f"`{html_col}`").cast("binary").alias("html"))
    asked = asked.filter("host <> ''").mapInArrow(_votes, "host string, path string, votes long, held long")
    votes = asked.groupBy("host", "path").agg(F.sum("votes").alias("votes"), F.sum("held").alias("held"))
    votes = votes.filter("path <> '' and votes > 0").withColumn("__all", F.sum("votes").over(Window.partitionBy("host")))
    wins = (f"votes >= {MIN_VOTES} and 100 * votes >= {MIN_PERCENT_OF_HOLDERS} * held "
            f"and 100 * votes >= {MIN_PERCENT_OF_HOST} * __all")
    return votes.withColumn("wins", F.expr(wins)).filter(
        f"wins or (held > 1 and 100 * held >= {MIN_PERCENT_OF_HOST} * __all)").drop("__all")


def host_paths(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per host and winning path: `host`, `path`, `votes`, and `held`, the host's pages that have the path."""
    return _judged_paths(pages, url_col, html_col).filter("wins").drop("wins")


def extract(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """The columns of `pages` without the HTML, and `__main`: the main text, blocks joined by a line feed.

    NULL, empty and textless pages give an empty text. A page with a NULL or hostless URL is judged alone.
    Repeated rows vote each for itself and get equal texts. Columns that begin with `__` are reserved.

    The winners, one row per host, are stored first: their size is then known, so that Spark
    sends them to all tasks only if they are small, and else joins by host with skewed hosts split.
    """
    judged = _judged_paths(pages, url_col, html_col).groupBy(F.col("host").alias("__host")).agg(
        F.collect_list(F.when(F.col("wins"), F.col("path"))).alias("__paths"),
        F.collect_list(F.when(~F.col("wins"), F.col("path"))).alias("__denied"))
    own = [c for c in pages.columns if c != html_col]
    rows = pages.withColumn("__host", host_of(F.col(f"`{url_col}`"))).join(written(judged), "__host", "left").select(
        *(f"`{c}`" for c in own), F.col(f"`{html_col}`").cast("binary").alias("__html"), "__paths", "__denied")
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in pages.schema.fields if f.name != html_col]
    return rows.mapInArrow(_texts(len(own)), ", ".join([*kept, "__main string"]))


def op8_main_text(spark: SparkSession, sf: str) -> DataFrame:
    found = extract(spark.read.parquet(f"{sf}/pages.parquet"))
    return found.select("page_id", "url", F.col("__main").alias("text"), F.length("__main").cast("long").alias("n_chars"))
