"""Passages of a benchmark inside documents, found by one Aho-Corasick automaton.

The automaton holds every window of the normalised items, a node for a word: words are numbered, and a word that
no item has is 0. Each text is normalised and scanned once; hits are mapped back to places in the text as it was.
"""

from __future__ import annotations

import re
import uuid

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlfold.llm.exchange import tidy
from crawlfold.session import written

WINDOW = 10
#: Bytes of items in one automaton, which takes about a hundred times that. More items are scanned for slice by slice.
SLICE_BYTES = 2 << 20
_LETTERS = bytes(range(0x30, 0x3A)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
_NORMAL = bytes(c if (c := (b + 32 if 0x41 <= b <= 0x5A else b)) in _LETTERS else 0x20 for b in range(256))
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
_SPANS = "array<struct<start:int,end:int>>"
_FOUND = pa.schema([
    ("__n_words", pa.int64()), ("__n_hit", pa.int64()), ("__items", pa.list_(pa.string())),
    ("__spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
])


def words(text: bytes | None) -> list[bytes]:
    """Runs of ASCII digits and letters, A-Z lower-cased, and of anything beyond ASCII."""
    return (text or b"").translate(_NORMAL).split()


class Automaton:
    """Windows of n words of some items, an item with fewer words, but not none, being one window."""

    def __init__(self, items: list[tuple[str, bytes]], n: int):
        self.number: dict[bytes, int] = {}
        self.sizes: list[int] = []
        self.owners: list[list[str]] = []
        found = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
        for item, text in items:
            own = tuple(self.number.setdefault(w, len(self.number) + 1) for w in words(text))
            for i in range(max(len(own) - n, 0) + 1 if own else 0):
                window = own[i : i + n]
                at = found.get(window, -1)
                if at < 0:
                    found.add_word(window, len(self.sizes))
                    self.sizes.append(len(window))
                    self.owners.append([item])
                elif self.owners[at][-1] != item:
                    self.owners[at].append(item)
        self.found = found if self.sizes else None
        if self.found:
            found.make_automaton()

    def hits(self, own: list[bytes]) -> tuple[np.ndarray, set[str]]:
        """Which of a text's words lie inside a window of an item, and the items."""
        covered, items = np.zeros(len(own), bool), set()
        if self.found is None or not own:
            return covered, items
        for end, at in self.found.iter(tuple(self.number.get(w, 0) for w in own)):
            covered[end - self.sizes[at] + 1 : end + 1] = True
            items.update(self.owners[at])
        return covered, items


_BUILT: dict[str, Automaton] = {}


def _automaton(name: str, items, n: int) -> Automaton:
    """The automaton of a slice, built once per worker, which keeps the latest one."""
    if name not in _BUILT:
        _BUILT.clear()
        _BUILT[name] = Automaton(items.value, n)
    return _BUILT[name]


def spans(text: bytes, covered: np.ndarray) -> list[dict]:
    """Code-point ranges of the original text that the covered runs of words fill."""
    edge = np.flatnonzero(np.diff(np.r_[0, covered.view(np.int8), 0]))
    if not len(edge):
        return []
    places = [m.span() for m in _WORD.finditer(text)]
    points = lambda a, b: sum((c & 0xC0) != 0x80 for c in text[a:b])
    out, at, before = [], 0, 0
    for first, end in edge.reshape(-1, 2).tolist():
        a, b = places[first][0], places[end - 1][1]
        start = before + points(at, a)
        out.append({"start": start, "end": start + points(a, b)})
        at, before = b, out[-1]["end"]
    return out


def _scan(name: str, items, n: int, text_at: int, last: bool):
    """Scan with the items of one slice; what earlier slices covered comes in the last two columns."""

    def scan(batches):
        found = _automaton(name, items, n)
        for batch in batches:
            texts = batch.column(text_at).to_pylist()
            before = zip(batch.column(batch.num_columns - 2).to_pylist(), batch.column(batch.num_columns - 1).to_pylist())
            rows = []
            for text, (old, old_items) in zip(texts, before):
                own = words(text)
                covered, who = found.hits(own)
                if old:
                    covered |= np.unpackbits(np.frombuffer(old, np.uint8), count=len(own)).astype(bool)
                who.update(old_items)
                if last:
                    rows.append((len(own), int(covered.sum()), sorted(who), spans(text or b"", covered)))
                else:
                    rows.append((np.packbits(covered).tobytes(), sorted(who)))
            if last:
                names = [i for i in range(batch.num_columns - 2) if i != text_at]
                fields = [batch.schema.field(i) for i in names] + list(_FOUND)
                new = [pa.array([r[j] for r in rows], f.type) for j, f in enumerate(_FOUND)]
            else:
                names = list(range(batch.num_columns - 2))
                fields = [batch.schema.field(i) for i in names] + [("__covered", pa.binary()), ("__who", pa.list_(pa.string()))]
                new = [pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in names] + new, schema=pa.schema(fields))

    return scan


def find(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
         item_text_col: str = "text", *, window: int = WINDOW, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """All columns of `docs` and `__n_words`, `__n_hit` (words inside a window of an item), `__items`
    (those items, sorted as strings), `__spans` (code-point ranges of the hit runs in the original text).

    A NULL or wordless text has no words and no hits; an item without words matches nothing; an empty
    benchmark hits nothing. Items with equal windows are all reported; a NULL item id reads "null".
    Repeated rows are judged each for itself. Columns that begin with `__` are reserved.

    Only the benchmark leaves the executors, in slices of about `slice_bytes`, one after the other: its size is summed
    first, and a larger one is scanned for in several automata, each over all documents. What a slice has covered is
    stored before the next one is sent, so that one automaton at a time is in memory.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("null")).alias("item"),
                             F.col(item_text_col).cast("binary").alias("text")).filter(F.col("text").isNotNull())
    size = items.agg(F.coalesce(F.sum(F.octet_length("text") + 64), F.lit(0))).first()[0]
    slices = max(1, -(-size // slice_bytes))
    named = F.col(f"`{text_col}`")
    out = docs.select("*", named.cast("binary").alias("__body"), F.lit(None).cast("binary").alias("__covered"),
                      F.array().cast("array<string>").alias("__who"))
    at = len(docs.columns)
    own = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields]
    for i in range(slices):
        last = i == slices - 1
        part = items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(slices)) == i).collect()
        sent = spark.sparkContext.broadcast([(r["item"], bytes(r["text"])) for r in part])
        more = (["__n_words long", "__n_hit long", "__items array<string>", f"__spans {_SPANS}"] if last
                else ["__body binary", "__covered binary", "__who array<string>"])
        out = out.mapInArrow(tidy(_scan(uuid.uuid4().hex, sent, window, at, last)), ", ".join(own + more))
        if not last:
            out = written(out)
            sent.unpersist()
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", *, window: int = WINDOW) -> DataFrame:
    """The documents that hold no window of any item, with their own columns."""
    return find(docs, benchmark, text_col, window=window).filter("__n_hit = 0").select(*(f"`{c}`" for c in docs.columns))


def op3_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    return find(docs, spark.read.parquet(f"{sf}/benchmark.parquet")).select(
        "doc_id", F.col("__n_words").alias("n_words"), F.col("__n_hit").alias("n_hit"),
        F.size("__items").cast("long").alias("n_items"),
        F.sha2(F.array_join("__items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("__n_hit") > 0).alias("contaminated"),
    )


SQL = r"""
with dw as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
iw as (
  select item_id::varchar as item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
win as (
  select distinct item, least(len(w), 10) as n, array_to_string(w[i:i+least(len(w), 10)-1], ' ') as t
  from (select item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as i from iw where len(w) > 0)),
sizes as (select distinct n from win),
place as (
  select doc_id, i, n, array_to_string(w[i:i+n-1], ' ') as t
  from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i from dw, sizes where len(w) >= n)),
hit as (select doc_id, i, place.n, item from place join win using (t) where place.n = win.n),
covered as (
  select doc_id, count(distinct k) as n_hit
  from (select doc_id, unnest(range(i, i + n)) as k from (select distinct doc_id, i, n from hit)) group by doc_id),
named as (
  select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items
  from (select distinct doc_id, item from hit) group by doc_id)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
       sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from dw left join covered using (doc_id) left join named using (doc_id)
"""
