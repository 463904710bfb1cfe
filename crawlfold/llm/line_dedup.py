"""Lines that several documents share, kept in the first of them only.

An index holds, for each range of line hashes, a minimal perfect hash over the distinct hashes and, by
its numbers, an array of fingerprints, one of document counts and one of first documents. Documents
probe these arrays; lines are never joined with lines.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlfold.llm import perfect_hash
from crawlfold.llm.exchange import (
    BODY, ID, SHARD, WHITE, Rows, as_text, by_shard, cuts, hash128, longs, parts_of, schema_of, texts, whole, tidy,
)
from crawlfold.session import written

BYTES_PER_SHARD = 8 << 20
_BUFFER = 16 << 20
_ASKED = pa.schema([("part", pa.int32()), (SHARD, pa.int64()), ("high", pa.binary()), ("low", pa.binary()),
                    ("first", pa.binary()), ("docs", pa.binary())])
_INDEX = pa.schema([("part", pa.int32()), ("hash", pa.binary()), ("prints", pa.binary()), ("docs", pa.binary()),
                    ("first", pa.binary()), ("twins", pa.binary())])
_TOLD = pa.schema([(SHARD, pa.int64()), ("high", pa.binary()), ("low", pa.binary()), ("first", pa.binary())])
ASKED = f"part int, {SHARD} long, high binary, low binary, first binary, docs binary"
INDEX = "part int, hash binary, prints binary, docs binary, first binary, twins binary"
TOLD = f"{SHARD} long, high binary, low binary, first binary"
_PAIR = np.dtype([("high", np.uint64), ("low", np.uint64)])


def line_key(line: bytes) -> bytes:
    """White space stripped at both ends, A-Z lower-cased."""
    return line.strip(WHITE).lower()


def _long_enough(key: bytes, min_chars: int) -> bool:
    if len(key) < min_chars:
        return False
    return key.isascii() or sum((b & 0xC0) != 0x80 for b in key) >= min_chars


def _pairs(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    out = np.empty(len(high), _PAIR)
    out["high"], out["low"] = high, low
    return out


def _summed(high, low, first, docs):
    """Distinct (high, low), sorted, with the smallest first document and the sum of documents."""
    order = np.lexsort((low, high))
    high, low, first, docs = high[order], low[order], first[order], docs[order]
    new = np.r_[True, (high[1:] != high[:-1]) | (low[1:] != low[:-1])]
    at = np.flatnonzero(new)
    return high[at], low[at], np.minimum.reduceat(first, at), np.add.reduceat(docs, at)


def _questions(parts: int, min_chars: int):
    def ask(batches):
        rows = Rows(_ASKED)
        for shard, ids, bodies in by_shard(batches, _BUFFER):
            keys, owners = [], []
            for doc, body in zip(ids, bodies):
                own = {k for k in map(line_key, (body or b"").split(b"\n")) if _long_enough(k, min_chars)}
                keys += own
                owners += [doc] * len(own)
            if not keys:
                continue
            both = hash128(keys)
            found = _summed(both[:, 0], both[:, 1], np.array(owners, np.int64), np.ones(len(keys), np.int64))
            for p, s in cuts(found[0], parts):
                yield from rows.add(p, shard, *(x[s].tobytes() for x in found))
        yield from rows.rest()

    return ask


def _index(table: pa.Table) -> pa.Table:
    columns = [np.concatenate([longs(x, kind) for x in table.column(n).to_pylist()])
               for n, kind in (("high", np.uint64), ("low", np.uint64), ("first", np.int64), ("docs", np.int64))]
    high, low, first, docs = _summed(*columns)
    lead = np.r_[True, high[1:] != high[:-1]]  # the rest are different lines with an equal upper half
    packed = perfect_hash.build(high[lead])
    at = perfect_hash.probe(packed, high[lead])
    prints, counts, firsts = np.empty(len(at), np.uint32), np.empty(len(at), np.uint32), np.empty(len(at), np.int64)
    prints[at] = low[lead].astype(np.uint32)
    counts[at] = np.minimum(docs[lead], 2**32 - 1)
    firsts[at] = first[lead]
    odd = np.isin(high, high[~lead])  # all lines with a shared upper half, in full
    twins = np.stack([high[odd].view(np.int64), low[odd].view(np.int64), first[odd], docs[odd]]).tobytes()
    rows = Rows(_INDEX)
    list(rows.add(table.column("part")[0].as_py(), packed, prints.tobytes(), counts.tobytes(), firsts.tobytes(), twins))
    return rows.table()


def _answers(min_docs: int):
    def tell(asked: pa.Table, index: pa.Table) -> pa.Table:
        rows = Rows(_TOLD)
        (entry,) = index.to_pylist()
        prints, counts = longs(entry["prints"], np.uint32), longs(entry["docs"], np.uint32)
        firsts = longs(entry["first"], np.int64)
        twins = longs(entry["twins"], np.int64).reshape(4, -1)
        twin = {(h, w): (f, n) for h, w, f, n in zip(*(x.tolist() for x in twins))}
        out = []
        for row in asked.select([SHARD, "high", "low"]).to_pylist():
            high, low = longs(row["high"]), longs(row["low"])
            at = perfect_hash.probe(entry["hash"], high)
            found = (counts[at] >= min_docs) & (prints[at] == low.astype(np.uint32))
            first = firsts[at].copy()
            if twin:
                for i in np.flatnonzero(np.isin(high.view(np.int64), twins[0])).tolist():
                    f, n = twin[int(high.view(np.int64)[i]), int(low.view(np.int64)[i])]
                    found[i], first[i] = n >= min_docs, f
            if found.any():
                out += rows.add(row[SHARD], high[found].tobytes(), low[found].tobytes(), first[found].tobytes())
        out += rows.rest()
        return pa.Table.from_batches(out, schema=_TOLD)

    return tell


def _kept(min_chars: int):
    def keep(docs: pa.Table, told: pa.Table) -> pa.Table:
        high, low, first = (np.concatenate([longs(x, kind) for x in told.column(n).to_pylist()] or [np.empty(0, kind)])
                            for n, kind in (("high", np.uint64), ("low", np.uint64), ("first", np.int64)))
        shared = {p: f for p, f in zip(_pairs(high, low).tolist(), first.tolist())}
        bodies, n_lines, n_dropped = [], [], []
        for doc, body in zip(docs.column(ID).to_pylist(), docs.column(BODY).to_pylist()):
            lines = (body or b"").split(b"\n")
            keys = [line_key(x) for x in lines]
            ask = [i for i, k in enumerate(keys) if _long_enough(k, min_chars)] if shared else []
            gone = set()
            if ask:
                pairs = map(tuple, hash128([keys[i] for i in ask]).tolist())
                gone = {i for i, pair in zip(ask, pairs) if shared.get(pair, doc) != doc}
            bodies.append(b"\n".join([x for i, x in enumerate(lines) if i not in gone]) if gone else body)
            n_lines.append(len(lines))
            n_dropped.append(len(gone))
        return (docs.drop_columns([SHARD, ID, BODY])
                .append_column("__text", as_text(bodies))
                .append_column("__n_lines", pa.array(n_lines, pa.int64()))
                .append_column("__n_dropped", pa.array(n_dropped, pa.int64())))

    return keep


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, min_chars: int = 10,
                min_docs: int = 2, carry: bool = True, bytes_per_shard: int = BYTES_PER_SHARD) -> DataFrame:
    """Drop every line whose key stands in `min_docs` documents or more, but for the smallest id that holds it.

    A line is what stands between two `\\n`; its key is `line_key`. Keys under `min_chars` code points
    stay. Result: the columns of `docs` (without `carry`, the id alone) and `__text` (the lines that
    stay), `__n_lines` (before), `__n_dropped`. A NULL text stays NULL and counts as one empty line; an
    empty one is one empty line. Rows with an equal id are one document: they never drop each other's
    lines. A NULL id is an id before all others. Any further columns pass through as they are; names
    that begin with `__` are reserved.
    """
    base = texts(docs, id_col, text_col, bytes_per_shard)
    parts = parts_of(docs)
    asked = written(base.mapInArrow(tidy(_questions(parts, min_chars)), ASKED))
    index = written(asked.groupBy("part").applyInArrow(tidy(_index), INDEX))
    told = asked.groupBy("part").cogroup(index.groupBy("part")).applyInArrow(tidy(_answers(min_docs)), TOLD)
    rows = whole(docs, id_col, text_col, bytes_per_shard, carry)
    schema = schema_of(rows, "__text string, __n_lines long, __n_dropped long")
    return rows.groupBy(SHARD).cogroup(told.groupBy(SHARD)).applyInArrow(tidy(_kept(min_chars)), schema)


def op9_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    found = dedup_lines(spark.read.parquet(f"{sf}/documents.parquet"), carry=False)
    return found.select(
        "doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_dropped").alias("n_dropped"),
        F.sha2(F.coalesce("__text", F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )


SQL = r"""
with lines as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as i
  from documents),
keyed as (
  select doc_id, i, line,
         translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as k
  from lines),
shared as (
  select k, min(doc_id) as keep from keyed where length(k) >= 10 group by k having count(distinct doc_id) >= 2),
judged as (
  select doc_id, i, line, coalesce(keep <> doc_id, false) as gone from keyed left join shared using (k))
select doc_id, count(*)::bigint as n_lines, (count(*) filter (where gone))::bigint as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by i) filter (where not gone), '')) as kept_sha256
from judged group by doc_id
"""
