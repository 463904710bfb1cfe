"""Shards of documents and packed questions between them and the holders of a key range.

Several operators ask the whole corpus about something that occurs in a document: a line, a phrase,
a gram. They do it in the same three steps:

1. each shard of documents packs its *distinct* keys, sorted, into one row per key range ("part");
2. the holder of a part sees the rows of all shards and answers each of them;
3. the answers come back to the shard, where the documents are read once more.

A key that a third of all documents hold is one entry per shard, whatever its count, so no part is
flooded by a hot key and no list of its documents is ever built.
"""

from __future__ import annotations

import contextlib
import ctypes
import inspect
import resource
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHARD = "__llm_shard"
ID = "__llm_id"
BODY = "__llm_text"
#: Stands for a document id that is NULL: one document, before all others.
NULL_ID = -(2**63)
#: White space of the word and line rules: space and 0x09 to 0x0D.
WHITE = b" \t\n\x0b\x0c\r"


def shard_of(docs: DataFrame, id_col: str, bytes_per_shard: int) -> Column:
    """Shard number of a document: its file, cut by a hash of the id if the file is large.

    It depends on the stored data alone, not on how Spark splits a scan, so two scans agree.
    A frame that is not read from files is cut by the id alone, one shard per shuffle partition.
    """
    spread = F.xxhash64(F.col(f"`{id_col}`"))
    if "_metadata" not in docs.columns:
        try:
            size = F.col("_metadata.file_size")
            docs.select(size)
            cuts = F.ceil(size / F.lit(bytes_per_shard))
            return F.xxhash64(F.col("_metadata.file_path"), F.pmod(spread, F.greatest(cuts, F.lit(1))))
        except AnalysisException:
            pass
    return F.pmod(spread, F.lit(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))))


def shard_columns(docs: DataFrame, id_col: str, text_col: str, bytes_per_shard: int) -> list[Column]:
    """Shard, id and UTF-8 bytes of every document, for a select on `docs`."""
    return [
        shard_of(docs, id_col, bytes_per_shard).alias(SHARD),
        F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(NULL_ID)).alias(ID),
        F.col(f"`{text_col}`").cast("binary").alias(BODY),
    ]


def texts(docs: DataFrame, id_col: str, text_col: str, bytes_per_shard: int) -> DataFrame:
    return docs.select(shard_columns(docs, id_col, text_col, bytes_per_shard))


def whole(docs: DataFrame, id_col: str, text_col: str, bytes_per_shard: int, carry: bool) -> DataFrame:
    """Shard, id and text, and behind them the document's other columns (without `carry`, its id alone)."""
    passed = [c for c in docs.columns if c != text_col and (carry or c == id_col)]
    return docs.select(*shard_columns(docs, id_col, text_col, bytes_per_shard), *(f"`{c}`" for c in passed))


def schema_of(df: DataFrame, more: str) -> str:
    """Schema text of the columns behind shard, id and text, and of `more`."""
    own = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name not in (SHARD, ID, BODY)]
    return ", ".join([*own, more])


def parts_of(df: DataFrame) -> int:
    """How many key ranges: two per shuffle partition, so that uneven hashing levels out."""
    return 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def part(keys: np.ndarray, parts: int) -> np.ndarray:
    """The range of each 64-bit key; sorted keys have sorted ranges."""
    return ((keys >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)


def cuts(sorted_keys: np.ndarray, parts: int) -> Iterator[tuple[int, slice]]:
    """The non-empty ranges of sorted keys and where they stand."""
    found, at = np.unique(part(sorted_keys, parts), return_index=True)
    ends = [*at[1:].tolist(), len(sorted_keys)]
    for p, a, b in zip(found.tolist(), at.tolist(), ends):
        yield p, slice(a, b)


def by_shard(batches: Iterable[pa.RecordBatch], limit: int) -> Iterator[tuple[int, list[int], list[bytes | None]]]:
    """(shard, ids, texts) of a partition's documents, gathered up to `limit` bytes of text."""
    held: dict[int, tuple[list, list]] = {}
    size = 0
    for batch in batches:
        for shard, doc, body in zip(*(batch.column(n).to_pylist() for n in (SHARD, ID, BODY))):
            ids, bodies = held.setdefault(shard, ([], []))
            ids.append(doc)
            bodies.append(body)
            size += len(body or b"") + 64
            if size >= limit:
                yield from ((s, *v) for s, v in held.items())
                held, size = {}, 0
    yield from ((s, *v) for s, v in held.items())


#: Memory of a worker up to which there is nothing worth giving back.
_LEAN = 256 << 20


def release() -> None:
    """Give memory that Python and Arrow have freed back to the system: workers live on, and the next task may be another's."""
    with contextlib.suppress(OSError, AttributeError):  # elsewhere than on Linux the system keeps what it likes
        with open("/proc/self/statm") as f:
            if int(f.read().split()[1]) * resource.getpagesize() < _LEAN:
                return
        pa.default_memory_pool().release_unused()
        ctypes.CDLL(None).malloc_trim(0)


def tidy(work: Callable) -> Callable:
    """`work` of mapInArrow or applyInArrow, with `release` at its end."""
    if inspect.isgeneratorfunction(work):
        def stream(batches):
            try:
                yield from work(batches)
            finally:
                release()

        return stream

    def done(out):
        release()
        return out

    # Spark counts the arguments: a table, or two of a cogroup, with or without the key.
    return {
        1: lambda a: done(work(a)), 2: lambda a, b: done(work(a, b)), 3: lambda a, b, c: done(work(a, b, c)),
    }[len(inspect.signature(work).parameters)]


class Rows:
    """Collects rows and hands them out as Arrow batches of a few MB."""

    def __init__(self, schema: pa.Schema, limit: int = 4 << 20):
        self.schema, self.limit, self.rows, self.size = schema, limit, [], 0

    def add(self, *row) -> Iterator[pa.RecordBatch]:
        self.rows.append(row)
        self.size += sum(len(x) for x in row if isinstance(x, bytes)) + 16
        if self.size >= self.limit:
            yield from self.rest()

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            columns = [pa.array(c, t) for c, t in zip(zip(*self.rows), self.schema.types)]
            yield pa.RecordBatch.from_arrays(columns, schema=self.schema)
        self.rows, self.size = [], 0

    def table(self) -> pa.Table:
        return pa.Table.from_batches(list(self.rest()), schema=self.schema)


def longs(packed: bytes, kind=np.uint64) -> np.ndarray:
    return np.frombuffer(packed, kind)


def among(known: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys are in `known`, sorted."""
    if not len(known):
        return np.zeros(len(keys), bool)
    return known[np.minimum(np.searchsorted(known, keys), len(known) - 1)] == keys


def as_text(bodies: list[bytes | None]) -> pa.Array:
    """Strings from UTF-8 bytes, without a check: Spark's own strings may hold any bytes."""
    return pc.cast(pa.array(bodies, pa.binary()), options=pc.CastOptions.unsafe(pa.string()))


def hash64(items: Iterable[bytes], n: int) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, items), np.uint64, n)


def hash128(items: list[bytes]) -> np.ndarray:
    """Two 64-bit halves of a 128-bit hash for each item."""
    return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, items)), ">u8").astype(np.uint64).reshape(-1, 2)


def mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    x = x + np.uint64((salt * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_PACKED = pa.schema([(SHARD, pa.int64()), ("ids", pa.binary()), ("sizes", pa.binary()), ("texts", pa.binary())])
PACKED = f"{SHARD} long, ids binary, sizes binary, texts binary"


def packed(base: DataFrame, limit: int = 4 << 20) -> DataFrame:
    """Documents of `texts` in rows of up to `limit` bytes of one shard, compressed: texts shuffle at half their size."""

    def pack(batches):
        press = zstandard.ZstdCompressor(level=3)
        rows = Rows(_PACKED)
        for shard, ids, bodies in by_shard(batches, limit):
            sizes = np.array([-1 if b is None else len(b) for b in bodies], np.int64)
            blob = press.compress(b"".join(b or b"" for b in bodies))
            yield from rows.add(shard, np.array(ids, np.int64).tobytes(), sizes.tobytes(), blob)
        yield from rows.rest()

    return base.mapInArrow(pack, PACKED)


def unpacked(table: pa.Table) -> Iterator[tuple[np.ndarray, list[bytes | None]]]:
    """(ids, texts) of each packed row of a shard."""
    press = zstandard.ZstdDecompressor()
    for row in table.select(["ids", "sizes", "texts"]).to_pylist():
        sizes = longs(row["sizes"], np.int64)
        data = press.decompress(row["texts"])
        ends = np.cumsum(np.maximum(sizes, 0)).tolist()
        starts = [0, *ends[:-1]]
        yield longs(row["ids"], np.int64), [
            None if n < 0 else data[a:b] for n, a, b in zip(sizes.tolist(), starts, ends)]
