"""Nearest neighbours by inverted lists whose members are scanned a block of dimensions at a time.

Vectors are dealt into lists by direction. A query visits the lists that look best to it; inside a list the
vectors are rotated by one random rotation and kept in blocks of columns. After each block the squared
distance known so far, scaled up to all dimensions, is an estimate of the whole one; a test rejects the
candidate as soon as that estimate is too large, by a margin that shrinks with the dimensions seen, to be
among the nearest. What no test rejects is scored exactly on the original vectors.

The bound that the tests need comes from the query's own list, which is scanned first and whole. For inner
products the bound differs by candidate: q x >= t means |q - x|^2 <= |q|^2 + |x|^2 - 2 t.

Equal vectors are one class with its smallest ids, on both sides, so a vector that a third of all rows hold
is searched and found once.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from crawlfold.session import written

K = 20
#: Lists and probes are fitted on the vectors with the smallest hashes: at most so many rows and bytes.
SAMPLE_ROWS, SAMPLE_BYTES = 16_384, 32 << 20
#: Sampled vectors that are searched in the sample to see how many lists a query must visit, and the share of
#: their nearest that these lists must hold. Neighbours in a sample lie farther off than those in the table.
TRIED, SHARE = 256, 0.98
MOST_LISTS = 1024
#: Dimensions of a column block, and how sure a test must be (in standard errors of the estimate).
BLOCK, SURE = 16, 2.1
#: Members of a list that one task holds, in bytes; longer lists are cut and a query visits each piece.
PIECE_BYTES = 16 << 20
#: Pairs of a query and a member held at once.
PAIRS = 1 << 20
#: Squared lengths up to here leave room for partial distances in single precision; longer vectors are scored whole.
_FITS = 1e36
SEED = 11


@lru_cache(maxsize=4)
def rotation(dims: int) -> np.ndarray:
    """A random rotation, the same everywhere."""
    q, r = np.linalg.qr(np.random.default_rng(SEED).standard_normal((dims, dims)))
    return (q * np.sign(np.diag(r))).astype(np.float32)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


class Lists:
    """Lists of the vectors of one length: directions that assign, raw means that rank, probes, pieces."""

    def __init__(self, sample: np.ndarray, rows: float, k: int):
        """`rows`: how many vectors the table has, by the sample's share."""
        n, dims = sample.shape
        units = _unit(sample)
        rng = np.random.default_rng(SEED)
        n_lists = int(min(max(1, math.sqrt(rows)), MOST_LISTS, max(1, n // 16)))
        self.directions = units[np.sort(rng.choice(n, n_lists, replace=False))]
        for _ in range(8):
            own = self.assign(sample)
            sums = np.zeros_like(self.directions)
            np.add.at(sums, own, units)
            size = np.linalg.norm(sums, axis=1, keepdims=True)
            self.directions = np.where(size > 1e-9, sums / np.maximum(size, 1e-9), self.directions)
        own = self.assign(sample)
        counts = np.bincount(own, minlength=n_lists)
        sums = np.zeros((n_lists, dims))
        np.add.at(sums, own, sample)
        self.means = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], self.directions)
        piece = max(256, PIECE_BYTES // (8 * dims))
        self.pieces = np.maximum(1, np.ceil(counts / n * rows / piece)).astype(np.int64)
        self.probes = self._probes(sample, own, k)

    def _probes(self, sample: np.ndarray, own: np.ndarray, k: int) -> int:
        """Lists that hold SHARE of the nearest of the tried vectors, in the order a query visits lists."""
        tried = sample[:: max(1, len(sample) // TRIED)][:TRIED]
        score = tried @ sample.T
        near = np.argsort(-score, axis=1, kind="stable")[:, : k + 1]
        place = np.argsort(self.order(tried), axis=1)
        depth = np.sort(np.take_along_axis(place, own[near], axis=1).ravel())
        return int(depth[min(len(depth) - 1, int(SHARE * len(depth)))]) + 1

    def assign(self, vectors: np.ndarray) -> np.ndarray:
        return np.argmax(_unit(vectors) @ self.directions.T, axis=1)

    def order(self, queries: np.ndarray) -> np.ndarray:
        """All lists, best first; a query's own list leads, as it is the one to bound the search."""
        score = queries @ self.means.T
        score[np.arange(len(queries)), self.assign(queries)] = np.inf
        return np.argsort(-score, axis=1, kind="stable")


def fit(classes: DataFrame, k: int) -> dict[int, Lists]:
    """Lists by length of vector, from a bounded sample. Lengths too rare to be sampled have none: one list."""
    most = classes.agg(F.max(F.size("v"))).first()[0]
    if most is None:
        return {}
    limit = max(1, min(SAMPLE_ROWS, SAMPLE_BYTES // (8 * most)))
    total = classes.count()
    rows = classes.orderBy("h1", "h2").limit(limit).select("v").collect()
    by_length: dict[int, list] = {}
    for r in rows:
        by_length.setdefault(len(r["v"]), []).append(r["v"])
    return {d: Lists(np.array(v, np.float64), total * len(v) / len(rows), k) for d, v in by_length.items()}


def _vectors(batch: pa.RecordBatch, name: str = "v") -> tuple[np.ndarray, np.ndarray]:
    """Values and starts of a list column."""
    column = batch.column(name)
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    return column.flatten().to_numpy(zero_copy_only=False), np.r_[0, np.cumsum(lengths)]


def _by_length(batch: pa.RecordBatch):
    """(rows, matrix) of each length of vector in a batch."""
    values, ends = _vectors(batch)
    lengths = np.diff(ends)
    for d in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == d)
        yield rows, values[(ends[rows][:, None] + np.arange(d)).ravel()].reshape(-1, d).astype(np.float64)


def _assign(sent):
    def run(batches):
        lists = sent.value
        for batch in batches:
            number, piece = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            h = batch.column("h1").to_numpy()
            for rows, x in _by_length(batch):
                if (own := lists.get(x.shape[1])) is not None:
                    found = own.assign(x)
                    number[rows], piece[rows] = found, (h[rows] & 0x7FFFFFFF) % own.pieces[found]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(number), pa.array(piece)], names=[*batch.schema.names, "list", "piece"])

    return run


def _visits(sent, first: bool):
    """Rows of a query for its own list (`first`), or for the other lists it probes."""
    def run(batches):
        lists = sent.value
        for batch in batches:
            out = []
            for rows, x in _by_length(batch):
                own = lists.get(x.shape[1])
                if own is None:
                    if first:
                        out.append((rows, np.zeros_like(rows), np.zeros_like(rows)))
                    continue
                order = own.order(x)
                chosen = order[:, :1] if first else order[:, 1 : own.probes]
                flat, who = chosen.ravel(), np.repeat(rows, chosen.shape[1])
                many = own.pieces[flat]
                ends = np.cumsum(many)
                piece = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - many, many)
                out.append((np.repeat(who, many), np.repeat(flat, many), piece))
            if out:
                who, number, piece = (np.concatenate(x) for x in zip(*out))
                for a in range(0, len(who), 4096):  # a query row has its vector, and many lists
                    s = slice(a, a + 4096)
                    took = batch.take(pa.array(who[s]))
                    yield pa.RecordBatch.from_arrays([*took.columns, pa.array(number[s]), pa.array(piece[s])], names=[*batch.schema.names, "list", "piece"])

    return run


class Piece:
    """The members of a list, or of a piece of one, ready to be scanned."""

    def __init__(self, x: np.ndarray, ids: list[list[int]]):
        self.x, self.ids = x, ids
        self.first = np.array([i[0] for i in ids], np.int64)
        turned = x.astype(np.float32) @ rotation(x.shape[1])
        self.squares = np.einsum("ij,ij->i", x, x)
        self.blocks = [np.ascontiguousarray(turned[:, a : a + BLOCK]) for a in range(0, x.shape[1], BLOCK)]
        self.parts = [np.einsum("ij,ij->i", b, b) for b in self.blocks]
        self.fits = self.squares.max() < _FITS

    def unbounded(self, q: np.ndarray, want: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs that can be among the `want` best of each query, without a bound from elsewhere."""
        score = q @ self.x.T
        if score.shape[1] <= want:
            return tuple(np.indices(score.shape).reshape(2, -1))
        least = -np.partition(-score, want - 1, axis=1)[:, want - 1]
        slack = 1e-9 * np.sqrt(np.einsum("ij,ij->i", q, q) * self.squares.max())
        return np.nonzero(score >= (least - slack)[:, None])

    def bounded(self, q: np.ndarray, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs that no test rejects: the distance over the blocks seen, scaled up, against the largest allowed."""
        dims = q.shape[1]
        turned = q.astype(np.float32) @ rotation(dims)
        own = np.einsum("ij,ij->i", q, q)
        sides = own[:, None] + self.squares[None, :]
        limit = (sides * (1 + 1e-5) - 2 * bound[:, None]).astype(np.float32)
        known = np.zeros_like(limit)
        seen = 0
        for i, (block, part) in enumerate(zip(self.blocks, self.parts)):
            own_block = turned[:, seen : seen + block.shape[1]]
            known += np.einsum("ij,ij->i", own_block, own_block)[:, None] + part[None, :] - 2 * (own_block @ block.T)
            seen += block.shape[1]
            alive = known <= limit * self._margin(seen, dims)
            if i + 1 < len(self.blocks) and alive.mean() < 0.2:
                break
        a, b = np.nonzero(alive)
        limit, known = limit[a, b], known[a, b]
        for block in self.blocks[i + 1 :]:
            step = turned[a, seen : seen + block.shape[1]] - block[b]
            known = known + np.einsum("ij,ij->i", step, step)
            seen += block.shape[1]
            stay = known <= limit * self._margin(seen, dims)
            a, b, limit, known = a[stay], b[stay], limit[stay], known[stay]
        return a, b

    @staticmethod
    def _margin(seen: int, dims: int) -> np.float32:
        """Largest partial distance, as a share of the whole one allowed, that the test lets pass."""
        if seen >= dims:
            return np.float32(1 + 1e-4)
        return np.float32(seen / dims * (1 + SURE / math.sqrt(seen)) ** 2)

    def best(self, q: np.ndarray, bound: np.ndarray, want: int):
        """(query, score, ids, bound) of the classes that may hold one of the `want` best ids of each query."""
        for a in range(0, len(q), max(1, PAIRS // len(self.x))):
            part = slice(a, a + max(1, PAIRS // len(self.x)))
            some, least = q[part], bound[part]
            free = np.isneginf(least) | ~(np.einsum("ij,ij->i", some, some) < _FITS) | (not self.fits)
            found = []
            for rows, pairs in ((np.flatnonzero(free), self.unbounded), (np.flatnonzero(~free), self.bounded)):
                if len(rows):
                    i, j = pairs(some[rows], want if pairs == self.unbounded else least[rows])
                    found.append((rows[i], j))
            i, j = (np.concatenate(x) for x in zip(*found))
            score = np.empty(len(i))
            for s in range(0, len(i), 1 << 16):
                score[s : s + (1 << 16)] = (some[i[s : s + (1 << 16)]] * self.x[j[s : s + (1 << 16)]]).sum(axis=1)
            stay = ~(score < least[i])
            i, j, score = i[stay], j[stay], score[stay]
            order = np.lexsort((self.first[j], -score, i))
            i, j, score = i[order], j[order], score[order]
            place = np.arange(len(i)) - np.searchsorted(i, i)
            last = place == want - 1
            new = np.full(len(some), -np.inf)
            new[i[last]] = score[last]
            for r, c, s in zip(i[place < want].tolist(), j[place < want].tolist(), score[place < want].tolist()):
                yield a + r, s, self.ids[c], float(max(new[r], least[r]))


_FOUND = pa.schema([("q1", pa.int64()), ("q2", pa.int64()), ("score", pa.float64()), ("ids", pa.list_(pa.int64())), ("bound", pa.float64())])
FOUND = "q1 long, q2 long, score double, ids array<long>, bound double"


def _scan(want: int):
    """Sorted rows of a partition: the members of a piece, then the queries that visit it."""
    def run(batches):
        key, pieces, members = None, {}, []
        for batch in batches:
            where = np.stack([batch.column(c).to_numpy() for c in ("list", "piece", "kind")], axis=1)
            edges = np.r_[0, np.flatnonzero((where[1:] != where[:-1]).any(axis=1)) + 1, len(where)] if len(where) else [0]
            for a, b in zip(edges[:-1], edges[1:]):
                if (where[a, 0], where[a, 1]) != key:
                    key, pieces, members = (where[a, 0], where[a, 1]), {}, []
                part = batch.slice(a, b - a)
                if where[a, 2] == 0:
                    ids = part.column("ids").to_pylist()
                    members += [(x, [ids[i] for i in rows]) for rows, x in _by_length(part)]
                    continue
                if members:  # all members of the piece came before the first query
                    by_length: dict[int, tuple[list, list]] = {}
                    for x, ids in members:
                        held = by_length.setdefault(x.shape[1], ([], []))
                        held[0].append(x)
                        held[1].extend(ids)
                    pieces, members = {d: Piece(np.concatenate(x), ids) for d, (x, ids) in by_length.items()}, []
                h1, h2, bound = (part.column(c).to_numpy() for c in ("h1", "h2", "bound"))
                for rows, q in _by_length(part):
                    if (piece := pieces.get(q.shape[1])) is None:
                        continue
                    found = list(piece.best(q, bound[rows], want))
                    if found:
                        at, score, ids, new = zip(*found)
                        at = rows[list(at)]
                        yield pa.RecordBatch.from_arrays([
                            pa.array(h1[at]), pa.array(h2[at]), pa.array(score, pa.float64()), pa.array(ids, pa.list_(pa.int64())),
                            pa.array(new, pa.float64())], schema=_FOUND)

    return run


def _search(members: DataFrame, queries: DataFrame, want: int) -> DataFrame:
    kind = members.select("list", "piece", F.lit(0).alias("kind"), "h1", "h2", "v", "ids", F.lit(float("-inf")).alias("bound"))
    asked = queries.select("list", "piece", F.lit(1).alias("kind"), "h1", "h2", "v", F.array().cast("array<long>").alias("ids"), "bound")
    met = kind.unionByName(asked).repartition("list", "piece").sortWithinPartitions("list", "piece", "kind", "h1")
    return met.mapInArrow(_scan(want), FOUND)


def nearest(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", *, k: int = K) -> DataFrame:
    """Per vector for which `is_query` holds, its k nearest found: `query_id`, `rank` from 1, `vec_id`, `score`.

    Score is the inner product of the original vectors in double precision; ties go to the smaller id. A
    vector is never its own neighbour, other rows with equal vectors are. Vectors that are NULL, zero or
    empty, or hold a component that is NULL or not finite, and rows without an id, take no part. Vectors
    meet those of their own length only. Rows equal in id and vector count once; if the rows of an id differ,
    each is searched, and none is a neighbour of another. With fewer candidates all are returned.

    The search is approximate: `fit` chooses how many lists a query visits, and the tests of a scan reject a
    near candidate now and then. `tests/llm` and the README have the recall. Columns besides the two and those of
    `is_query` do not matter.
    """
    kind = "float" if vectors.schema[vector_col].dataType.simpleString() == "array<float>" else "double"
    v = F.col(f"`{vector_col}`").cast(f"array<{kind}>")
    named = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), v.alias("v"), is_query.alias("asks"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = named.filter(F.col("id").isNotNull() & (F.size("v") > 0) & finite & F.exists("v", lambda x: x != 0)).select(
        "id", "v", "asks", F.xxhash64(F.lit(1), "v").alias("h1"), F.xxhash64(F.lit(2), "v").alias("h2"))
    want = k + 1  # a query finds itself too
    once = rows.groupBy("h1", "h2", "id").agg(F.first("v").alias("v"))
    least = F.row_number().over(W.partitionBy("h1", "h2").orderBy("id"))
    classes = written(
        once.withColumn("n", least).filter(F.col("n") <= want)
        .groupBy("h1", "h2").agg(F.first("v").alias("v"), F.sort_array(F.collect_list("id")).alias("ids")))
    asking = written(rows.filter("asks").groupBy("h1", "h2").agg(F.first("v").alias("v"), F.lit(float("-inf")).alias("bound")))
    sent = rows.sparkSession.sparkContext.broadcast(fit(classes, k))
    placed = written(classes.mapInArrow(_assign(sent), "h1 long, h2 long, v array<%s>, ids array<long>, list long, piece long" % kind))
    row = "h1 long, h2 long, v array<%s>, bound double, list long, piece long" % kind
    near = written(_search(placed, asking.mapInArrow(_visits(sent, True), row), want))
    bounds = near.groupBy(F.col("q1").alias("h1"), F.col("q2").alias("h2")).agg(F.max("bound").alias("bound"))
    bounded = asking.drop("bound").join(bounds, ["h1", "h2"], "left").withColumn("bound", F.coalesce("bound", F.lit(float("-inf"))))
    far = _search(placed, bounded.mapInArrow(_visits(sent, False), row), want)
    found = near.unionByName(far).select("q1", "q2", "score", F.explode("ids").alias("id"))
    best = F.row_number().over(W.partitionBy("q1", "q2").orderBy(F.desc("score"), "id"))
    answer = F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("minus"), "id")))
    answers = found.withColumn("n", best).filter(F.col("n") <= want).groupBy("q1", "q2").agg(answer.alias("found"))
    queries = rows.filter("asks").select(F.col("id").alias("query_id"), F.col("h1").alias("q1"), F.col("h2").alias("q2")).distinct()
    others = F.slice(F.filter("found", lambda f: f["id"] != F.col("query_id")), 1, k)
    return queries.join(answers, ["q1", "q2"]).select("query_id", F.posexplode(others).alias("at", "f")).select(
        "query_id", (F.col("at") + 1).alias("rank"), F.col("f.id").alias("vec_id"), (-F.col("f.minus")).alias("score"))


def op11_dimension_scan(spark: SparkSession, sf: str) -> DataFrame:
    return nearest(spark.read.parquet(f"{sf}/embeddings.parquet"), F.col("vec_id") % 20 == 0)
