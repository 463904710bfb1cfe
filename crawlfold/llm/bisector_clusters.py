"""Centroid clustering by a tournament of bisectors, in whole numbers throughout.

The plane halfway between two centroids i < j is 2 (c_j - c_i) x = |c_j|^2 - |c_i|^2. Its normal and its
threshold are whole numbers, so the sign of `normal x - threshold` says exactly which of the two is
nearer: above zero j wins, at zero or below i does. One pass of k - 1 such tests leaves the nearest
centroid; a distance is worked out for the last one only.

Each round is one scan of stored blocks of vectors: a task adds up its own vectors by centroid, Spark adds
the tasks' sums, and the driver sees k counts and k x dims sums, whatever the table holds.
"""

from __future__ import annotations

import hashlib
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlfold.llm.exchange import NULL_ID
from crawlfold.session import written

K = 8
ROUNDS = 10
DIMS = 64
SCALE = 1024
SALT = "3"
#: Vectors of one stored block.
BLOCK = 2048
_MOST = 2**63 - 1
#: Whole numbers up to here are exact as doubles, sums and products included.
_EXACT = 2.0**53


def whole(vectors: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) as 64-bit numbers; what is out of their range becomes the nearest of them."""
    with np.errstate(over="ignore"):
        floor = np.floor(scale * vectors)
    inside = np.abs(floor) < 2.0**63
    out = np.where(inside, floor, 0).astype(np.int64)
    out[~inside] = np.where(floor[~inside] > 0, _MOST, -_MOST)
    return out


class Bisectors:
    """Normals and thresholds of all pairs of centroids, and the tournament between them."""

    def __init__(self, centroids: list[list[int]]):
        self.centroids = centroids
        self.most = max((abs(x) for c in centroids for x in c), default=0)
        squares = [sum(x * x for x in c) for c in centroids]
        self.pairs = {
            (i, j): ([2 * (b - a) for a, b in zip(centroids[i], centroids[j])], squares[j] - squares[i])
            for j in range(len(centroids)) for i in range(j)
        }

    def _number(self, block: np.ndarray):
        """The kind of number in which all tests and distances of the block are exact: double, else Python's own."""
        most = max(self.most, int(np.abs(block).max(initial=0)))
        return np.float64 if 8 * block.shape[1] * (most + 1) ** 2 < _EXACT else object

    def nearest(self, block: np.ndarray) -> np.ndarray:
        """Number of the nearest centroid of each row; the smaller of equally near ones."""
        kind = self._number(block)
        x = block.astype(kind)
        champion = np.zeros(len(block), np.int64)
        for j in range(1, len(self.centroids)):
            held = champion.copy()
            for i in np.unique(held).tolist():
                rows = np.flatnonzero(held == i)
                normal, threshold = self.pairs[i, j]
                side = x[rows] @ np.array(normal, kind) - kind(threshold) if kind is np.float64 else \
                    x[rows].dot(np.array(normal, object)) - threshold
                champion[rows[(side > 0).astype(bool)]] = j
        return champion

    def distances(self, block: np.ndarray, cluster: np.ndarray) -> np.ndarray:
        """Exact squared distance to the own centroid; one beyond a long becomes the greatest long."""
        kind = self._number(block)
        step = block.astype(kind) - np.array(self.centroids, kind)[cluster]
        found = (step * step).sum(axis=1)
        return found.astype(np.int64) if kind is np.float64 else np.array([min(d, _MOST) for d in found], np.int64)


def _blocks(dims: int, scale: int):
    def pack(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            flat = batch.column(1).flatten().to_numpy(zero_copy_only=False)
            vectors = whole(flat.reshape(-1, dims), scale)
            starts = range(0, len(ids), BLOCK)
            yield pa.RecordBatch.from_arrays([
                pa.array([ids[a : a + BLOCK].tobytes() for a in starts], pa.binary()),
                pa.array([vectors[a : a + BLOCK].tobytes() for a in starts], pa.binary()),
            ], names=["ids", "vectors"])

    return pack


def _read(batch: pa.RecordBatch, dims: int):
    for row in batch.to_pylist():
        yield np.frombuffer(row["ids"], np.int64), np.frombuffer(row["vectors"], np.int64).reshape(-1, dims)


def _sums(centroids: list[list[int]], dims: int):
    """Per task: the members of each centroid counted (place -1) and added up (place 0 and on)."""
    def add(batches):
        bisectors = Bisectors(centroids)
        counts, sums = [0] * len(centroids), [[0] * dims for _ in centroids]
        for batch in batches:
            for _, block in _read(batch, dims):
                cluster = bisectors.nearest(block)
                high, low = block >> 32, block & 0xFFFFFFFF
                for c in np.unique(cluster).tolist():
                    rows = cluster == c
                    counts[c] += int(rows.sum())
                    top, rest = high[rows].sum(axis=0).tolist(), low[rows].sum(axis=0).tolist()
                    sums[c] = [s + (t << 32) + r for s, t, r in zip(sums[c], top, rest)]
        rows = [(c, at, Decimal(v)) for c, n in enumerate(counts) if n for at, v in enumerate([n, *sums[c]], -1)]
        if rows:
            own = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(own, (pa.int32(), pa.int32(), pa.decimal128(38, 0)))], names=["cluster", "at", "total"])

    return add


def _assigned(centroids: list[list[int]], dims: int):
    def assign(batches):
        bisectors = Bisectors(centroids)
        for batch in batches:
            for ids, block in _read(batch, dims):
                cluster = bisectors.nearest(block)
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids, mask=ids == NULL_ID), pa.array(cluster.astype(np.int32)),
                    pa.array(bisectors.distances(block, cluster)),
                ], names=["vec_id", "cluster", "distance"])

    return assign


def clusters(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", *, k: int = K, rounds: int = ROUNDS,
             dims: int = DIMS, scale: int = SCALE, salt: str = SALT) -> DataFrame:
    """Per kept vector: `vec_id`, `cluster`, `distance` (squared), `cluster_inertia`, `inertia`, `centroid_sha256`.

    Kept are vectors of exactly `dims` components, none NULL or not finite; each component x counts as
    floor(scale * x). The k vectors with the smallest sha256 of `salt:id` start as centroids; of several rows
    of one id the smaller vector counts first, rows without an id last. Every round moves each centroid that
    has members to the floor of their mean. With fewer than k vectors each starts a centroid; without any
    the result is empty. Repeated rows count as often as they occur. Columns besides the two do not matter.

    Whole numbers beyond 64 bits are taken as the nearest 64-bit one, before any arithmetic; distances and
    inertias beyond a long are returned as the greatest long.
    """
    spark = vectors.sparkSession
    named = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    kept = named.filter((F.size("v") == dims) & finite)
    order = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("id").cast("string")), 256)
    first = kept.orderBy(order.asc_nulls_last(), "v").limit(k).collect()
    centroids = [whole(np.array(r["v"], np.float64), scale).tolist() for r in first]
    if not centroids:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    stored = written(kept.select(F.coalesce("id", F.lit(NULL_ID)), "v").mapInArrow(_blocks(dims, scale), "ids binary, vectors binary"))
    for _ in range(rounds):
        sums = stored.mapInArrow(_sums(centroids, dims), "cluster int, at int, total decimal(38,0)")
        found: dict[int, dict[int, int]] = {}
        for r in sums.groupBy("cluster", "at").agg(F.sum("total").alias("total")).collect():
            found.setdefault(r["cluster"], {})[r["at"]] = int(r["total"])
        moved = [[found[c][at] // found[c][-1] for at in range(dims)] if c in found else old for c, old in enumerate(centroids)]
        if moved == centroids:
            break
        centroids = moved
    members = written(stored.mapInArrow(_assigned(centroids, dims), "vec_id long, cluster int, distance long"))
    sums = {r["cluster"]: int(r["total"]) for r in members.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}
    inertia = min(sum(sums.values()), _MOST)
    about = spark.createDataFrame(
        [(c, min(total, _MOST), inertia, hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()) for c, total in sums.items()],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return members.join(F.broadcast(about), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op13_bisector_clusters(spark: SparkSession, sf: str) -> DataFrame:
    return clusters(spark.read.parquet(f"{sf}/embeddings.parquet"))


def _round(n: int) -> str:
    """SQL of one assignment to the centroids c{n}, and of the centroids it leads to."""
    return f"""
a{n} AS MATERIALIZED (
  SELECT vec_id, v, CAST(list_position(ds, list_min(ds)) - 1 AS INT) AS cluster, list_min(ds) AS distance
  FROM (SELECT vec_id, v, list_transform(cs, lambda w: list_sum(list_transform(list_zip(v, w), lambda z: (z[1] - z[2]) * (z[1] - z[2])))) AS ds
        FROM kept, (SELECT list(v ORDER BY c) AS cs FROM c{n}))),
m{n} AS MATERIALIZED (
  SELECT cluster, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY pos) AS v
  FROM (SELECT cluster, pos, sum(x) AS s, count(*) AS n
        FROM (SELECT cluster, unnest(v) AS x, unnest(range(len(v))) AS pos FROM a{n}) GROUP BY cluster, pos)
  GROUP BY cluster),
c{n + 1} AS MATERIALIZED (SELECT c{n}.c, coalesce(m{n}.v, c{n}.v) AS v FROM c{n} LEFT JOIN m{n} ON m{n}.cluster = c{n}.c),"""


SQL = f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) = {DIMS} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {DIMS}),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('{SALT}:' || vec_id)) - 1 AS c, v FROM kept ORDER BY sha256('{SALT}:' || vec_id) LIMIT {K}),
{"".join(_round(n) for n in range(ROUNDS + 1))}
per AS (SELECT cluster, CAST(sum(distance) AS BIGINT) AS cluster_inertia FROM a{ROUNDS} GROUP BY cluster)
SELECT a.vec_id, a.cluster, CAST(a.distance AS BIGINT) AS distance, per.cluster_inertia,
       (SELECT CAST(sum(cluster_inertia) AS BIGINT) FROM per) AS inertia,
       sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{ROUNDS} a JOIN per USING (cluster) JOIN c{ROUNDS} c ON c.c = a.cluster
"""
