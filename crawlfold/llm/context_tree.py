"""Code length of texts under a context-tree weighting model of the corpus.

A byte is eight binary decisions; each decision node has a tree over the bytes before it, `DEPTH` deep.
A node of that tree estimates by Krichevsky-Trofimov from the counts of the training texts, and is
weighted half and half with the product of its children; so a prediction mixes the estimates of all
depths, each by how well it has predicted the training texts.

What the corpus gives is counts of grams: the bytes of a context, nearest first, and the byte after.
Shards pack their distinct grams by the two nearest bytes, so each range holds whole subtrees from depth
two on; the tree above has at most 257 contexts of 255 nodes and is put together from sums. A gram's
probability is computed once, where its subtree is, and goes back to the shards that hold the gram.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlfold.llm.exchange import (
    ID, NULL_ID, SHARD, Rows, by_shard, hash64, longs, mixed, packed, part, parts_of, shard_columns, texts, unpacked,
)
from crawlfold.session import written

DEPTH = 5
BYTES_PER_SHARD = 16 << 20
END = b"\n"
_ASKED = pa.schema([("part", pa.int32()), (SHARD, pa.int64()), ("gram", pa.binary()), ("gram_n", pa.binary()),
                    ("word", pa.binary()), ("word_n", pa.binary())])
_TOLD = pa.schema([(SHARD, pa.int64()), ("gram", pa.binary()), ("bits", pa.binary()), ("word", pa.binary()), ("word_n", pa.binary())])
ASKED = f"part int, {SHARD} long, gram binary, gram_n binary, word binary, word_n binary"
TOLD = f"{SHARD} long, gram binary, bits binary, word binary, word_n binary"
_SUMS = "context int, node int, zeros double, ones double, below double, tokens long, kinds long"


def squeeze(values: np.ndarray) -> bytes:
    """64-bit numbers, best in ascending order: differences, by byte plane, compressed."""
    steps = np.diff(values, prepend=np.uint64(0)) if len(values) else values
    return zstandard.compress(steps.astype(np.uint64).view(np.uint8).reshape(-1, 8).T.tobytes(), 3)


def unsqueeze(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64)[:, 0], dtype=np.uint64)


def _counts(data: np.ndarray) -> bytes:
    return zstandard.compress(data.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), 3)


def _uncounts(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4")[:, 0].astype(np.int64)


def words(body: bytes | None) -> list[bytes]:
    return (body or b"").lower().split()


def grams(own: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Every byte of every text, its end included, as a number: the nearest context byte first, the byte last; and text sizes."""
    streams = [b" ".join(w) + END for w in own]
    sizes = np.array([len(s) for s in streams], np.int64)
    pad = END * DEPTH
    raw = np.frombuffer(b"".join(x for s in streams for x in (pad, s)), np.uint8)
    place = np.arange(int(sizes.sum())) + np.repeat(DEPTH * np.arange(1, len(own) + 1), sizes)
    out = np.zeros(len(place), np.uint64)
    for back in (*range(1, DEPTH + 1), 0):
        out <<= np.uint64(8)
        out |= raw[place - back]
    return out, sizes


def _slices(bodies: list[bytes | None], limit: int = 2 << 20) -> Iterator[slice]:
    """Runs of documents with up to `limit` bytes of text, or one longer text; at most 60,000, so that their numbers fit 16 bits."""
    a, size = 0, 0
    for i, body in enumerate(bodies):
        size += len(body or b"")
        if size >= limit or i - a >= 60_000:
            yield slice(a, i + 1)
            a, size = i + 1, 0
    if a < len(bodies):
        yield slice(a, len(bodies))


def _runs(ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each run of equal values begins, and its length."""
    if not len(ordered):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    at = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
    return at, np.diff(np.r_[at, len(ordered)])


def _trained(keys: np.ndarray, train: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, and how often each stands in training texts."""
    order = np.argsort(keys, kind="stable")
    keys, train = keys[order], train[order]
    at, _ = _runs(keys)
    return keys[at], np.add.reduceat(train.astype(np.int64), at) if len(at) else np.empty(0, np.int64)


def _gram_part(gram: np.ndarray, parts: int) -> np.ndarray:
    return part(mixed(gram >> np.uint64(8 * (DEPTH - 1))), parts)


def _ask(parts: int):
    def ask(batches):
        rows = Rows(_ASKED)
        for shard, tagged, bodies in by_shard(batches, 24 << 20):
            train = np.array(tagged, np.int64)
            kept: list[tuple[np.ndarray, np.ndarray]] = []
            kept_words = []
            for some in _slices(bodies):
                own = [words(b) for b in bodies[some]]
                in_train = train[some]
                g, sizes = grams(own)
                g = np.sort((g << np.uint64(1)) | np.repeat(in_train, sizes).astype(np.uint64))
                at, n = _runs(g)
                kept.append((g[at] >> np.uint64(1), n * (g[at] & np.uint64(1)).astype(np.int64)))
                counts = [len(w) + 1 for w in own]
                h = hash64((w for ws in own for w in (*ws, END)), sum(counts))
                kept_words.append(_trained(h, np.repeat(in_train, counts)))
            g, n = _merged(kept)
            w, m = _merged(kept_words)
            gp, wp = _gram_part(g, parts), part(w, parts)
            g_by, w_by = np.argsort(gp, kind="stable"), np.argsort(wp, kind="stable")
            g_cut = np.searchsorted(gp[g_by], np.arange(parts + 1))
            w_cut = np.searchsorted(wp[w_by], np.arange(parts + 1))
            for p in range(parts):
                i, j = g_by[g_cut[p] : g_cut[p + 1]], w_by[w_cut[p] : w_cut[p + 1]]
                if len(i) or len(j):
                    yield from rows.add(p, shard, squeeze(g[i]), _counts(n[i]), squeeze(w[j]), _counts(m[j]))
        yield from rows.rest()

    return ask


def _merged(pieces: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    return _trained(np.concatenate([p[0] for p in pieces]), np.concatenate([p[1] for p in pieces]))


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series after eight steps of the recurrence; good to 1e-12 from 0.5 on."""
    shift = np.zeros_like(x)
    for i in range(8):
        shift += np.log(x + i)
    y = x + 8
    inv = 1 / (y * y)
    series = (1 / 12 - inv * (1 / 360 - inv * (1 / 1260 - inv / 1680))) / y
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - shift


def estimate(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log probability that Krichevsky-Trofimov gives a sequence with these counts."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1) - np.log(np.pi)


def weighted(own: np.ndarray, below: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weighted log probability of a node, and the share of its own estimate in a prediction."""
    return np.logaddexp(own, below) - np.log(2), 1 / (1 + np.exp(np.clip(below - own, -700, 700)))


def _nodes(gram: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows, 8): the decision nodes of each gram's last byte and the bits it takes there."""
    byte = (gram & np.uint64(255)).astype(np.int64)[:, None]
    j = np.arange(8)
    return (1 << j) | (byte >> (8 - j)), (byte >> (7 - j)) & 1


class Subtrees:
    """The tree from depth two on over the grams of a range, counts as of the training texts.

    Nodes without counts estimate one half and weigh as their children, so grams that no training
    text holds need no case of their own.
    """

    def __init__(self, gram: np.ndarray, n: np.ndarray):
        node, self.bit = _nodes(gram)
        self.levels = []  # from the deepest up: which node each decision is, its estimate and its share
        inverse, below = None, None
        for d in range(DEPTH, 1, -1):
            context = (gram >> np.uint64(8 * (DEPTH + 1 - d)))[:, None]
            key = (context << np.uint64(8)) | node.astype(np.uint64)
            known, at = np.unique(key.ravel(), return_inverse=True)
            count = np.repeat(n, 8).astype(float)
            ones = np.bincount(at, count * self.bit.ravel(), len(known))
            zeros = np.bincount(at, count, len(known)) - ones
            own = estimate(zeros, ones)
            if inverse is None:
                weight, share = own, np.ones(len(known))
            else:
                up = np.empty(len(below), np.int64)
                up[inverse] = at  # the parent of each node one deeper
                total = np.bincount(up, below, len(known))
                weight, share = weighted(own, total)
            chance = (ones + 0.5) / (zeros + ones + 1)
            self.levels.append((at, chance, share))
            inverse, below = at, weight
        self.top, self.zeros, self.ones, self.weight = known, zeros, ones, weight

    def sums(self) -> tuple[np.ndarray, ...]:
        """Per nearest byte and node: counts and the children's weighted log probabilities."""
        context = (self.top >> np.uint64(16)).astype(np.int64)
        node = (self.top & np.uint64(255)).astype(np.int64)
        known, at = np.unique(context * 256 + node, return_inverse=True)
        add = lambda x: np.bincount(at, x, len(known))
        return known // 256, known % 256, add(self.zeros), add(self.ones), add(self.weight)

    def log10(self, gram: np.ndarray, top: dict[str, np.ndarray]) -> np.ndarray:
        """Log10 probability of each gram's byte after its context."""
        mix = None
        for at, chance, share in self.levels:
            own = chance[at]
            mix = own if mix is None else share[at] * own + (1 - share[at]) * mix
        node, bit = _nodes(gram)
        near = (gram >> np.uint64(8 * DEPTH)).astype(np.int64)[:, None]
        mix = mix.reshape(-1, 8)
        s = top["share1"][near, node]
        mix = s * top["chance1"][near, node] + (1 - s) * mix
        s = top["share0"][node]
        mix = s * top["chance0"][node] + (1 - s) * mix
        return np.log10(np.where(bit == 1, mix, 1 - mix)).sum(axis=1)


def _of_part(rows: list[dict]) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
    return (_merged([(unsqueeze(r["gram"]), _uncounts(r["gram_n"])) for r in rows]),
            _merged([(unsqueeze(r["word"]), _uncounts(r["word_n"])) for r in rows]))


def _sum_up(table: pa.Table) -> pa.Table:
    (gram, n), (_, m) = _of_part(table.to_pylist())
    context, node, zeros, ones, below = Subtrees(gram, n).sums() if len(gram) else [np.empty(0)] * 5
    out = {"context": [-1, *context], "node": [0, *node], "zeros": [0.0, *zeros], "ones": [0.0, *ones], "below": [0.0, *below],
           "tokens": [int(m.sum())] + [0] * len(context), "kinds": [int((m > 0).sum())] + [0] * len(context)}
    kinds = dict(context=pa.int32(), node=pa.int32(), zeros=pa.float64(), ones=pa.float64(), below=pa.float64(), tokens=pa.int64(), kinds=pa.int64())
    return pa.table({k: pa.array(np.array(v), kinds[k]) for k, v in out.items()})


def _top(rows: list) -> dict[str, np.ndarray]:
    """Depths one and nought from the sums: at most 256 contexts of 255 nodes."""
    zeros, ones, below = (np.zeros((256, 256)) for _ in range(3))
    for r in rows:
        if r["context"] >= 0:
            zeros[r["context"], r["node"]], ones[r["context"], r["node"]] = r["zeros"], r["ones"]
            below[r["context"], r["node"]] = r["below"]
    weight, share1 = weighted(estimate(zeros, ones), below)
    zeros0, ones0 = zeros.sum(0), ones.sum(0)
    _, share0 = weighted(estimate(zeros0, ones0), weight.sum(0))
    return {"share1": share1, "chance1": (ones + 0.5) / (zeros + ones + 1), "share0": share0, "chance0": (ones0 + 0.5) / (zeros0 + ones0 + 1)}


def _tell(top: dict[str, np.ndarray]):
    def tell(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        (gram, n), (word, m) = _of_part(rows)
        bits = Subtrees(gram, n).log10(gram, top).astype(np.float32) if len(gram) else np.empty(0, np.float32)
        out, res = [], Rows(_TOLD)
        by: dict[int, list[dict]] = {}
        for r in rows:
            by.setdefault(r[SHARD], []).append(r)
        for shard, asked in by.items():
            g = np.unique(np.concatenate([unsqueeze(r["gram"]) for r in asked]))
            w = np.unique(np.concatenate([unsqueeze(r["word"]) for r in asked]))
            out += res.add(shard, squeeze(g), bits[np.searchsorted(gram, g)].tobytes(), squeeze(w), _counts(m[np.searchsorted(word, w)]))
        out += res.rest()
        return pa.Table.from_batches(out, schema=_TOLD)

    return tell


def _score(total: int, kinds: int):
    def score(docs: pa.Table, told: pa.Table) -> pa.Table:
        rows = told.to_pylist()
        gram, bits = np.concatenate([unsqueeze(r["gram"]) for r in rows]), np.concatenate([longs(r["bits"], np.float32) for r in rows])
        word, count = np.concatenate([unsqueeze(r["word"]) for r in rows]), np.concatenate([_uncounts(r["word_n"]) for r in rows])
        order = np.argsort(gram)
        gram, bits = gram[order], bits[order].astype(np.float64)
        order = np.argsort(word)
        word, count = word[order], count[order]
        base = np.log10((count + 0.1) / (total + 0.1 * (kinds + 1)))
        cols: list[list] = [[], [], [], [], [], []]
        for ids, bodies in unpacked(docs):
            for some in _slices(bodies):
                own = [words(b) for b in bodies[some]]
                g, sizes = grams(own)
                g = np.sort((g << np.uint64(16)) | np.repeat(np.arange(len(own)), sizes).astype(np.uint64))
                at, n = _runs(g)
                g = g[at]
                value = bits[np.searchsorted(gram, g >> np.uint64(16))] * n
                scores = np.bincount((g & np.uint64(0xFFFF)).astype(np.int64), value, len(own))
                counts = np.array([len(w) + 1 for w in own])
                h = hash64((w for ws in own for w in (*ws, END)), int(counts.sum()))
                i = np.searchsorted(word, h)
                doc = np.repeat(np.arange(len(own)), counts)
                known = np.bincount(doc, count[i] > 0, len(own)).astype(np.int64)
                for c, x in zip(cols, (ids[some], counts, known, np.bincount(doc, base[i], len(own)), scores, sizes)):
                    c.append(x)
        ids, n_tokens, known, bases, scores, sizes = (np.concatenate(c) for c in cols)
        return pa.table({"id": pa.array(ids, pa.int64(), mask=ids == NULL_ID), "n_tokens": n_tokens, "n_known": known,
                         "base_score": bases, "score": scores, "n_bytes": sizes})

    return score


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, in_training=None,
          bytes_per_shard: int = BYTES_PER_SHARD) -> DataFrame:
    """One row per document: `id`, `n_tokens`, `n_known`, `train_tokens`, `base_score`, `score`, `n_bytes`.

    A text is its words, A-Z lower-cased and joined by one space, and an end. `score` is the log10
    probability of these `n_bytes` bytes under the model, so `-score * log2(10) / n_bytes` is the code
    length per byte; `base_score` that of the words and the end under smoothed word counts. Both learn
    from the rows for which `in_training` (a column, default: all) holds. Tokens are words and the end;
    known ones stand in a training text. NULL and empty texts are one end. Repeated rows count as often
    as they come. With no training rows every bit is even odds and no token is known. Other columns are
    not read. Words are told apart by 64 bits of hash.
    """
    base = texts(docs, id_col, text_col, bytes_per_shard)
    parts = parts_of(docs)
    train = F.lit(True) if in_training is None else F.coalesce(in_training, F.lit(False))
    shard, _, body = shard_columns(docs, id_col, text_col, bytes_per_shard)
    asks = docs.select(shard, train.cast("long").alias(ID), body)  # counting needs the flag, not the id
    asked = written(asks.mapInArrow(_ask(parts), ASKED))
    sums = asked.groupBy("part").applyInArrow(_sum_up, _SUMS).groupBy("context", "node").agg(
        *[F.sum(c).alias(c) for c in ("zeros", "ones", "below", "tokens", "kinds")]).collect()
    total, kinds = sum(r["tokens"] for r in sums), sum(r["kinds"] for r in sums)
    told = asked.groupBy("part").applyInArrow(_tell(_top(sums)), TOLD)
    found = packed(base).groupBy(SHARD).cogroup(told.groupBy(SHARD)).applyInArrow(
        _score(total, kinds), "id long, n_tokens long, n_known long, base_score double, score double, n_bytes long")
    return found.withColumn("train_tokens", F.lit(total).cast("long"))


def op7_context_tree(spark: SparkSession, sf: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0
    found = score(docs, in_training=~out)
    held = F.crc32(F.col("id").cast("string").cast("binary")) % 10 == 0
    return found.select(F.col("id").alias("doc_id"), held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
