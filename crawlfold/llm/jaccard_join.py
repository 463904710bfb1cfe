"""Documents whose sets of word shingles overlap, joined with the skips that sets' relations allow.

Let a set have n shingles and T percent be the least similarity. Two linked sets share at least T
percent of the larger one. So, with shingles ordered by hash, their prefixes of n - t + l shingles
(t: T percent of n, l: a quarter of n) share at least l of the smaller set, and with shingles ordered
by rarity their prefixes of n - t + 1 share one.

1. A set whose long prefix has too few shingles that any other set holds is linked with nothing: most
   texts end here. Equal sets go on as one.
2. The rest are indexed by their rarest shingles. Each list is first compared with its first set only;
   a set's guide is the most similar set it is linked to by that, at a known distance.
3. Partners are derived from the guide's: distance is a metric, so two partners of one guide are linked if
   their distances from it add up to little enough. These pairs are never listed or compared.
4. The lists' entries are cut into blocks in order of size; pairs of blocks are skipped by size and position, pairs of
   sets also by their counts of shingles in some cells.
   A pair that is left is linked, or apart, without a comparison where the distances to and between the two
   guides decide it; the others are compared.

Components need fewer links than there are: a set belongs where its guide does, so its place is derived from the
guide's, and pairs inside a component are neither listed nor compared. After step 2 the index is built again from the
shingles that several components hold, and only pairs of different components go through step 4. A family of near
copies so costs one link per set, whatever its size. All links (`near_links`) are listed on request.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from crawlfold.llm.anchors import combined
from crawlfold.llm.exchange import (
    NULL_ID, SHARD, Rows, among, by_shard, cuts, hash64, longs, mixed, packed, part, parts_of, texts, unpacked, tidy,
)
from crawlfold.session import remove, written

SHINGLE = 5
PERCENT = 75
BYTES_PER_SHARD = 8 << 20
#: Sets compared in one group with one other set; entries of a block of a list.
GROUP = 256
BLOCK = 128
_ASKED = pa.schema([("part", pa.int32()), (SHARD, pa.int64()), *((c, pa.binary()) for c in ("shingle", "n", "key", "first"))])
_TOLD = pa.schema([(SHARD, pa.int64()), ("part", pa.int32()), *((c, pa.binary()) for c in ("shared", "key", "first", "own"))])
_SETS = pa.schema([(SHARD, pa.int64()), ("id", pa.int64()), ("n", pa.int32()), ("key", pa.binary()), ("first", pa.int64()),
                   ("set", pa.binary())])
ASKED = f"part int, {SHARD} long, shingle binary, n binary, key binary, first binary"
TOLD = f"{SHARD} long, part int, shared binary, key binary, first binary, own binary"
SETS = f"{SHARD} long, id long, n int, key binary, first long, set binary"
_KEY = np.dtype([("a", ">u8"), ("b", ">u8")])


def at_least(n, percent: int):
    """Shingles that a set of n shares with any set it is linked to."""
    return (percent * n + 99) // 100


def _spare(n: int) -> int:
    return max(1, (n + 3) // 4)


def shingles(bodies: list[bytes | None], size: int) -> list[np.ndarray]:
    """Per text the sorted distinct 64-bit hashes of its runs of `size` words; with fewer words, of all of them."""
    own = [(b or b"").lower().split() for b in bodies]
    counts = [len(w) for w in own]
    hashes = hash64((w for ws in own for w in ws), sum(counts))
    run = np.zeros(max(len(hashes) - size + 1, 0), np.uint64)
    for j in range(size):
        run = combined(run, hashes[j : j + len(run)])
    out, at = [], 0
    for n in counts:
        if n >= size:
            out.append(np.unique(run[at : at + n - size + 1]))
        elif n:
            short = np.full(1, n, np.uint64)
            for j in range(n):
                short = combined(short, hashes[at + j : at + j + 1])
            out.append(short)
        else:
            out.append(np.empty(0, np.uint64))
        at += n
    return out


def _low(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(16)).astype(np.uint32)


def _prefix(s: np.ndarray, percent: int) -> np.ndarray:
    """The long prefix of a sorted set, sorted; ordered by another hash, so that its shingles fall evenly on the key ranges."""
    n = len(s)
    order = np.argsort(mixed(s, 3))
    return s[np.sort(order[: min(n, n - at_least(n, percent) + _spare(n))])]


def _ask(size: int, percent: int, parts: int):
    def ask(batches):
        rows = Rows(_ASKED)
        for shard, ids, bodies in by_shard(batches, 4 << 20):
            sets: dict[bytes, tuple[int, np.ndarray]] = {}
            for doc, s in zip(ids, shingles(bodies, size)):
                if len(s):
                    key = xxhash.xxh3_128_digest(s.tobytes())
                    sets[key] = (min(doc, sets[key][0]) if key in sets else doc, s)
            if not sets:
                continue
            found, counts = np.unique(np.concatenate([_prefix(s, percent) for _, s in sets.values()]), return_counts=True)
            n = np.minimum(counts, 2).astype(np.uint8)
            for p, s in cuts(found, parts):
                yield from rows.add(p, shard, _low(found[s]).tobytes(), n[s].tobytes(), b"", b"")
            keys = np.frombuffer(b"".join(sets), _KEY)
            firsts = np.array([v[0] for v in sets.values()], np.int64)
            order = np.argsort(keys["a"].astype(np.uint64))
            for p, s in cuts(keys["a"].astype(np.uint64)[order], parts):
                yield from rows.add(p, shard, b"", b"", keys[order[s]].tobytes(), firsts[order[s]].tobytes())
        yield from rows.rest()

    return ask


def _tell(table: pa.Table) -> pa.Table:
    asked = table.to_pylist()
    low = np.concatenate([longs(r["shingle"], np.uint32) for r in asked])
    n = np.concatenate([longs(r["n"], np.uint8) for r in asked])
    order = np.argsort(low, kind="stable")
    low, n = low[order], n[order].astype(np.int64)
    at = np.flatnonzero(np.r_[True, low[1:] != low[:-1]]) if len(low) else np.empty(0, np.int64)
    shared = low[at][np.add.reduceat(n, at) > 1] if len(low) else low
    first: dict[bytes, tuple[int, int]] = {}  # smallest id of the class, and the one shard that sends its set
    for r in asked:
        for i, doc in enumerate(longs(r["first"], np.int64).tolist()):
            key, here = r["key"][16 * i : 16 * i + 16], (doc, r[SHARD])
            first[key] = min(here, first.get(key, here))
    by: dict[int, list[dict]] = {}
    for r in asked:
        by.setdefault(r[SHARD], []).append(r)
    out, rows = [], Rows(_TOLD)
    for shard, own_rows in by.items():
        own = np.unique(np.concatenate([longs(r["shingle"], np.uint32) for r in own_rows]))
        data = b"".join(r["key"] for r in own_rows)
        keys = list(dict.fromkeys(data[i : i + 16] for i in range(0, len(data), 16)))
        out += rows.add(shard, own_rows[0]["part"], own[among(shared, own)].tobytes(), b"".join(keys),
                        np.array([first[k][0] for k in keys], np.int64).tobytes(), bytes(first[k][1] == shard for k in keys))
    out += rows.rest()
    return pa.Table.from_batches(out, schema=_TOLD)


def _pack(s: np.ndarray) -> bytes:
    """48 of the 64 bits of each hash, in order; within a pair of sets a false match is one in 2**48 per pair of shingles."""
    return s.astype(">u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def unpack(data: bytes) -> np.ndarray:
    wide = np.zeros((len(data) // 6, 8), np.uint8)
    wide[:, 2:] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return wide.view(">u8")[:, 0].astype(np.uint64)


def _survivors(size: int, percent: int, parts: int):
    def survive(docs: pa.Table, told: pa.Table) -> pa.Table:
        rows = told.to_pylist()
        shared = np.unique(np.concatenate(
            [(np.uint64(r["part"]) << np.uint64(32)) | longs(r["shared"], np.uint32).astype(np.uint64) for r in rows]
            or [np.empty(0, np.uint64)]))
        first = {r["key"][16 * i : 16 * i + 16]: (doc, own) for r in rows
                 for i, (doc, own) in enumerate(zip(longs(r["first"], np.int64).tolist(), r["own"]))}
        shard = docs.column(SHARD)[0].as_py()
        out, res = [], Rows(_SETS)
        sent = set()
        for ids, bodies in unpacked(docs):
            for doc, s in zip(ids.tolist(), shingles(bodies, size)):
                n = len(s)
                if not n:
                    out += res.add(shard, doc, 0, None, doc, None)
                    continue
                key = xxhash.xxh3_128_digest(s.tobytes())
                least, own = first[key]
                data = None
                if own and key not in sent and len(shared):
                    head = _prefix(s, percent)
                    keys = (part(head, parts) << np.uint64(32)) | _low(head).astype(np.uint64)
                    if int(among(shared, keys).sum()) >= _spare(at_least(n, percent)):
                        data = _pack(s)
                        sent.add(key)
                out += res.add(shard, doc, n, key, least, data)
        out += res.rest()
        return pa.Table.from_batches(out, schema=_SETS)

    return survive


# Index: which shingles of the surviving sets stand in several components, then the rarest of each set.

_COUNT = pa.schema([("part", pa.int32()), (SHARD, pa.int64()), *((c, pa.binary()) for c in ("shingle", "n", "least", "most"))])
COUNT = f"part int, {SHARD} long, shingle binary, n binary, least binary, most binary"
_ENTRY = "shingle long, rep long, comp long, n int, pos int, common int, weight float, cells binary"
#: Cells that a set's shingles are counted in. Two sets share no more than the smaller counts add up to.
CELLS = 256


def _grouped(shingle: np.ndarray, n: np.ndarray, least: np.ndarray, most: np.ndarray):
    order = np.argsort(shingle, kind="stable")
    shingle = shingle[order]
    at = np.flatnonzero(np.r_[True, shingle[1:] != shingle[:-1]])
    return shingle[at], np.add.reduceat(n[order], at), np.minimum.reduceat(least[order], at), np.maximum.reduceat(most[order], at)


def _count(parts: int):
    """One row per range of keys for the sets of a whole shard, wherever a join has put them."""

    def count(table: pa.Table) -> pa.Table:
        out, rows = [], Rows(_COUNT)
        sets = [unpack(data) for data in table.column("set").to_pylist()]
        comp = np.repeat(table.column("comp").to_numpy(), [len(x) for x in sets])
        found = _grouped(np.concatenate(sets), np.ones(len(comp), np.int64), comp, comp)
        for p, s in cuts(found[0] << np.uint64(16), parts):
            out += rows.add(p, table.column(SHARD)[0].as_py(), *(x[s].tobytes() for x in found))
        out += rows.rest()
        return pa.Table.from_batches(out, schema=_COUNT)

    return count


def _summed(table: pa.Table) -> pa.Table:
    asked = table.to_pylist()
    kinds = {"shingle": np.uint64, "n": np.int64, "least": np.int64, "most": np.int64}
    known, total, least, most = _grouped(*(np.concatenate([longs(r[c], t) for r in asked]) for c, t in kinds.items()))
    mixed = least < most
    known, total = known[mixed], total[mixed]
    out, rows, seen = [], Rows(_COUNT), {}
    for r in asked:
        seen.setdefault(r[SHARD], []).append(longs(r["shingle"]))
    for shard, own in seen.items():
        own = np.unique(np.concatenate(own))
        own = own[among(known, own)]
        out += rows.add(asked[0]["part"], shard, own.tobytes(), total[np.searchsorted(known, own)].tobytes(), b"", b"")
    out += rows.rest()
    return pa.Table.from_batches(out, schema=_COUNT)


def _cells(s: np.ndarray) -> bytes:
    """Shingles per cell, nothing if a count does not fit a byte."""
    n = np.bincount((mixed(s, 9) % np.uint64(CELLS)).astype(np.int64), minlength=CELLS)
    return n.astype(np.uint8).tobytes() if n.max() < 256 else b""


def most_shared(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """For each pair a[i], b[i] the most shingles that the two can share by their cells."""
    out = np.full(len(a), np.iinfo(np.int64).max)
    both = np.array([bool(x and y) for x, y in zip(a, b)], bool)
    at = np.flatnonzero(both)
    for i in range(0, len(at), 1 << 14):
        some = at[i : i + (1 << 14)].tolist()
        x, y = (np.frombuffer(b"".join([c[j] for j in some]), np.uint8).reshape(-1, CELLS) for c in (a, b))
        out[some] = np.minimum(x, y).sum(axis=1, dtype=np.int64)
    return out


def _entries(percent: int):
    """Per set its rarest shingles that it can share with another component.

    The shingles no other component holds come first in the order of rarity and match nothing, so of
    the prefix only what lies behind them is listed; nothing at all if too few are left for a link.
    `pos` counts the listed kind only, `common` is how many of it the set has. `weight` is in how many sets one of its
    shingles stands on average: most for the middle of a family, whose copies lose what they change.
    """

    def entries(sets: pa.Table, told: pa.Table) -> pa.Table:
        rows = told.to_pylist()
        known = np.concatenate([longs(r["shingle"]) for r in rows] or [np.empty(0, np.uint64)])
        count = np.concatenate([longs(r["n"], np.int64) for r in rows] or [np.empty(0, np.int64)])
        order = np.argsort(known)
        known, count = known[order], count[order]
        cols: list[list[np.ndarray]] = [[], [], [], [], [], [], []]
        cells: list[bytes] = []
        for rep, comp, data in zip(*(sets.column(c).to_pylist() for c in ("rep", "comp", "set"))):
            whole = unpack(data)
            s = whole[among(known, whole)]
            n, least = len(whole), at_least(len(whole), percent)
            if len(s) < least:
                continue
            held = count[np.searchsorted(known, s)]
            by = np.lexsort((s, held))[: len(s) - least + 1]  # rarest first
            m = len(by)
            row = (s[by].astype(np.int64), np.full(m, rep), np.full(m, comp), np.full(m, n), np.arange(m), np.full(m, len(s)),
                   np.full(m, held.sum() / n))
            for c, x in zip(cols, row):
                c.append(x)
            cells += [_cells(whole)] * m
        kinds = (np.int64, np.int64, np.int64, np.int32, np.int32, np.int32, np.float32)
        names = ("shingle", "rep", "comp", "n", "pos", "common", "weight")
        table = {k: pa.array(np.concatenate(c or [np.empty(0)]).astype(t)) for k, c, t in zip(names, cols, kinds)}
        return pa.table(table | {"cells": pa.array(cells, pa.binary())})

    return entries


def index(sets: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Lists of the shingles by which sets of different components may be linked, stored."""
    parts = parts_of(sets)
    marked = sets.join(labels, "rep").select(SHARD, "rep", "comp", "set")
    counts = marked.groupBy(SHARD).applyInArrow(tidy(_count(parts)), COUNT).groupBy("part").applyInArrow(tidy(_summed), COUNT)
    return written(marked.groupBy(SHARD).cogroup(counts.groupBy(SHARD)).applyInArrow(tidy(_entries(percent)), _ENTRY))


def may_link(a: dict[str, Column], b: dict[str, Column], percent: int) -> Column:
    """Whether two sets with an entry in one list can be linked at all, by size and position."""
    most = F.least(a["pos"], b["pos"]) + F.least(a["common"] - a["pos"], b["common"] - b["pos"])
    return (100 * F.least(a["n"], b["n"]) >= percent * F.greatest(a["n"], b["n"])) & (
        (100 + percent) * most >= percent * (a["n"] + b["n"]))


def _overlap(one: pa.Table, others: pa.Table) -> pa.Table:
    s = unpack(one.column("set")[0].as_py()) if one.num_rows else np.empty(0, np.uint64)
    x, y, inter, union = [], [], [], []
    for r in others.select(["x", "y", "set"]).to_pylist():
        t = unpack(r["set"])
        both = int(np.isin(t, s, assume_unique=True).sum())
        x.append(r["x"])
        y.append(r["y"])
        inter.append(both)
        union.append(len(s) + len(t) - both)
    return pa.table({"x": pa.array(x, pa.int64()), "y": pa.array(y, pa.int64()),
                     "inter": pa.array(inter, pa.int64()), "union": pa.array(union, pa.int64())})


def compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """`x`, `y`, `inter`, `union` of distinct pairs. A set with many partners is sent to several groups of them."""
    many = pairs.groupBy("x").agg(F.ceil(F.count("*") / GROUP).alias("groups"))
    dealt = written(pairs.join(many, "x").select("x", "y", F.pmod(F.xxhash64("y"), "groups").alias("group")))
    others = dealt.join(sets.select(F.col("rep").alias("y"), "set"), "y").select(
        *[F.col(c).alias(c) for c in ("x", "y", "group", "set")])  # new names: both sides come from the same tables
    one = dealt.select("x", "group").distinct().join(sets.select(F.col("rep").alias("x"), "set"), "x")
    out = written(one.groupBy("x", "group").cogroup(others.groupBy("x", "group")).applyInArrow(
        _overlap, "x long, y long, inter long, union long"))
    remove(dealt)
    return out


def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """`rep`, `comp`: the smallest node reachable by links x, y. Every round takes each node's smallest
    neighbouring label, then the label of that label; rounds are stored, and end when nothing changes."""
    both = written(links.select("x", "y").union(links.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct())
    labels = written(nodes.select("rep", F.col("rep").alias("comp")))
    while True:
        near = both.join(labels.select(F.col("rep").alias("y"), "comp"), "y").groupBy("x").agg(F.min("comp").alias("near"))
        new = written(labels.join(near, labels.rep == near.x, "left").select(
            "rep", "comp", F.least("comp", F.coalesce("near", "comp")).alias("new")))
        if new.filter("new < comp").isEmpty():
            remove(new, both)
            return labels
        jump = new.select(F.col("rep").alias("new"), F.col("new").alias("jump"))
        old, labels = labels, written(new.join(jump, "new").select("rep", F.least("new", "jump").alias("comp")))
        remove(old, new)


def _distinct(xs: list[np.ndarray], ys: list[np.ndarray]):
    """Pairs x < y of a batch, each once."""
    x, y = (np.concatenate(c or [np.empty(0, np.int64)]) for c in (xs, ys))
    if len(x):
        x, y = np.minimum(x, y), np.maximum(x, y)
        order = np.lexsort((y, x))
        x, y = x[order], y[order]
        new = np.r_[True, (x[1:] != x[:-1]) | (y[1:] != y[:-1])]
        yield pa.RecordBatch.from_arrays([pa.array(x[new]), pa.array(y[new])], names=["x", "y"])


def _columns(entries: list[dict], *names: str) -> dict[str, np.ndarray]:
    return {k: np.array([e[k] for e in entries]) for k in names}


def sure(percent: int) -> float:
    """Sets no farther apart than this are linked; a little slack covers rounding."""
    return 1 - percent / 100 - 1e-9


def _cross(percent: int):
    """Pairs of entries of two blocks of a list that may be linked, are of different components, and are not derived
    from a guide both have."""

    def cross(batches):
        for batch in batches:
            xs, ys = [], []
            for r in batch.to_pylist():
                a, b = (_columns(r[side], "rep", "comp", "n", "pos", "common", "g", "d") for side in ("a", "b"))
                n, m, i, j = a["n"][:, None], b["n"][None], a["pos"][:, None], b["pos"][None]
                most = np.minimum(i, j) + np.minimum(a["common"][:, None] - i, b["common"][None] - j)
                known = (a["g"][:, None] == b["g"][None]) & (a["d"][:, None] + b["d"][None] <= sure(percent))
                ok = (a["comp"][:, None] != b["comp"][None]) & (100 * np.minimum(n, m) >= percent * np.maximum(n, m)) & (
                    (100 + percent) * most >= percent * (n + m)) & ~known
                p, q = np.nonzero(ok)
                cells = [[e["cells"] for e in r[side]] for side in ("a", "b")]
                shared = most_shared([cells[0][i] for i in p.tolist()], [cells[1][i] for i in q.tolist()])
                least = -(-percent * (a["n"][p] + b["n"][q]) // (100 + percent))
                p, q = p[shared >= least], q[shared >= least]
                xs.append(a["rep"][p])
                ys.append(b["rep"][q])
            yield from _distinct(xs, ys)

    return cross


def _kin(percent: int):
    """Pairs of two blocks of a guide's partners whose distances from it add up to little enough."""

    def kin(batches):
        for batch in batches:
            for r in batch.to_pylist():
                a, b = (_columns(r[side], "rep", "d") for side in ("a", "b"))
                p, q = np.nonzero((a["d"][:, None] + b["d"][None] <= sure(percent)) & (a["rep"][:, None] != b["rep"][None]))
                yield from _distinct([a["rep"][p]], [b["rep"][q]])

    return kin


def _derived(guide: DataFrame, percent: int) -> DataFrame:
    """Links between the partners of a guide that follow from their distances to it, as distinct pairs."""
    row = F.row_number().over(Window.partitionBy("g").orderBy("d", "rep"))
    blocks = written(guide.filter("rep <> g").withColumn("block", F.floor((row - 1) / BLOCK)).groupBy("g", "block").agg(
        F.collect_list(F.struct("rep", "d")).alias("entries"), F.min("d").alias("least")))  # at most BLOCK
    a, b = blocks.alias("a"), blocks.alias("b")
    meet = a.join(b, (F.col("a.g") == F.col("b.g")) & (F.col("a.block") <= F.col("b.block"))
                  & (F.col("a.least") + F.col("b.least") <= sure(percent)))
    return meet.select(F.col("a.entries").alias("a"), F.col("b.entries").alias("b")).mapInArrow(tidy(_kin(percent)), "x long, y long")


def _left_over(entries: DataFrame, guide: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs that share a list, blocks of lists skipped by size and position, derived pairs left out."""
    several = entries.groupBy("shingle").agg(F.count("*").alias("sets")).filter("sets > 1").select("shingle")
    entries = entries.join(several, "shingle", "left_semi").join(guide, "rep")
    row = F.row_number().over(Window.partitionBy("shingle").orderBy("n", "rep"))
    blocks = written(
        entries.withColumn("block", F.floor((row - 1) / BLOCK)).groupBy("shingle", "block").agg(
            F.collect_list(F.struct("rep", "comp", "n", "pos", "common", "g", "d", "cells")).alias("entries"),  # at most BLOCK
            F.min("n").alias("least"), F.max("n").alias("most"), F.max("pos").alias("pos"),
            F.max(F.col("common") - F.col("pos")).alias("tail")))
    a, b = blocks.alias("a"), blocks.alias("b")
    meet = a.join(b, (F.col("a.shingle") == F.col("b.shingle")) & (F.col("a.block") <= F.col("b.block"))
                  & (100 * F.col("a.most") >= percent * F.col("b.least"))
                  & ((100 + percent) * (F.least("a.pos", "b.pos") + F.least("a.tail", "b.tail")) >= percent * (F.col("a.least") + F.col("b.least"))))
    return meet.select(F.col("a.entries").alias("a"), F.col("b.entries").alias("b")).mapInArrow(tidy(_cross(percent)), "x long, y long").distinct()


def _star(entries: DataFrame, percent: int) -> DataFrame:
    """Every list's hubs `x` with the others of it that may be linked to them, `y`, as distinct pairs in one direction.

    A hub is the set of the greatest weight among those of its size, sizes being cut where none of the second next can be
    linked; sets meet the hubs of their own size and of the next smaller one.
    """
    names = ("n", "pos", "common")
    sized = entries.withColumn("size", F.floor(F.log("n") / np.log(100 / percent)) if percent < 100 else F.col("n").cast("long"))
    hub = sized.groupBy("shingle", "size").agg(F.max(F.struct("weight", "rep", "comp", *names)).alias("hub"))
    near = hub.select("shingle", "hub", F.explode(F.array("size", F.col("size") + 1)).alias("size"))
    met = sized.join(near, ["shingle", "size"]).filter(F.col("comp") != F.col("hub.comp")).filter(
        may_link({c: F.col(f"hub.{c}") for c in names}, {c: F.col(c) for c in names}, percent))
    pair = met.select(F.col("hub.rep").alias("x"), F.col("rep").alias("y"))
    once = pair.groupBy(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).agg(F.max("x").alias("x"))
    return once.select("x", F.when(F.col("x") == F.col("a"), F.col("b")).otherwise(F.col("a")).alias("y"))


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"), "inter", "union")


def _away() -> Column:
    return 1 - F.col("inter") / F.col("union")


def _guides(sets: DataFrame, found: DataFrame) -> DataFrame:
    """Every set's most similar set among those it was compared with and is linked to, `g`, and its distance `d`; else itself."""
    nearest = found.groupBy(F.col("y").alias("rep")).agg(F.min(F.struct(_away().alias("d"), F.col("x").alias("g"))).alias("s"))
    return written(sets.select("rep").join(nearest, "rep", "left").select(
        "rep", F.coalesce("s.g", "rep").alias("g"), F.coalesce("s.d", F.lit(0.0)).alias("d")))


def _decided(entries: DataFrame, guide: DataFrame, star: DataFrame, sets: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Of the candidate pairs of the lists: those that the distances to their guides link, and the links among the others
    by comparison, with `inter` and `union`."""
    rest = _left_over(entries, guide, percent).join(star.select("x", "y"), ["x", "y"], "left_anti")
    guided = written(rest.join(guide.select(F.col("rep").alias("x"), F.col("g").alias("gx"), F.col("d").alias("dx")), "x")
                     .join(guide.select(F.col("rep").alias("y"), F.col("g").alias("gy"), F.col("d").alias("dy")), "y")
                     .withColumn("p", F.least("gx", "gy")).withColumn("q", F.greatest("gx", "gy")))
    pairs = guided.filter("p < q").select("p", "q").distinct()
    apart = star.join(pairs.select(F.col("p").alias("x"), F.col("q").alias("y")), ["x", "y"], "left_semi").select(
        F.col("x").alias("p"), F.col("y").alias("q"), _away().alias("far"))
    # |xy| lies between |gx gy| - |x gx| - |y gy| and the sum of the three.
    far = F.when(F.col("p") == F.col("q"), 0.0).otherwise(F.col("far"))
    bounds = written(guided.join(apart, ["p", "q"], "left").select(
        "x", "y", (far - F.col("dx") - F.col("dy")).alias("low"), (far + F.col("dx") + F.col("dy")).alias("high")).filter(
        f"low is null or low <= {1 - percent / 100} + 1e-9"))
    near = F.coalesce(F.col("high") <= sure(percent), F.lit(False))
    more = compared(bounds.filter(~near).select("x", "y"), sets).filter(is_link(percent))
    remove(guided)
    return bounds.filter(near).select("x", "y"), more


def is_link(percent: int) -> Column:
    return F.expr(f"100 * inter >= {percent} * union")


def links(sets: DataFrame, percent: int) -> DataFrame:
    """All links between the sets, stored: `x`, `y` (distinct pairs x < y), `inter` and `union`, NULL where derived."""
    entries = index(sets, sets.select("rep", F.col("rep").alias("comp")), percent)
    star = compared(_star(entries, percent), sets)
    guide = _guides(sets, star.filter(is_link(percent)))
    star = _ordered(star)
    found = star.filter(is_link(percent))
    # Partners of a guide that are themselves first in a list are compared above already.
    kin = written(_derived(guide, percent).join(star.select("x", "y"), ["x", "y"], "left_anti"))
    near, more = _decided(entries, guide, star, sets, percent)
    none = F.lit(None).cast("long")
    derived = kin.union(near).select("x", "y", none.alias("inter"), none.alias("union"))
    return written(found.union(more).union(derived))


def spanning(sets: DataFrame, percent: int) -> DataFrame:
    """`rep`, `comp`: the component of each set, by links that join all of it; stored.

    Two sets of different components after the round with the lists' first sets are listed if they can be linked; no
    others are. So no link between components is missed, and those inside one are not looked for.
    """
    entries = index(sets, sets.select("rep", F.col("rep").alias("comp")), percent)
    star = compared(_star(entries, percent), sets)
    remove(entries)
    labels = components(sets, star.filter(is_link(percent)))
    guide = _guides(sets, star.filter(is_link(percent)))
    entries = index(sets, labels, percent)
    near, more = _decided(entries, guide, _ordered(star), sets, percent)
    found = written(star.filter(is_link(percent)).select("x", "y").union(near).union(more.select("x", "y")))
    remove(entries, guide, star)
    return components(sets, found)


def _classes(docs: DataFrame, id_col: str, text_col: str, shingle: int, percent: int, bytes_per_shard: int) -> tuple[DataFrame, DataFrame]:
    """All rows with the key of their class, and the sets of the classes that may be linked."""
    base = texts(docs, id_col, text_col, bytes_per_shard)
    parts = parts_of(docs)
    asked = base.mapInArrow(tidy(_ask(shingle, percent, parts)), ASKED)
    told = written(asked.groupBy("part").applyInArrow(tidy(_tell), TOLD))
    every = written(packed(base).groupBy(SHARD).cogroup(told.groupBy(SHARD)).applyInArrow(
        _survivors(shingle, percent, parts), SETS))
    return every, _numbered(every)


def near_links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, shingle: int = SHINGLE,
               percent: int = PERCENT, bytes_per_shard: int = BYTES_PER_SHARD) -> tuple[DataFrame, DataFrame]:
    """All links between classes, and the members of the classes.

    Links: `x_key`, `y_key`, once per pair of linked sets that differ, `x_id`, `y_id`, the smallest ids of the
    classes, and `inter`, `union`, NULL for links that were derived and not compared. Members: `id`, `n` and
    `key`, one row per document; NULL for an empty set. Sets, links and ids are as in `near_duplicates`.
    """
    every, sets = _classes(docs, id_col, text_col, shingle, percent, bytes_per_shard)
    none = F.lit(NULL_ID)
    one, two = (sets.select(F.col("rep").alias(c), F.col("key").alias(f"{c}_key"), F.nullif("first", none).alias(f"{c}_id")) for c in "xy")
    found = links(sets, percent).join(one, "x").join(two, "y").select("x_key", "y_key", "x_id", "y_id", "inter", "union")
    return found, every.select(F.nullif("id", none).alias("id"), F.col("n").cast("long").alias("n"), "key")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, shingle: int = SHINGLE,
                    percent: int = PERCENT, bytes_per_shard: int = BYTES_PER_SHARD) -> DataFrame:
    """One row per document: `id`, `n` (its distinct shingles) and `component`, the smallest id reachable by links.

    Words are lower-cased (A-Z) runs between white space. A text of fewer words than a shingle has its
    whole sequence as its one shingle; one without words, or NULL, has an empty set and is linked with
    nothing. Two documents are linked when 100 times the intersection is at least `percent` times the
    union of their sets; no link between different sets is lost. Equal sets are one class, known by the
    128-bit hash of the set, and stored once; classes get their ids at the end. All rows of an id, whatever
    their texts, are members of one component; a NULL id is an id before all others. Other columns are not read.
    """
    every, sets = _classes(docs, id_col, text_col, shingle, percent, bytes_per_shard)
    labels = spanning(sets, percent)
    none = F.lit(NULL_ID)
    return _with_ids(every, sets, labels).select(
        F.nullif("id", none).alias("id"), F.col("n").cast("long").alias("n"), F.nullif("least", none).alias("component"))


def _numbered(every: DataFrame) -> DataFrame:
    """One row per class that may be linked, stored with a short number `rep` for its key."""
    return written(every.filter("set is not null").select(SHARD, "key", "first", "set", F.monotonically_increasing_id().alias("rep")))


def _with_ids(every: DataFrame, sets: DataFrame, labels: DataFrame) -> DataFrame:
    """`id`, `n`, `least` of all rows: the smallest id of the row's component, which also joins all rows of an id."""
    named = sets.select("key", "first", "rep").join(labels, "rep")
    least = named.groupBy("comp").agg(F.min("first").alias("least"))
    named = written(named.join(least, "comp").select("key", "least"))
    rows = written(every.select("id", "n", "key", "first").join(named, "key", "left").select(
        "id", "n", F.coalesce("least", "first").alias("least")))
    several = rows.groupBy("id").agg(F.min("least").alias("x"), F.max("least").alias("y")).filter("x < y").select("id", "x")
    again = written(rows.join(several, "id").filter("x < least").select("x", F.col("least").alias("y")).distinct())
    if again.isEmpty():
        return rows
    nodes = again.select(F.col("x").alias("rep")).union(again.select(F.col("y").alias("rep"))).distinct()
    joined = components(nodes, again).select(F.col("rep").alias("least"), "comp")
    return rows.join(joined, "least", "left").select("id", "n", F.coalesce("comp", "least").alias("least"))


def op10_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    found = near_duplicates(spark.read.parquet(f"{sf}/documents.parquet"))
    return found.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))
