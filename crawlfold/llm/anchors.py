"""Repeated windows of n tokens, found through a few anchors per window length.

An anchor of a window is its run of k tokens ("gram") with the smallest hash, the leftmost on a tie.
Equal windows have equal anchors at equal offsets, so only anchors need to be compared across the
corpus: about 2 in n - k + 2 positions instead of all. Everything here works on one array of tokens
in which documents stand between pads of n tokens that occur in no document.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from crawlfold.llm.exchange import (
    PACKED, SHARD, Rows, by_shard, cuts, hash64, longs, mixed, packed, parts_of, unpacked,
)
from crawlfold.session import written

_P, _Q = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_CHUNK = 1 << 16
PAD_TOKEN = np.uint64(0x5851F42D4C957F2D)
_BYTE_TOKENS = mixed(np.arange(256, dtype=np.uint64), 77)


def combined(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Hash of a run from the hashes of its two halves."""
    z = x * _P
    z += y
    z ^= z >> np.uint64(29)
    z *= _Q
    z ^= z >> np.uint64(32)
    return z


@dataclass
class Tokens:
    """Documents laid out for windows: `raw` holds bytes, or 64-bit word hashes, and the pads."""

    raw: np.ndarray
    starts: np.ndarray
    sizes: np.ndarray

    def part(self, a: int, b: int) -> np.ndarray:
        return _BYTE_TOKENS[self.raw[a:b]] if self.raw.dtype == np.uint8 else self.raw[a:b]

    def digits(self, at: np.ndarray, n: int) -> Iterator[np.ndarray]:
        """The n tokens from each place on as 64-bit numbers, one array per digit; the last bytes may overlap those before."""
        if self.raw.dtype != np.uint8:
            yield from (self.raw[at + j] for j in range(n))
            return
        views = np.lib.stride_tricks.sliding_window_view(self.raw, 8)
        for step in (*range(0, n - 7, 8), *([n - 8] if n % 8 else [])):
            yield views[at + step].view(">u8")[:, 0].astype(np.uint64)


def of_bytes(bodies: list[bytes | None], n: int) -> Tokens:
    """0xFF pads: no UTF-8 text holds that byte."""
    sizes = np.array([len(b or b"") for b in bodies], np.int64)
    pad = b"\xff" * n
    raw = np.frombuffer(pad + b"".join(p for b in bodies for p in (b or b"", pad)), np.uint8)
    return Tokens(raw, n + np.cumsum(sizes + n) - sizes - n, sizes)


def of_words(words: list[list[bytes]], n: int) -> Tokens:
    sizes = np.array([len(w) for w in words], np.int64)
    starts = n + np.cumsum(sizes + n) - sizes - n
    total = int(sizes.sum())
    raw = np.full(total + n * (len(words) + 1), PAD_TOKEN, np.uint64)
    place = np.arange(total) + np.repeat(n * np.arange(1, len(words) + 1), sizes)
    raw[place] = hash64((w for own in words for w in own), total)
    return Tokens(raw, starts, sizes)


@dataclass
class Anchors:
    """One entry per anchor, in order of place.

    The windows it stands for start `high` to `low` tokens before it. `gram` is its hash, `near` that of
    its surroundings, which decide `low` and `high`: anchors with equal gram and near stand for equal windows.
    """

    at: np.ndarray
    doc: np.ndarray
    low: np.ndarray
    high: np.ndarray
    gram: np.ndarray
    near: np.ndarray

    def take(self, which: np.ndarray) -> Anchors:
        return Anchors(*(getattr(self, f)[which] for f in ("at", "doc", "low", "high", "gram", "near")))


def _grams(tokens: np.ndarray, k: int) -> np.ndarray:
    out, have, power, span = None, 0, tokens, 1
    while True:
        if k & span:
            if out is None:
                out = power
            else:
                out = combined(out[: len(out) - span], power[have : have + len(out) - span])
            have += span
        if span * 2 > k:
            return out
        power = combined(power[:-span], power[span:])
        span *= 2


def _window_min(keys: np.ndarray, w: int) -> np.ndarray:
    span = 1
    while span * 2 <= w:
        keys = np.minimum(keys[:-span], keys[span:])
        span *= 2
    return np.minimum(keys[: len(keys) - (w - span)], keys[w - span :]) if span < w else keys


def surroundings(tokens: Tokens, at: np.ndarray, n: int, k: int) -> np.ndarray:
    """Hash of all tokens that a window of n around the k tokens at each place can reach, pads included."""
    out = np.zeros(len(at), np.uint64)
    for digit in tokens.digits(at - (n - k), 2 * n - k):
        out = combined(out, digit)
    return out


def find(tokens: Tokens, n: int, k: int) -> Anchors:
    w = n - k + 1
    mask = np.uint64((1 << 17) - 1)
    total = len(tokens.raw)
    edge = np.zeros(total + 1, np.int8)
    long = tokens.sizes >= n
    np.add.at(edge, tokens.starts[long], 1)
    np.add.at(edge, tokens.starts[long] + tokens.sizes[long] - n + 1, -1)
    valid = np.cumsum(edge[:-1], dtype=np.int8) > 0
    found = []
    for a in range(0, max(total - n + 1, 0), _CHUNK):
        b = min(a + _CHUNK, total - n + 1)
        own = valid[a:b]
        if not own.any():
            continue
        grams = _grams(tokens.part(a, b + n - 1), k)
        keys = (grams & ~mask) | np.arange(len(grams), dtype=np.uint64)
        at = (_window_min(keys, w) & mask).astype(np.int64)
        at[~own] = -1
        first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        last = np.r_[first[1:], len(at)] - 1
        real = at[first] >= 0
        first, last = first[real], last[real]
        found.append((at[first] + a, first + a, last + a, grams[at[first]]))
    if not found:
        e, u = np.empty(0, np.int64), np.empty(0, np.uint64)
        return Anchors(e, e, e, e, u, u)
    at, first, last, gram = (np.concatenate(x) for x in zip(*found))
    new = np.r_[True, at[1:] != at[:-1]]  # an anchor whose windows were cut by a chunk is one anchor
    lead = np.flatnonzero(new)
    at, first, gram = at[lead], first[lead], gram[lead]
    last = last[np.r_[lead[1:], len(new)] - 1]
    low, high = at - last, at - first
    gram = mixed(gram, 5)  # anchors have small hashes; key ranges want even ones
    near = surroundings(tokens, at, n, k)
    if tokens.raw.dtype == np.uint8:  # text that is not UTF-8 may hold the pad's byte: tell it from a pad
        near = combined(near, (low * 65536 + high).astype(np.uint64))
    return Anchors(at, np.searchsorted(tokens.starts, at, "right") - 1, low, high, gram, near)


def classes(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, starts): rows sorted by the keys, first key first, and where each group of equal keys begins."""
    order = np.lexsort(keys[::-1])
    if not len(order):
        return order, order
    new = np.zeros(len(order), bool)
    new[0] = True
    for key in keys:
        s = key[order]
        new[1:] |= s[1:] != s[:-1]
    return order, np.flatnonzero(new)


def firsts(order: np.ndarray, starts: np.ndarray, doc: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Per group of `classes` the entry with the smallest document and place."""
    sizes = np.diff(np.r_[starts, len(order)])
    group = np.repeat(np.arange(len(starts)), sizes)
    by_place = np.lexsort((at[order], doc[order], group))
    return order[by_place[starts]]


def covered(tokens: Tokens, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Which tokens lie in one of the ranges [first, last) of the layout."""
    edge = np.zeros(len(tokens.raw) + 1, np.int32)
    np.add.at(edge, first, 1)
    np.add.at(edge, last, -1)
    return np.cumsum(edge[:-1], dtype=np.int32) > 0


# The exchange: which grams recur, which of them in several surroundings.

_ASKED = pa.schema([("part", pa.int32()), (SHARD, pa.int64()), ("gram", pa.binary()), ("near", pa.binary()), ("n", pa.binary())])
_TOLD = pa.schema([(SHARD, pa.int64()), ("gram", pa.binary()), ("several", pa.binary())])
ASKED = f"part int, {SHARD} long, gram binary, near binary, n binary"
TOLD = f"{SHARD} long, gram binary, several binary"
Lay = Callable[[list], Tokens]


def _ask(lay: Lay, n: int, k: int, parts: int):
    def ask(batches):
        rows = Rows(_ASKED)
        for shard, _, bodies in by_shard(batches, 4 << 20):
            a = find(lay(bodies), n, k)
            order, starts = classes(a.gram, a.near)
            counts = np.minimum(np.diff(np.r_[starts, len(order)]), 2).astype(np.uint8)
            gram, near = a.gram[order[starts]], a.near[order[starts]]
            for p, s in cuts(gram, parts):
                yield from rows.add(p, shard, gram[s].tobytes(), near[s].tobytes(), counts[s].tobytes())
        yield from rows.rest()

    return ask


def _tell(table: pa.Table) -> pa.Table:
    rows = table.to_pylist()
    gram = np.concatenate([longs(r["gram"]) for r in rows])
    near = np.concatenate([longs(r["near"]) for r in rows])
    n = np.concatenate([longs(r["n"], np.uint8) for r in rows])
    order, starts = classes(gram, near)
    lead = gram[order[starts]]  # one per surroundings
    first = np.flatnonzero(np.r_[True, lead[1:] != lead[:-1]])
    total = np.add.reduceat(np.add.reduceat(n[order].astype(np.int64), starts), first)
    several = np.diff(np.r_[first, len(lead)]) > 1
    known, several = lead[first][total > 1], several[total > 1]
    out = Rows(_TOLD)
    batches = []
    for r in rows:
        own = np.unique(longs(r["gram"]))
        i = np.searchsorted(known, own)
        hit = (i < len(known)) & (known[np.minimum(i, max(len(known) - 1, 0))] == own) if len(known) else np.zeros(len(own), bool)
        if hit.any():
            batches += out.add(r[SHARD], own[hit].tobytes(), several[i[hit]].astype(np.uint8).tobytes())
    batches += out.rest()
    return pa.Table.from_batches(batches, schema=_TOLD)


def recurring(base: DataFrame, lay: Lay, n: int, k: int) -> DataFrame:
    """Per shard of `base`: its grams that stand at two or more places of the corpus, and whether their
    surroundings differ. 17 bytes per distinct anchor of a shard are shuffled; the result is stored."""
    asked = base.mapInArrow(_ask(lay, n, k, parts_of(base)), ASKED)
    return written(asked.groupBy("part").applyInArrow(_tell, TOLD))


@dataclass
class Known:
    """Grams of a shard that recur, sorted."""

    gram: np.ndarray
    several: np.ndarray

    @classmethod
    def of(cls, told: pa.Table) -> Known:
        gram = np.concatenate([longs(x) for x in told.column("gram").to_pylist()] or [np.empty(0, np.uint64)])
        several = np.concatenate([longs(x, np.uint8) for x in told.column("several").to_pylist()] or [np.empty(0, np.uint8)])
        gram, at = np.unique(gram, return_index=True)
        return cls(gram, several[at].astype(bool))

    def among(self, gram: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of `gram` recur; which of those in several surroundings."""
        if not len(self.gram):
            return np.zeros(len(gram), bool), np.empty(0, bool)
        i = np.minimum(np.searchsorted(self.gram, gram), len(self.gram) - 1)
        hit = self.gram[i] == gram
        return hit, self.several[i[hit]]


__all__ = ["PACKED", "Anchors", "Known", "Tokens", "classes", "covered", "find", "firsts", "of_bytes", "of_words", "packed", "recurring", "unpacked"]
