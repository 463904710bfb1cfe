"""Distinct segmentations of texts into SentencePiece pieces, sampled without replacement.

All segmentations of a text form a lattice. Gumbel noise on their log probabilities turns the k most
probable of them into a sample of k without replacement; perturbed A* finds these k without listing the
others. A search node is a set of segmentations: those that agree with a path up to some piece and
differ there. Its bound is the largest perturbed score in it, drawn from the mass of the set, which the
forward scores of the lattice give exactly, below the score of the node it was cut from. The node with
the largest bound is opened next; completing it costs one pass and leaves new nodes along its path.

Pieces never hold a space but at their start, so the lattice of a text is a chain of lattices of its
words, and a word's lattice is built once for many texts. Texts of a batch run side by side in numpy.
"""

from __future__ import annotations

import itertools
import math
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlfold.llm.anchors import combined
from crawlfold.llm.exchange import NULL_ID, as_text, mixed, tidy

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SAMPLES = 2
SHARPNESS = 1.0
SEED = 17
_BATCH_BYTES = 1 << 19  # the arrays of a batch, some 20 MB, are gone through many times
#: Edges after which words are forgotten, about 25 bytes each, and those of the words used most that stay.
_MOST_EDGES = 2_500_000
_KEPT_EDGES = 1_000_000
_NEW_WORDS = 4_000
#: Letters, and pieces, up to which words are worked on side by side; the rest of longer ones goes one by one.
_SIDE_BY_SIDE = 2_000
_WORD = re.compile(r" *[^ ]+| +")
_OUT = ("rank int, ids array<int>, n_pieces int, log_prob double, perturbed double, log_inclusion double, exact boolean")
_TYPES = (pa.int32(), pa.list_(pa.int32()), pa.int32(), pa.float64(), pa.float64(), pa.float64(), pa.bool_())


@dataclass(frozen=True)
class Vocabulary:
    """Pieces with their spaces written out, their bytes, and log weights.

    A BPE model ranks its pieces instead of giving probabilities; ranks stand for frequencies by Zipf's
    law, `weight = -sharpness * log(1 + rank)`. A model with probabilities brings its scores.
    """

    pieces: dict[str, int]
    weights: np.ndarray
    data: list[bytes]
    first_byte: int

    @classmethod
    def read(cls, model: bytes, sharpness: float = SHARPNESS) -> Vocabulary:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = sp.get_piece_size()
        scores = np.array([sp.get_score(i) for i in range(n)])
        plain = [not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)) for i in range(n)]
        ranked = scores[plain].min() < -1000  # ranks, not log probabilities
        floor = scores[np.array(plain) & (scores > -1e8)].min()
        scores = np.maximum(scores, floor)
        weights = -sharpness * np.log1p(np.maximum(-scores, 0)) if ranked else sharpness * scores
        first = next(i for i in range(n) if sp.is_byte(i))
        weights[first : first + 256] = weights[plain].min()
        text = [sp.id_to_piece(i).replace("▁", " ") for i in range(n)]
        data = [bytes([i - first]) if sp.is_byte(i) else text[i].encode() if plain[i] else b"" for i in range(n)]
        return cls({text[i]: i for i in range(n) if plain[i]}, weights, data, first)

    def decode(self, ids: list[int]) -> bytes:
        """The text's bytes: pieces in a row, without the space that encoding put in front."""
        return b"".join(map(self.data.__getitem__, ids))[1:]


    def gives_back(self, ids: np.ndarray, ends: np.ndarray, texts: list[bytes]) -> list[bool]:
        """Whether the ids `ends[i] : ends[i + 1]` decode to text i, for all i at once; ends begin with 0."""
        if not len(ids):
            return [not t for t in texts]
        _, offsets, data = self.column.take(pa.array(ids)).buffers()
        to, data = np.frombuffer(offsets, np.int64)[ends].tolist(), data.to_pybytes()
        return [data[a + 1 : b] == t for a, b, t in zip(to[:-1], to[1:], texts)]

    @cached_property
    def column(self) -> pa.Array:
        """The bytes of all pieces."""
        return pa.array(self.data, pa.large_binary())


class Lattices:
    """Lattices of distinct words, all in one numbering of nodes; words stay until there are many, then those used most.

    Edges are sorted by the node they lead to; `begin[v] : begin[v + 1]` are those into v. `piece` is the
    piece of an edge, or -1 - c for a letter c that is spelled in bytes. `log_mass` is the log of an edge's
    share of its node's paths, `upto` the running sum of these shares, and more than any for a node's last edge. A word's numbers do not depend on other words.
    """

    def __init__(self, vocabulary: Vocabulary):
        # Every beginning of a piece has a key too, with the id -2 if it is no piece itself, so that a search goes no
        # further than pieces do.
        self.longest = max(map(len, vocabulary.pieces))
        prefixes: dict[str, int] = {}
        for piece, i in vocabulary.pieces.items():
            for n in range(1, len(piece)):
                prefixes.setdefault(piece[:n], -2)
            prefixes[piece] = i
        sizes = np.fromiter(map(len, prefixes), np.int64, len(prefixes))
        points = np.frombuffer("".join(prefixes).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        keys, first = np.zeros(len(prefixes), np.uint64), np.cumsum(sizes) - sizes
        for n in range(self.longest):
            some = np.flatnonzero(sizes > n)
            keys[some] = combined(keys[some], points[first[some] + n])
        order = np.argsort(keys)
        self.keys = np.r_[keys[order], np.uint64(2**64 - 1)]  # a search ends at the last key
        self.ids = np.r_[np.array(list(prefixes.values()), np.int32)[order], np.int32(-1)]
        self.slot = np.searchsorted(keys[order], np.arange(1 << 18, dtype=np.uint64) << np.uint64(46)).astype(np.int32)
        self.first = combined(np.uint64(0), np.arange(0x110000, dtype=np.uint64))  # the keys of all single letters
        self.first_id = self._find(self.first)
        self.vocabulary = vocabulary
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = defaultdict(itertools.count().__next__)  # a new word gets the next number
        self.uses = np.empty(0, np.int64)
        self.room: dict[str, np.ndarray] = {}
        none, real = np.empty(0, np.int32), np.empty(0)
        self.source, self.piece = none, none
        self.log_mass, self.upto, self.only = real, real, np.empty(0, bool)
        self.first_node, self.last_node, self.begin = none, none, np.zeros(1, np.int32)

    def _find(self, h: np.ndarray) -> np.ndarray:
        """Ids of the pieces with these keys, -2 for a beginning of pieces, -1 for neither."""
        at = self.slot[(h >> np.uint64(46)).view(np.int64)]
        key = self.keys[at]
        found = np.where(key == h, self.ids[at], np.int32(-1))
        open_ = np.flatnonzero(key < h)
        while len(open_):
            at = at[open_] + 1 if len(at) == len(h) else at + 1
            key, own = self.keys[at], h[open_]
            hit = key == own
            found[open_[hit]] = self.ids[at[hit]]
            more = key < own
            open_, at = open_[more], at[more]
        return found

    def numbered(self, words: list[list[str]]) -> np.ndarray:
        """Numbers of the words of a batch; lattices of new ones are added."""
        if len(self.piece) > _MOST_EDGES:
            self._forget()
        known, count = len(self.number), sum(map(len, words))
        found = np.fromiter(map(self.number.__getitem__, itertools.chain.from_iterable(words)), np.int64, count)
        new = list(itertools.islice(self.number, known, None))
        for a in range(0, len(new), _NEW_WORDS):
            self._add(new[a : a + _NEW_WORDS])
        uses = np.bincount(found, minlength=len(self.number))
        uses[:known] += self.uses
        self.uses = uses
        return found

    def _forget(self) -> None:
        """Drop all words but those used most, which keep their lattices under new numbers."""
        first, last = self.first_node, self.last_node
        size = self.begin[last + 1] - self.begin[first]
        order = np.argsort(-self.uses, kind="stable")
        many = (np.cumsum(size[order], dtype=np.int64) <= _KEPT_EDGES) & (self.uses[order] > 1)
        kept = np.sort(order[: len(order) if many.all() else int(np.argmin(many))])
        first, n_nodes, n_edges = first[kept], (last - first + 1)[kept], size[kept]
        new_first, new_edge = np.cumsum(n_nodes) - n_nodes, np.cumsum(n_edges) - n_edges
        node = np.arange(n_nodes.sum()) + np.repeat(first - new_first, n_nodes)
        edge = np.arange(n_edges.sum()) + np.repeat(self.begin[first] - new_edge, n_edges)
        shift = np.repeat(new_first - first, n_edges)
        into = np.cumsum(self.begin[node + 1] - self.begin[node])
        rows = {name: getattr(self, name)[edge] for name in ("piece", "log_mass", "upto", "only")}
        rows |= {"source": (self.source[edge] + shift).astype(np.int32), "first_node": new_first.astype(np.int32), "last_node": (new_first + n_nodes - 1).astype(np.int32),
                 "begin": into.astype(np.int32)}
        words, uses = list(self.number), self.uses[kept] // 2  # so that old uses count less and less
        room = self.room
        self.clear()
        self.room = room  # `rows` are copies
        for w in kept.tolist():
            self.number[words[w]]
        self.uses = uses
        for name, x in rows.items():
            self._append(name, x)

    def _add(self, words: list[str]) -> None:
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        sizes = np.fromiter(map(len, words), np.int32, len(words))
        ends = np.cumsum(sizes, dtype=np.int32)
        left = np.repeat(ends, sizes) - np.arange(len(points), dtype=np.int32)  # letters up to the word's end
        # Node numbers: letter i of word w begins at node i + w and ends at node i + w + 1.
        node = np.arange(len(points), dtype=np.int32) + np.repeat(np.arange(len(words), dtype=np.int32), sizes)
        letter = points.astype(np.int64)
        found_at, length = [], []  # per length (nodes that its pieces lead to, the pieces)
        at, h, found = np.arange(len(points), dtype=np.int32), self.first[letter], self.first_id[letter]
        for n in range(1, self.longest + 1):
            if n > 1:
                h = combined(h, letter[at + (n - 1)].view(np.uint64))
                found = self._find(h)
            hit = np.flatnonzero(found >= 0)
            found_at.append((node[at[hit]] + np.int32(n), found[hit]))
            length.append(n)
            if n == 1:  # letters without a piece are spelled in bytes
                alone = np.flatnonzero(found < 0)
                spelling = node[alone] + np.int32(1), -1 - points[alone].astype(np.int32)
            more = np.flatnonzero((found != -1) & (left[at] > n))
            at, h = at[more], h[more]
            if not len(at):
                break
        # Into a node a spelled letter first, then the longest piece; pieces of one length lead to different nodes.
        found_at, length = [spelling, *found_at[::-1]], [1, *length[::-1]]
        n_nodes = len(points) + len(words)
        count = np.zeros(n_nodes, np.int32)
        for to, _ in found_at:
            count[to] += 1
        begin = np.zeros(n_nodes + 1, np.int32)
        np.cumsum(count, out=begin[1:])
        source, piece, free = np.empty(begin[-1], np.int32), np.empty(begin[-1], np.int32), begin[:-1].copy()
        for (to, found), n in zip(found_at, length):
            e = free[to]
            free[to] += 1
            source[e] = to - np.int32(n)
            piece[e] = found
        target = np.repeat(np.arange(n_nodes, dtype=np.int32), count)
        first_node = ends - sizes + np.arange(len(words), dtype=np.int32)
        spelled = np.flatnonzero(piece < 0)
        weight = self.vocabulary.weights[np.maximum(piece, 0)]
        if len(spelled):
            weight[spelled] = self.vocabulary.weights[self.vocabulary.first_byte] * _n_bytes(-1 - piece[spelled])
        # Forward scores, all words side by side, one letter after the other.
        total = np.zeros(n_nodes)
        place = np.arange(n_nodes, dtype=np.int32) - np.repeat(first_node, sizes + 1)
        longest = int(sizes.max(initial=0))
        node_to = np.argsort(place.astype(np.uint16) if longest < 1 << 16 else place, kind="stable")[len(words) :]
        size = count[node_to]
        lead = np.cumsum(size, dtype=np.int64) - size
        by_place = np.repeat(begin[node_to] - lead, size) + np.arange(len(piece))
        from_, value_of = source[by_place], weight[by_place]
        cut = np.searchsorted(place[node_to], np.arange(1, longest + 2, dtype=np.int32))  # nodes of a place
        edge_cut = np.r_[lead, len(piece)][cut].tolist()
        cut = cut.tolist()
        for i in range(min(longest, _SIDE_BY_SIDE)):
            a, b, x, y = edge_cut[i], edge_cut[i + 1], cut[i], cut[i + 1]
            value, new = total[from_[a:b]] + value_of[a:b], lead[x:y] - a
            top = np.maximum.reduceat(value, new)
            value -= np.repeat(top, size[x:y])
            total[node_to[x:y]] = top + np.log(np.add.reduceat(np.exp(value), new))
        if longest > _SIDE_BY_SIDE:  # the few words that are longer, edge by edge
            a = edge_cut[_SIDE_BY_SIDE]
            self._long(total, from_[a:], np.repeat(node_to, size)[a:], value_of[a:])
        log_mass = total[source] + weight - np.repeat(total, count)
        upto = np.exp(log_mass)
        several, k = np.flatnonzero(count > 1), 1
        while len(several):
            e = begin[several] + k
            upto[e] += upto[e - 1]
            k += 1
            several = several[count[several] > k]
        upto[begin[1:][count > 0] - 1] = np.inf
        nodes, edges = len(self.begin) - 1, len(self.piece)
        add = self._append
        add("only", np.repeat(count == 1, count))
        for name, x in (("source", source + np.int32(nodes)), ("piece", piece),
                        ("log_mass", log_mass), ("upto", upto), ("first_node", first_node + np.int32(nodes)),
                        ("last_node", first_node + sizes + np.int32(nodes)), ("begin", begin[1:] + np.int32(edges))):
            add(name, x)

    def _append(self, name: str, more: np.ndarray) -> None:
        """Put values behind an array that has room; it is copied only when it doubles."""
        old = getattr(self, name)
        room, n = self.room.get(name), len(old) + len(more)
        if room is None or n > len(room):
            room = np.empty(max(2 * n, 1 << 12), more.dtype)
            room[: len(old)] = old
            self.room[name] = room
        room[len(old) : n] = more
        setattr(self, name, room[:n])

    @staticmethod
    def _long(total: np.ndarray, source: np.ndarray, target: np.ndarray, weight: np.ndarray) -> None:
        """Forward scores of the nodes that edges lead to; the edges are in order of place, those into a node together."""
        known: dict[int, float] = {}
        node, values = -1, []

        def close() -> None:
            top = max(values)
            known[node] = top + math.log(sum(math.exp(v - top) for v in values))

        for s, t, w in zip(source.tolist(), target.tolist(), weight.tolist()):
            if t != node:
                if values:
                    close()
                node, values = t, []
            values.append((known[s] if s in known else float(total[s])) + w)
        close()
        total[list(known)] = list(known.values())

    def pick(self, node: np.ndarray, u: np.ndarray) -> np.ndarray:
        """For each node an edge into it by shares."""
        e = self.begin[node]
        open_ = np.flatnonzero(self.upto[e] < u)
        next_, u = e[open_], u[open_]
        while len(open_):
            next_ += 1
            e[open_] = next_
            more = np.flatnonzero(self.upto[next_] < u)
            open_, next_, u = open_[more], next_[more], u[more]
        return e


def _n_bytes(letter: np.ndarray) -> np.ndarray:
    """Bytes of letters in UTF-8."""
    return 1 + (letter >= 0x80) + (letter >= 0x800) + (letter >= 0x10000)


def words_of(text: str) -> list[str]:
    """The words of a text behind a space, each with the spaces in front of it; spaces at the end are a word too."""
    if not text or "  " in text or "\0" in text or text[0] == " " or text[-1] == " ":
        return _WORD.findall(" " + text)
    return (" " + text.replace(" ", "\0 ")).split("\0")


def uniform(key: np.ndarray) -> np.ndarray:
    """In (0, 1), by a hash of the key."""
    return ((mixed(key) >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53


def _keys(ids: np.ndarray, seed: int, sample: int) -> np.ndarray:
    return mixed(mixed(ids.astype(np.int64).view(np.uint64), seed + 1), sample + 1)


@dataclass
class Paths:
    """One segmentation per text: its edges in order of decision, text by text.

    Words come in order, the pieces of a word from its end. `word` counts the words of the batch;
    `ends` are where texts end.
    """

    edge: np.ndarray
    word: np.ndarray
    ends: np.ndarray

    def of(self, text: int) -> slice:
        return slice(int(self.ends[text - 1]) if text else 0, int(self.ends[text]))


def _walk(lattices: Lattices, node: np.ndarray, stop: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """From each node back to its word's start: (edges, which walk), walk by walk."""
    edges, walks, rest = [], [], {}
    steps = np.zeros(len(node), np.int64)
    walk = np.flatnonzero(node > stop)
    walk = walk[np.argsort(node[walk])]  # so that what is read of the lattices lies in a row
    at, end, draw = node[walk], stop[walk], key[walk]
    step = 0
    while len(walk) and step < _SIDE_BY_SIDE:
        e = lattices.pick(at, uniform(draw + np.uint64(step)))
        edges.append(e)
        walks.append(walk)
        step += 1
        steps[walk] = step
        at = lattices.source[e]
        more = np.flatnonzero(at > end)
        walk, at, end, draw = walk[more], at[more], end[more], draw[more]
    for w, v in zip(walk.tolist(), at.tolist()):  # the few that go on, one after the other
        rest[w] = _walk_on(lattices, v, int(stop[w]), key[w : w + 1], step)
        steps[w] = step + len(rest[w])
    begin = np.cumsum(steps) - steps
    found = np.empty(steps.sum(), lattices.begin.dtype)
    for i, (e, walk) in enumerate(zip(edges, walks)):
        found[begin[walk] + i] = e
    for w, e in rest.items():
        found[begin[w] + step : begin[w] + step + len(e)] = e
    return found, np.repeat(np.arange(len(node)), steps)


def _walk_on(lattices: Lattices, node: int, stop: int, key: np.ndarray, step: int) -> np.ndarray:
    """The edges of one walk from a node on, piece by piece."""
    low, high = int(lattices.begin[stop]), int(lattices.begin[node + 1])
    upto, source = lattices.upto[low:high].tolist(), lattices.source[low:high].tolist()
    begin = (lattices.begin[stop : node + 1] - low).tolist()
    edges, draws = [], iter(())
    while node > stop:
        if (u := next(draws, None)) is None:
            draws = iter(uniform(key + np.arange(step, step + _SIDE_BY_SIDE, dtype=np.uint64)).tolist())
            step += _SIDE_BY_SIDE
            u = next(draws)
        e = begin[node - stop]
        while upto[e] < u:
            e += 1
        edges.append(e + low)
        node = source[e]
    return np.array(edges, lattices.begin.dtype)


class Sampler:
    """Draws the samples of one batch of texts."""

    def __init__(self, lattices: Lattices, seed: int):
        self.lattices, self.seed = lattices, seed

    def draw(self, ids: np.ndarray, texts: list[str], k: int) -> Iterator[tuple[int, int, np.ndarray, float, float, float]]:
        """(text, rank, ids, log probability, perturbed score, log inclusion probability)."""
        words = [words_of(t) if t else [] for t in texts]
        lat = self.lattices
        kind = lat.numbered(words)
        counts = np.array([len(w) for w in words], np.int64)
        owner = np.repeat(np.arange(len(texts)), counts)  # text of each word
        begins = np.cumsum(counts) - counts
        self.n_texts = len(texts)
        last, first = lat.last_node[kind], lat.first_node[kind]
        paths: list[Paths] = []
        agenda: list[np.ndarray] = []  # per path the bounds of the nodes along it
        scores: list[np.ndarray] = []
        bounds: list[np.ndarray] = []
        cut: dict[tuple[int, int, int], list[int]] = {}  # (path, text, place) -> further edges taken there
        alive = np.arange(len(texts))
        bound = -np.log(-np.log(uniform(mixed(_keys(ids, self.seed, 0), 999))))  # of the root: all segmentations, mass one
        taken: list[list[tuple[int, int]]] = [[] for _ in texts]
        from_path = np.full(len(texts), -1)
        from_place = np.zeros(len(texts), np.int64)
        fork = np.full(len(texts), -1)
        for rank in range(k):
            # Words to walk: all behind the fork, and what is left of the word that holds it.
            word_from = np.zeros(len(texts), np.int64)
            node = last.copy()
            use = np.zeros(len(kind), bool)
            kept_edges, kept_words, kept_owner = [], [], []
            for t in alive.tolist():
                if rank:
                    p, i, e = int(from_path[t]), int(from_place[t]), int(fork[t])
                    s = paths[p].of(t)
                    own, w = paths[p].edge[s][:i], paths[p].word[s][: i + 1]
                    kept_edges += [own, np.array([e])]
                    kept_words += [w]
                    kept_owner.append(np.full(len(w), t))
                    word = int(w[-1])
                    node[word] = lat.source[e]
                    use[word : begins[t] + counts[t]] = True
                else:
                    use[begins[t] : begins[t] + counts[t]] = True
            which = np.flatnonzero(use)
            nth = which - begins[owner[which]]
            key = mixed(_keys(ids, self.seed, rank)[owner[which]] + nth.astype(np.uint64), 5)
            edge, walk = _walk(lat, node[which], first[which], key)
            word = which[walk]
            fresh = np.ones(len(edge), bool)
            if kept_edges:
                edge = np.concatenate([*kept_edges, edge])
                word = np.concatenate([*kept_words, word])
                fresh = np.r_[np.zeros(len(edge) - len(fresh), bool), fresh]
                order = np.argsort(word, kind="stable")  # kept pieces of a word come before its new ones
                edge, word, fresh = edge[order], word[order], fresh[order]
            text = owner[word] if len(word) else np.empty(0, np.int64)
            ends = np.searchsorted(text, np.arange(len(texts)), "right")
            path = Paths(edge, word, ends)
            paths.append(path)
            log_mass = lat.log_mass[edge]
            start = np.r_[0, ends[:-1]]
            run, score = np.empty(len(edge)), np.zeros(len(texts))
            for t, (a, b) in enumerate(zip(start.tolist(), ends.tolist())):
                if b > a:
                    np.cumsum(log_mass[a:b], out=run[a:b])
                    score[t] = run[b - 1]
            scores.append(score)
            bounds.append(bound.copy())
            # Nodes that this path leaves: at each new piece, all paths that agree before and differ there.
            some = np.flatnonzero(fresh & ~lat.only[edge])
            of = text[some]
            noise = -np.log(uniform(mixed((_keys(ids, self.seed, rank) - start.astype(np.uint64))[of] + some.astype(np.uint64), 11)))
            rest = run[some] - log_mass[some] + np.log(np.maximum(1 - np.exp(log_mass[some]), 1e-300))
            value = np.full(len(edge), -np.inf)
            value[some] = -np.logaddexp(-bound[of], np.log(noise) - rest)
            agenda.append(value)
            again = -np.log(uniform(mixed(_keys(ids, self.seed, rank), 29)))
            for t in alive.tolist():
                taken[t].append((len(paths) - 1, rank))
                if rank:  # what is left of the node just opened
                    p, i = int(from_path[t]), int(from_place[t])
                    self._recut(paths[p], agenda[p], cut, p, t, i, int(fork[t]), float(bound[t]), float(again[t]))
            # The best node of every text.
            best = np.full(len(texts), -np.inf)
            for p, (q, v) in enumerate(zip(paths, agenda)):
                lo = np.r_[0, q.ends[:-1]]
                full = np.flatnonzero(q.ends > lo)
                if not len(full):
                    continue
                top = np.maximum.reduceat(v, lo[full])
                better = top > best[full]
                best[full[better]] = top[better]
                from_path[full[better]] = p
            bound = best
            alive = np.array([t for t in alive.tolist() if bound[t] > -np.inf], np.int64)
            if rank + 1 < k:
                draw = uniform(mixed(_keys(ids, self.seed, rank + 1), 23))
                for t in alive.tolist():
                    p = int(from_path[t])
                    s = paths[p].of(t)
                    i = int(np.argmax(agenda[p][s]))
                    from_place[t] = i
                    fork[t] = self._other(paths[p], cut, p, t, i, float(draw[t]))
        kappa = bound  # of the first segmentation that is not drawn; -inf if all were
        yield from self._results(paths, scores, bounds, kappa, taken)

    def _siblings(self, path: Paths, cut: dict, p: int, t: int, i: int) -> tuple[np.ndarray, np.ndarray]:
        lat = self.lattices
        edge = int(path.edge[path.of(t)][i])
        node = int(np.searchsorted(lat.begin, lat.begin.dtype.type(edge), "right")) - 1  # of one type: nothing is copied
        gone = {edge, *cut.get((p, t, i), ())}
        left = [e for e in range(int(lat.begin[node]), int(lat.begin[node + 1])) if e not in gone]
        return left, np.exp(lat.log_mass[left])

    def _other(self, path: Paths, cut: dict, p: int, t: int, i: int, u: float) -> int:
        left, mass = self._siblings(path, cut, p, t, i)
        return int(left[min(int(np.searchsorted(np.cumsum(mass), u * mass.sum())), len(left) - 1)])

    def _recut(self, path: Paths, value: np.ndarray, cut: dict, p: int, t: int, i: int, edge: int, bound: float, noise: float) -> None:
        cut.setdefault((p, t, i), []).append(edge)
        left, mass = self._siblings(path, cut, p, t, i)
        at = path.of(t).start + i
        if not len(left):
            value[at] = -np.inf
            return
        before = self.lattices.log_mass[path.edge[path.of(t)][:i]].sum()
        value[at] = -np.logaddexp(-bound, np.log(noise) - before - np.log(mass.sum()))

    def _results(self, paths, scores, bounds, kappa, taken):
        lat = self.lattices
        spelled: dict[int, np.ndarray] = {}
        flat = []
        for path in paths:
            # Text order: the pieces of a word were drawn from its end.
            n = len(path.edge)
            lead = np.flatnonzero(np.r_[True, path.word[1:] != path.word[:-1]]) if n else np.empty(0, np.int64)
            size = np.diff(np.r_[lead, n])
            turned = np.repeat(2 * lead + size - 1, size) - np.arange(n)
            edge = path.edge[turned]
            ids = lat.piece[edge]
            short = np.flatnonzero((ids < 0) & (ids >= -0x80))  # letters that are one byte
            ids[short] = -1 - ids[short] + lat.vocabulary.first_byte
            n_ids = np.ones(n, np.int64)
            spell = np.flatnonzero(ids < 0)
            n_ids[spell] = _n_bytes(-1 - ids[spell])
            ids, ends = np.repeat(ids, n_ids) if len(spell) else ids, np.cumsum(n_ids)
            for j in spell.tolist():
                e = int(edge[j])
                if e not in spelled:
                    data = chr(-1 - int(lat.piece[e])).encode("utf-8", "surrogatepass")
                    spelled[e] = np.frombuffer(data, np.uint8).astype(np.int32) + lat.vocabulary.first_byte
                ids[ends[j] - n_ids[j] : ends[j]] = spelled[e]
            flat.append((ids, np.r_[0, ends][path.ends]))
        for t in range(self.n_texts):
            for p, rank in taken[t]:
                ids, ends = flat[p]
                own = ids[(int(ends[t - 1]) if t else 0) : int(ends[t])]
                score, bound = float(scores[p][t]), float(bounds[p][t])
                gap = score - float(kappa[t])
                inclusion = float(np.log(-np.expm1(-np.exp(min(gap, 700.0))))) if gap > -30 else gap
                yield t, rank, own, score, bound, min(inclusion, 0.0)


_SAMPLERS: dict[tuple, Sampler] = {}


def _sampler(model: bytes, sharpness: float, seed: int) -> Sampler:
    key = (hash(model), sharpness, seed)
    if key not in _SAMPLERS:
        _SAMPLERS[key] = Sampler(Lattices(Vocabulary.read(model, sharpness)), seed)
    return _SAMPLERS[key]


def _batches(bodies: pa.Array, limit: int) -> Iterator[slice]:
    """Runs of texts of up to `limit` bytes, or one longer text."""
    a, size = 0, 0
    for i, n in enumerate(pc.binary_length(bodies).to_pylist()):
        size += n or 0
        if size >= limit:
            yield slice(a, i + 1)
            a, size = i + 1, 0
    if a < len(bodies):
        yield slice(a, len(bodies))


def _encode(sent, k: int, sharpness: float, seed: int, names: list[str]):
    def sampled(sampler, batch):
        vocabulary = sampler.lattices.vocabulary
        last = batch.num_columns - 1
        for some in _batches(batch.column(last), _BATCH_BYTES):
            part = batch.slice(some.start, some.stop - some.start)
            ids, bodies = part.column(last - 1).to_pylist(), part.column(last).to_pylist()
            texts = [(b or b"").decode("utf-8", "replace") for b in bodies]
            found = list(sampler.draw(np.array(ids, np.int64), texts, k))
            rows = pa.array([f[0] for f in found], pa.int64())
            flat = np.concatenate([f[2] for f in found] or [np.empty(0, np.int32)])
            ends = np.cumsum([0, *(len(f[2]) for f in found)])
            exact = vocabulary.gives_back(flat, ends, [bodies[f[0]] or b"" for f in found])
            new = [pa.array([f[1] + 1 for f in found], _TYPES[0]), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32())),
                   pa.array([len(f[2]) for f in found], _TYPES[2]), *(pa.array([f[j] for f in found], pa.float64()) for j in (3, 4, 5)),
                   pa.array(exact, pa.bool_())]
            own = [part.column(i).take(rows) for i in range(last - 1)]
            yield pa.RecordBatch.from_arrays([*own, *new], names=names)

    def encode(batches):
        sampler = _sampler(sent.value, sharpness, seed)
        try:
            for batch in batches:
                yield from sampled(sampler, batch)
        finally:  # the vocabulary stays with the worker, the words of this task do not
            sampler.lattices.clear()

    return encode


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, model: str = MODEL, samples: int = SAMPLES,
           sharpness: float = SHARPNESS, seed: int = SEED, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns `keep` of `docs` and, per text, up to `samples` rows of distinct segmentations:

    `rank` (from 1, by falling `perturbed` score), `ids`, `n_pieces`, `log_prob` of the segmentation,
    `log_inclusion`: the log probability that it is drawn given the score of the first that was not,
    `exact`: whether decoding the ids gives back the text's bytes.

    Draws depend on the seed, the id and the text alone, so repeated rows agree and partitions do not
    matter. A text with fewer segmentations gives fewer rows, all with inclusion one. NULL and empty
    texts have one segmentation, the empty one. Letters without a piece are spelled in byte pieces, as is
    U+2581 itself. Bytes that are not UTF-8 are replaced, and `exact` tells. Columns of `docs` that are
    not in `keep` do not matter.
    """
    with open(model, "rb") as f:
        sent = docs.sparkSession.sparkContext.broadcast(f.read())
    fields = {f.name: f for f in docs.schema.fields}
    schema = ", ".join([*(f"`{c}` {fields[c].dataType.simpleString()}" for c in keep), _OUT])
    own = docs.select(*(f"`{c}`" for c in keep), F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(NULL_ID)).alias("__key"),
                      F.col(f"`{text_col}`").cast("binary").alias("__body"))
    names = [*keep, *(c.split()[0] for c in _OUT.split(", "))]
    return own.mapInArrow(tidy(_encode(sent, samples, sharpness, seed, names)), schema)


def decode(encoded: DataFrame, *, model: str = MODEL, ids_col: str = "ids", text_col: str = "text") -> DataFrame:
    """`encoded` with its ids turned into text. NULL ids give NULL."""
    with open(model, "rb") as f:
        sent = encoded.sparkSession.sparkContext.broadcast(f.read())
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields), f"`{text_col}` string"])
    at = encoded.columns.index(ids_col)

    def run(batches):
        vocabulary = Vocabulary.read(sent.value)
        for batch in batches:
            texts = as_text([None if x is None else vocabulary.decode(x) for x in batch.column(at).to_pylist()])
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], names=[*batch.schema.names, text_col])

    return encoded.mapInArrow(run, schema)


def op1_sentencepiece_sampling(spark: SparkSession, sf: str) -> DataFrame:
    return encode(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text"))
