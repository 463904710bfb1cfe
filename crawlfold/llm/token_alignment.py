"""Which tokens of two tokenizers stand for the same text, and how often over the whole corpus.

The bytes of a document are cut where a token of A and a token of B end together. Inside such a group every
A token is linked with every B token. How many documents hold a linked pair of ids is counted by external
spilling:

1. A task cuts its documents into runs of a few MB. It sorts the run's (pair, document) records by radix of
   the A id, then pair, then document, and stores each radix part compressed: the distinct pairs with their
   numbers of documents apart from the records, so that counting reads the former alone.
2. Runs of one radix are merged by a heap over the ends of their blocks, up to FAN_IN at a time, in as many
   rounds as that takes. What a merge holds and returns is bounded by the pairs of the two vocabularies, not by
   the corpus. Pairs come out with all pairs of an A id together, so the last round also knows each A id's
   greatest count when it leaves that id.
3. The counts of a radix meet the records of each run once more, and what each record contributes goes back
   to its document.

A word with the white space in front of it is tokenized once per task and cache: neither tokenizer has a token
that goes on from a letter to a space, so both end a token at the end of every word.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import math
import os
import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from crawlfold.llm.exchange import NULL_ID, Rows, longs, tidy
from crawlfold.session import written

A_FILE = "/opt/tokenizers/byte_bpe_50k.json"
B_FILE = "/opt/tokenizers/piece_bpe_32k.model"
#: Text of one run, its documents at most, radix parts of the A ids, and runs that one merge opens.
RUN_BYTES, RUN_DOCS, RADIX, FAN_IN = 4 << 20, 1 << 16, 64, 128
#: Runs whose records one task holds against one copy of the counts.
RUNS_A_TASK = 64
#: Pairs of one stored block of a merged run.
BLOCK_PAIRS = 1 << 16
#: Words whose tokens a task keeps, and links of these words.
KEPT_WORDS, KEPT_LINKS = 300_000, 4_000_000
#: Texts tokenized at once.
CHUNK_BYTES, CHUNK_DOCS = 1 << 19, 1024
#: White space behind a word, as far as a word follows it.
_NEXT = re.compile(r"(?<=\S)(?= \s*\S)")
_SPACES = re.compile(r" \s|\s ")


class Vocabularies:
    """Both tokenizers, and the bytes of their tokens."""

    def __init__(self, a_file: str, b_file: str):
        self.a = Tokenizer.from_file(a_file)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_file)
        letters = _byte_letters()
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            self.a_bytes[i] = bytes(letters.get(c, 0) for c in token) if all(c in letters for c in token) else token.encode()
        self.b_bytes = [
            bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
            for i in range(self.b.get_piece_size()) for p in (self.b.id_to_piece(i),)
        ]
        self.a_size = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_size = np.array([len(x) for x in self.b_bytes], np.int64)
        self.n_b = len(self.b_bytes)
        # An id in decimal and the sign behind it, by sign and id; the widest is six bytes, and empty bytes are taken out.
        digits = [str(i) for i in range(max(len(self.a_bytes), self.n_b))]
        self.written = np.array([[d + sign for d in digits] for sign in ",|;"], "S6")
        self.width = np.char.str_len(self.written[0]).astype(np.int64)

    def encode(self, words: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of both tokenizers for words that begin with a space, which B adds itself."""
        a = [e.ids for e in self.a.encode_batch_fast(words, add_special_tokens=False)]
        return a, self.b.encode([w[1:] for w in words], num_threads=1)


def _byte_letters() -> dict[str, int]:
    """The byte that a letter of a byte-level vocabulary stands for: printable ones themselves, the others from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


@lru_cache(maxsize=1)
def vocabularies(a_file: str, b_file: str) -> Vocabularies:
    """Of fixed size, so a worker keeps them from task to task."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return Vocabularies(a_file, b_file)


def words_of(text: str) -> list[str]:
    """`text`, which begins with a space, cut in front of every space that stands between a word and the next."""
    if text[-1:].isspace() or _SPACES.search(text):
        return _NEXT.split(text)
    return [" " + w for w in text[1:].split(" ")]


def _text(body: bytes | None) -> str:
    """The text; nothing for bytes that are not UTF-8, as no tokens give them back."""
    try:
        return (body or b"").decode()
    except UnicodeDecodeError:
        return ""


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Values of all lists, and which list each is of."""
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    values = np.fromiter(chain.from_iterable(lists), np.int64, int(sizes.sum()))
    return values, np.repeat(np.arange(len(lists)), sizes)


def _counted(group: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (group, id), sorted, with their numbers."""
    key, n = np.unique(group << 20 | ids, return_counts=True)
    return key >> 20, key & 0xFFFFF, n


class Words:
    """Tokens, groups and links of words, numbered as they are met."""

    def __init__(self, vocabularies: Vocabularies):
        self.v = vocabularies
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.groups: list[bytes] = []  # as they are written, each with a semicolon behind it
        self.broken = np.zeros(0, bool)  # the tokens do not give back the word
        self.facts = np.empty((0, 4), np.int64)  # n_a, n_b, n_groups, n_links
        self.ends = np.zeros(1, np.int64)
        self.pairs = np.empty(0, np.int32)
        self.weights = np.empty(0, np.int32)

    def learn(self, texts: list[list[str]]) -> None:
        """Number the words of some texts; forget all others first if too many are known."""
        new = {w: None for words in texts for w in words if w not in self.number}
        if len(self.number) + len(new) > KEPT_WORDS or len(self.pairs) > KEPT_LINKS:
            self.clear()
            new = {w: None for words in texts for w in words}
        if new:
            self._add(list(new))

    def _add(self, words: list[str]) -> None:
        a, b = self.v.encode(words)
        good = self._given_back(words, a, b)
        if not good.all():
            a, b = [x if g else [] for x, g in zip(a, good)], [x if g else [] for x, g in zip(b, good)]
        (a_ids, a_word), (b_ids, b_word) = _flat(a), _flat(b)
        a_end, b_end = np.cumsum(self.v.a_size[a_ids]), np.cumsum(self.v.b_size[b_ids])
        cuts = np.intersect1d(a_end, b_end)
        a_group, b_group = np.searchsorted(cuts, a_end), np.searchsorted(cuts, b_end)
        word = np.zeros(len(cuts), np.int64)
        word[a_group] = a_word
        n, g = len(words), len(cuts)
        n_a, n_b = np.bincount(a_group, minlength=g), np.bincount(b_group, minlength=g)
        links = np.bincount(word, n_a * n_b, n).astype(np.int64)
        facts = np.stack([np.bincount(a_word, minlength=n), np.bincount(b_word, minlength=n), np.bincount(word, minlength=n), links], axis=1)
        ga, ia, ca = _counted(a_group, a_ids)
        gb, ib, cb = _counted(b_group, b_ids)
        first, many = np.searchsorted(gb, ga), np.bincount(gb, minlength=g)[ga]
        left = np.repeat(np.arange(len(ga)), many)
        right = np.arange(len(left)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(first, many)
        per_word = np.bincount(word[ga[left]], minlength=n)
        self.pairs = np.concatenate([self.pairs, (ia[left] * self.v.n_b + ib[right]).astype(np.int32)])
        self.weights = np.concatenate([self.weights, (ca[left] * cb[right]).astype(np.int32)])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(per_word)])
        self.facts = np.concatenate([self.facts, facts])
        self.groups += self._written(a_ids, b_ids, a_group, b_group, a_word, b_word, n)
        self.broken = np.concatenate([self.broken, ~good])
        self.number |= zip(words, range(len(self.number), len(self.number) + n))

    def _given_back(self, words: list[str], a: list[list[int]], b: list[list[int]]) -> np.ndarray:
        """Which words both tokenizers give back byte by byte."""
        v, texts = self.v, [w.encode() for w in words]
        whole, sizes = b"".join(texts), np.fromiter(map(len, texts), np.int64, len(texts))
        good = np.ones(len(words), bool)
        for lists, of, size in ((a, v.a_bytes, v.a_size), (b, v.b_bytes, v.b_size)):
            ids, word = _flat(lists)
            if (np.bincount(word, size[ids], len(words)) != sizes).any() or b"".join(map(of.__getitem__, ids.tolist())) != whole:
                good &= np.array([b"".join(map(of.__getitem__, x)) == t for x, t in zip(lists, texts)], bool)
        return good

    def _written(self, a_ids, b_ids, a_group, b_group, a_word, b_word, n: int) -> list[bytes]:
        """The groups of each word, `a1,a2|b1;a3|b2;`: every id with the sign behind it, put in place at once."""
        v = self.v
        a_of, b_of = np.bincount(a_group, minlength=len(b_group) and b_group[-1] + 1), np.bincount(b_group)
        at_a = np.arange(len(a_ids)) + (np.cumsum(b_of) - b_of)[a_group]
        at_b = np.arange(len(b_ids)) + np.cumsum(a_of)[b_group]
        signs = np.zeros(len(a_ids) + len(b_ids), np.int64)
        signs[at_a[np.cumsum(a_of) - 1]] = 1
        signs[at_b[np.cumsum(b_of) - 1]] = 2
        ids = np.empty(len(signs), np.int64)
        ids[at_a], ids[at_b] = a_ids, b_ids
        data = v.written[signs, ids].tobytes().replace(b"\0", b"")
        sizes = np.bincount(a_word, v.width[a_ids], n) + np.bincount(b_word, v.width[b_ids], n)
        ends = np.cumsum(sizes).astype(np.int64).tolist()
        return [data[x:y] for x, y in zip([0, *ends], ends)]

    def links(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place in `numbers`, pair, how often) of all links of the words."""
        many = self.ends[numbers + 1] - self.ends[numbers]
        at = np.repeat(np.arange(len(numbers)), many)
        row = np.arange(len(at)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(self.ends[numbers], many)
        return at, self.pairs[row].astype(np.int64), self.weights[row]


def radix_of(a_ids: np.ndarray, radix: int) -> np.ndarray:
    """Part of an A id: a multiplicative hash, as frequent ids lie close together."""
    return (((a_ids.astype(np.uint64) * np.uint64(2654435761)) & np.uint64(0xFFFFFFFF)) * np.uint64(radix) >> np.uint64(32)).astype(np.int64)


def _press(x: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(x.tobytes())


def _open(data: bytes, kind=np.int64) -> np.ndarray:
    return longs(zstandard.ZstdDecompressor().decompress(data), kind)


def _press_sorted(x: np.ndarray) -> bytes:
    """Sorted numbers by their steps."""
    return _press(np.diff(x, prepend=0).astype(np.uint32))


def _open_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(_open(data, np.uint32).astype(np.int64))


#: A run's part: `pairs` and `counts` are its head, `docs` and `often` its records in pair order. Radix -1: the run's documents.
RUNS = "radix int, run long, size int, pairs binary, counts binary, docs binary, often binary"
_RUNS = pa.schema([("radix", pa.int32()), ("run", pa.int64()), ("size", pa.int32()), *((n, pa.binary()) for n in ("pairs", "counts", "docs", "often"))])


class _Run:
    """Documents of a run: facts of each, and their links."""

    def __init__(self, words: Words, radix: int):
        self.words, self.radix = words, radix
        self.clear()

    def clear(self) -> None:
        self.ids, self.facts, self.shas = [], [], []
        self.keys, self.often, self.bytes = [], [], 0

    def add(self, ids: list[int | None], bodies: list[bytes | None]) -> None:
        first, w = len(self.ids), self.words
        self.ids += [NULL_ID if i is None else i for i in ids]
        self.bytes += sum(len(b or b"") + 64 for b in bodies)
        cut = [words_of(" " + t) if (t := _text(b)) else [] for b in bodies]
        w.learn(cut)
        sizes = np.fromiter(map(len, cut), np.int64, len(cut))
        numbers = np.fromiter(map(w.number.__getitem__, chain.from_iterable(cut)), np.int64, int(sizes.sum()))
        doc = np.repeat(np.arange(len(cut)), sizes)
        parts = list(map(w.groups.__getitem__, numbers.tolist()))
        broken = np.zeros(len(cut), bool)
        broken[doc[w.broken[numbers]]] = True
        ends = np.cumsum(sizes).tolist()
        for n, end, bad in zip(sizes.tolist(), ends, broken.tolist()):
            self.shas.append(hashlib.sha256(b"".join(parts[end - n : end])[:-1]).hexdigest() if n and not bad else "")
        whole = ~broken[doc]
        numbers, doc = numbers[whole], doc[whole]
        facts = np.zeros((len(cut), 4), np.int64)
        np.add.at(facts, doc, w.facts[numbers])
        self.facts.append(facts)
        at, pairs, often = w.links(numbers)
        key, place = np.unique(pairs << 17 | (first + doc[at]), return_inverse=True)
        self.keys.append(key)
        self.often.append(np.bincount(place, often, len(key)).astype(np.int64))

    def rows(self, run: int):
        docs = {"ids": self.ids, "facts": np.concatenate(self.facts).tolist(), "shas": self.shas}
        yield -1, run, len(self.ids), zstandard.ZstdCompressor(level=1).compress(json.dumps(docs).encode()), None, None, None
        key = np.concatenate(self.keys or [np.empty(0, np.int64)])
        often = np.concatenate(self.often or [np.empty(0, np.int64)])
        radix = radix_of((key >> 17) // self.words.v.n_b, self.radix)
        order = np.lexsort((key, radix))
        key, often, radix = key[order], often[order], radix[order]
        part, first = np.unique(radix, return_index=True)
        for r, a, b in zip(part.tolist(), first.tolist(), [*first[1:].tolist(), len(key)]):
            pairs, counts = np.unique(key[a:b] >> 17, return_counts=True)
            yield (r, run, len(self.ids), _press_sorted(pairs), _press(counts),
                   _press((key[a:b] & 0x1FFFF).astype(np.uint32)), _press(often[a:b].astype(np.uint32)))


def _spill(a_file: str, b_file: str, radix: int, run_bytes: int):
    def run(batches):
        held = _Run(Words(vocabularies(a_file, b_file)), radix)
        rows, number = Rows(_RUNS), TaskContext.get().partitionId() << 32
        for batch in batches:
            for ids, bodies in _chunks(batch):
                held.add(ids, bodies)
                if held.bytes >= run_bytes or len(held.ids) >= RUN_DOCS:
                    for row in held.rows(number):
                        yield from rows.add(*row)
                    number += 1
                    held.clear()
        if held.ids:
            for row in held.rows(number):
                yield from rows.add(*row)
        yield from rows.rest()

    return run


def _chunks(batch: pa.RecordBatch):
    """Ids and texts of a batch, up to CHUNK_BYTES of text and CHUNK_DOCS texts at a time."""
    ids, bodies, size = [], [], 0
    for doc, body in zip(batch.column(0).to_pylist(), batch.column(1)):
        ids.append(doc)
        bodies.append(body.as_py())
        size += len(bodies[-1] or b"")
        if size >= CHUNK_BYTES or len(ids) >= CHUNK_DOCS:
            yield ids, bodies
            ids, bodies, size = [], [], 0
    if ids:
        yield ids, bodies


def merged(runs: list[list[tuple[bytes, bytes]]]):
    """Sorted (pairs, counts) blocks of several runs as one: pairs of several runs once, counts added.

    A run is a list of blocks in order. One block of each run is open; the heap knows where each open block
    ends, and everything up to the nearest end is complete.
    """
    heap: list[tuple[int, int]] = []
    left = [iter(r) for r in runs]
    held: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def advance(i: int) -> None:
        if (block := next(left[i], None)) is not None:
            held[i] = _open_sorted(block[0]), _open(block[1])
            heapq.heappush(heap, (int(held[i][0][-1]), i))

    for i in range(len(runs)):
        advance(i)
    while heap:
        end = heap[0][0]
        taken = []
        while heap and heap[0][0] == end:
            _, i = heapq.heappop(heap)
            taken.append(held.pop(i))
            advance(i)
        for i, (pairs, counts) in list(held.items()):
            if (n := int(np.searchsorted(pairs, end, "right"))):  # never the whole block: it ends later
                taken.append((pairs[:n], counts[:n]))
                held[i] = pairs[n:], counts[n:]
        pairs, at = np.unique(np.concatenate([t[0] for t in taken]), return_inverse=True)
        counts = np.zeros(len(pairs), np.int64)
        np.add.at(counts, at, np.concatenate([t[1] for t in taken]))
        yield pairs, counts


def _with_best(blocks, n_b: int):
    """Add whether a pair has its A id's greatest count. Blocks are cut between A ids: the last one is held back."""
    pairs = counts = np.empty(0, np.int64)

    def marked(pairs, counts):
        ids, at = np.unique(pairs // n_b, return_inverse=True)
        best = np.zeros(len(ids), np.int64)
        np.maximum.at(best, at, counts)
        return pairs, counts << 1 | (counts == best[at])

    for more in blocks:
        pairs, counts = np.concatenate([pairs, more[0]]), np.concatenate([counts, more[1]])
        done = int(np.searchsorted(pairs, pairs[-1] // n_b * n_b))
        if done:
            yield marked(pairs[:done], counts[:done])
            pairs, counts = pairs[done:], counts[done:]
    if len(pairs):
        yield marked(pairs, counts)


#: Merged runs: blocks of pairs with 64-bit counts, in order of `block`.
HEADS = "radix int, run long, block int, pairs binary, counts binary"
_HEADS = pa.schema([("radix", pa.int32()), ("run", pa.int64()), ("block", pa.int32()), ("pairs", pa.binary()), ("counts", pa.binary())])


def _groups(batches, keys: tuple[str, ...]):
    """Rows of a sorted partition, in lists of equal keys."""
    held, key = [], None
    for batch in batches:
        for row in batch.to_pylist():
            if (own := tuple(row[k] for k in keys)) != key:
                if held:
                    yield key, held
                held, key = [], own
            held.append(row)
    if held:
        yield key, held


def _merge(n_b: int, last: bool):
    def run(batches):
        rows = Rows(_HEADS)
        for (radix, group), found in _groups(batches, ("radix", "group")):
            runs: dict[int, list] = {}
            for row in found:
                runs.setdefault(row["run"], []).append((row["pairs"], row["counts"]))
            blocks = merged(list(runs.values()))
            number = 0
            for pairs, counts in _with_best(blocks, n_b) if last else blocks:
                for a in range(0, len(pairs), BLOCK_PAIRS):
                    s = slice(a, a + BLOCK_PAIRS)
                    yield from rows.add(radix, group, number, _press_sorted(pairs[s]), _press(counts[s]))
                    number += 1
        yield from rows.rest()

    return run


def _totals(runs: DataFrame, n_runs: int, n_b: int, fan_in: int) -> DataFrame:
    """Count of every pair, doubled, plus one if it is the A id's greatest: blocks by radix."""
    heads = runs.filter("radix >= 0").select("radix", "run", F.lit(0).alias("block"), "pairs", "counts")
    while True:
        groups = math.ceil(n_runs / fan_in)
        group = F.pmod(F.xxhash64("run", F.lit(groups)), F.lit(groups))
        dealt = heads.withColumn("group", group).repartition("radix", "group").sortWithinPartitions("radix", "group", "run", "block")
        heads = written(dealt.mapInArrow(_merge(n_b, groups <= 1), HEADS))
        if groups <= 1:
            return heads
        n_runs = groups


_BACK = pa.schema([("run", pa.int64()), ("size", pa.int32()), ("docs", pa.binary()), ("best", pa.binary()), ("total", pa.binary())])
BACK = "run long, size int, docs binary, best binary, total binary"


def _contribute(batches):
    """Rows of a (radix, group): the blocks of its counts, then the runs; what each run's records give its documents."""
    rows = Rows(_BACK)
    key, blocks, pairs, counts = None, [], None, None
    for batch in batches:
        for row in batch.to_pylist():
            if (row["radix"], row["group"]) != key:
                key, blocks, pairs = (row["radix"], row["group"]), [], None
            if row["kind"] == 0:
                blocks.append((_open_sorted(row["pairs"]), _open(row["counts"])))
                continue
            if pairs is None:
                pairs, counts = (np.concatenate(x) for x in zip(*blocks))
                blocks = []
            own, n = _open_sorted(row["pairs"]), _open(row["counts"])
            found = np.repeat(counts[np.searchsorted(pairs, own)], n)
            docs, often = _open(row["docs"], np.uint32), _open(row["often"], np.uint32).astype(np.int64)
            best, total = np.zeros(row["size"], np.int64), np.zeros(row["size"], np.int64)
            np.add.at(best, docs, often * (found & 1))
            np.add.at(total, docs, often * (found >> 1))
            met = np.flatnonzero(total)
            yield from rows.add(row["run"], row["size"], _press_sorted(met), _press(best[met]), _press(total[met]))
    yield from rows.rest()


_OUT = pa.schema([("doc_id", pa.int64()), *((n, pa.int64()) for n in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")), ("groups_sha256", pa.string())])
OUT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _documents(batches):
    """Rows of a run: its contributions, and its documents."""
    for _, rows in _groups(batches, ("run",)):
        size = rows[0]["size"]
        best, total, docs = np.zeros(size, np.int64), np.zeros(size, np.int64), None
        for row in rows:
            if row["best"] is None:
                docs = json.loads(zstandard.ZstdDecompressor().decompress(row["docs"]))
                continue
            at = _open_sorted(row["docs"])
            best[at] += _open(row["best"])
            total[at] += _open(row["total"])
        facts = np.array(docs["facts"], np.int64).reshape(-1, 4)
        ids = np.array(docs["ids"], np.int64)
        columns = [pa.array(ids, mask=ids == NULL_ID), *(pa.array(facts[:, i]) for i in range(4)), pa.array(best), pa.array(total), pa.array(docs["shas"], pa.string())]
        yield pa.RecordBatch.from_arrays(columns, schema=_OUT)


def align(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, a_file: str = A_FILE, b_file: str = B_FILE,
          radix: int = RADIX, run_bytes: int = RUN_BYTES, fan_in: int = FAN_IN, runs_a_task: int = RUNS_A_TASK) -> DataFrame:
    """Per document: `doc_id`, `n_a`, `n_b`, `n_groups`, `n_links`, `n_best`, `count_sum`, `groups_sha256`.

    A encodes a space and the text, B the text, to which it adds the space itself; strings of special tokens
    are plain text. NULL and empty texts, and texts that either tokenizer does not give back byte by byte
    (U+2581 in the text, bytes that are not UTF-8), have no tokens: zeros and an empty string. A link counts
    once per occurrence, a pair's count its documents. Repeated rows are documents of their own, a NULL id
    stays NULL. Both files must be readable on every executor under the same path. Columns besides the two
    do not matter.
    """
    n_b = vocabularies(a_file, b_file).n_b
    own = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("binary").alias("body"))
    runs = written(own.mapInArrow(tidy(_spill(a_file, b_file, radix, run_bytes)), RUNS))
    n_runs = runs.filter("radix = -1").count()
    if not n_runs:
        return docs.sparkSession.createDataFrame([], OUT)
    totals = _totals(runs, n_runs, n_b, fan_in)
    groups = math.ceil(n_runs / runs_a_task)
    group = F.pmod(F.xxhash64("run"), F.lit(groups))
    asked = runs.filter("radix >= 0").select("radix", group.alias("group"), F.lit(1).alias("kind"), F.col("run").alias("at"), "run", "size", "pairs", "counts", "docs", "often")
    known = totals.select(
        "radix", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))).alias("group"), F.lit(0).alias("kind"), F.col("block").cast("long").alias("at"),
        F.lit(None).cast("long").alias("run"), F.lit(None).cast("int").alias("size"), "pairs", "counts",
        F.lit(None).cast("binary").alias("docs"), F.lit(None).cast("binary").alias("often"))
    met = known.unionByName(asked).repartition("radix", "group").sortWithinPartitions("radix", "group", "kind", "at")
    back = met.mapInArrow(_contribute, BACK)
    none = F.lit(None).cast("binary")
    facts = runs.filter("radix = -1").select("run", "size", F.col("pairs").alias("docs"), none.alias("best"), none.alias("total"))
    return back.unionByName(facts).repartition("run").sortWithinPartitions("run").mapInArrow(_documents, OUT)


def op12_token_alignment(spark: SparkSession, sf: str) -> DataFrame:
    return align(spark.read.parquet(f"{sf}/documents.parquet"))
