"""Repeated lines, strings and passages against brute force."""

from collections import Counter

import numpy as np
import pytest

import brute
from crawlfold.llm import exchange, line_dedup, perfect_hash, phrase_dedup, radix_dedup

NULL = exchange.NULL_ID


def _lines(found):
    return Counter((NULL if r["doc_id"] is None else r["doc_id"], r["__n_lines"], r["__n_dropped"],
                    brute.sha((r["__text"] or "").encode())) for r in found.collect())


def _spans(found, *names):
    return Counter((NULL if r["id"] is None else r["id"], *(r[n] for n in names), brute.sha(bytes(r["kept"]))) for r in found.collect())


def test_lines_of_odd_rows(odd, odd_rows, none):
    found = line_dedup.dedup_lines(odd)
    assert _lines(found) == brute.lines(odd_rows)
    assert set(odd.columns) - {"text"} < set(found.columns)
    assert [r["__text"] for r in found.filter("doc_id = 1").collect()] == [None]
    assert line_dedup.dedup_lines(none).count() == 0


def test_lines_of_the_table(spark, sf, table):
    got = Counter(tuple(r) for r in line_dedup.op9_line_dedup(spark, sf).collect())
    assert got == brute.lines(table)


def test_strings(spark, sf, table, odd, odd_rows, none):
    names = ("n_bytes", "n_removed", "n_spans")
    assert _spans(radix_dedup.remove_repeats(odd), *names) == brute.strings(odd_rows)
    assert Counter(tuple(r) for r in radix_dedup.op4_radix_dedup(spark, sf).collect()) == brute.strings(table)
    assert radix_dedup.remove_repeats(none).count() == 0


def test_strings_of_another_depth(odd, odd_rows):
    found = radix_dedup.remove_repeats(odd, depth=37, gram=11, bytes_per_shard=1000)
    assert _spans(found, "n_bytes", "n_removed", "n_spans") == brute.strings(odd_rows, 37)


def test_passages(spark, sf, table, odd, odd_rows, none):
    assert _spans(phrase_dedup.remove_passages(odd), "n_words", "n_removed") == brute.passages(odd_rows)
    assert Counter(tuple(r) for r in phrase_dedup.op5_phrase_dedup(spark, sf).collect()) == brute.passages(table)
    assert phrase_dedup.remove_passages(none).count() == 0


def test_passages_of_another_length(odd, odd_rows):
    found = phrase_dedup.remove_passages(odd, window=7, phrase=3)
    assert _spans(found, "n_words", "n_removed") == brute.passages(odd_rows, 7)


def test_order_of_windows_decides(spark):
    """The later document may hold the passage first in the table; the smaller id keeps it."""
    text = " ".join(f"t{i}" for i in range(40))
    docs = spark.createDataFrame([(9, text), (3, "in front " + text), (5, text + " behind")], "doc_id long, text string")
    found = {r["id"]: r["n_removed"] for r in phrase_dedup.remove_passages(docs).collect()}
    assert found == {3: 0, 5: 40, 9: 40}


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 50_000])
def test_perfect_hash(n):
    keys = np.unique(np.random.default_rng(n).integers(0, 2**63, n).astype(np.uint64))
    packed = perfect_hash.build(keys)
    assert sorted(perfect_hash.probe(packed, keys).tolist()) == list(range(len(keys)))
    assert len(packed) < 64 + 0.6 * max(len(keys), 200)


def test_lines_that_share_half_a_hash(spark, monkeypatch):
    """Two lines whose upper hash halves are equal are told apart by the lower ones."""
    import pyarrow as pa

    high = np.array([5, 5, 9], np.uint64)
    low = np.array([1, 2, 3], np.uint64)
    asked = pa.table({"part": pa.array([0], pa.int32()), exchange.SHARD: [1], "high": [high.tobytes()], "low": [low.tobytes()],
                      "first": [np.array([4, 7, 8], np.int64).tobytes()], "docs": [np.array([2, 1, 2], np.int64).tobytes()]})
    told = line_dedup._answers(2)(asked, line_dedup._index(asked)).to_pylist()
    assert [(np.frombuffer(r["high"], np.uint64).tolist(), np.frombuffer(r["low"], np.uint64).tolist(),
             np.frombuffer(r["first"], np.int64).tolist()) for r in told] == [([5, 9], [1, 3], [4, 8])]


def test_equal_first_digits_are_split_by_later_ones():
    groups, stay = radix_dedup.split(np.array([0, 0, 0, 1, 1]), np.array([7, 7, 8, 7, 7], np.uint64))
    assert stay.tolist() == [True, True, False, True, True]
    assert groups[0] == groups[1] != groups[3] == groups[4]
