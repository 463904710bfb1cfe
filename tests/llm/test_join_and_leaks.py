"""Linked documents and benchmark passages against brute force."""

import random
from collections import Counter

import numpy as np
import pytest

import brute
from compare import connect, difference
from crawlfold.llm import decontaminate, jaccard_join
from crawlfold.llm.exchange import NULL_ID, SHARD, tidy


def _components(found):
    fix = lambda x: NULL_ID if x is None else x
    return Counter((fix(r["id"]), r["n"], fix(r["component"])) for r in found.collect())


def test_odd_rows(odd, odd_rows, none):
    assert _components(jaccard_join.near_duplicates(odd)) == brute.components(odd_rows)
    assert jaccard_join.near_duplicates(none).count() == 0


def test_table(spark, sf, table):
    assert Counter(tuple(r) for r in jaccard_join.op10_jaccard_join(spark, sf).collect()) == brute.components(table)


@pytest.mark.parametrize("seed", [1, 2])
def test_chains_of_copies_and_shared_passages(spark, seed, monkeypatch):
    """Copies of copies drift apart, and passages go through unrelated texts."""
    monkeypatch.setattr(jaccard_join, "BLOCK", 4)
    monkeypatch.setattr(jaccard_join, "GROUP", 3)
    rng = random.Random(seed)
    passage = [f"p{i}" for i in range(30)]
    rows, docs = [], []
    for family in range(6):
        w = [f"f{family}x{rng.randrange(1000)}" for _ in range(60)]
        for _ in range(12):
            w = list(w)
            for _ in range(rng.randrange(3)):
                w[rng.randrange(len(w))] = f"n{rng.randrange(10**6)}"
            docs.append(w + (passage if rng.random() < 0.5 else []))
    for i in range(25):
        docs.append(passage + [f"u{i}y{j}" for j in range(rng.randrange(12))])
    rng.shuffle(docs)
    rows = [(i, " ".join(w)) for i, w in enumerate(docs)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert _components(jaccard_join.near_duplicates(frame)) == brute.components(rows)


def test_a_large_family_leaves_few_pairs(spark, monkeypatch):
    """Copies with one to four changed words: all are linked to the text they come from, which is the hub of their lists."""
    rng, left = random.Random(5), []
    base = [f"w{i}" for i in range(150)]
    rows = [(500, " ".join(base))]
    for i in range(300):
        w = list(base)
        for at in rng.sample(range(150), rng.randint(1, 4)):
            w[at] = f"n{i}x{at}"
        rows.append((i, " ".join(w)))
    plain = jaccard_join._left_over

    def counted(*args):
        pairs = plain(*args)
        left.append(pairs.count())
        return pairs

    monkeypatch.setattr(jaccard_join, "_left_over", counted)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert _components(jaccard_join.near_duplicates(frame)) == brute.components(rows)
    assert left[0] <= len(rows)


def test_counts_of_a_shard_are_a_row_per_range(spark):
    """However far the sets of a shard are scattered."""
    rows = [(0, i, i % 2, jaccard_join._pack(np.arange(i, i + 50, dtype=np.uint64) << np.uint64(56))) for i in range(60)]
    sets = spark.createDataFrame(rows, f"{SHARD} long, rep long, comp long, set binary").repartition(20)
    counts = sets.groupBy(SHARD).applyInArrow(tidy(jaccard_join._count(4)), jaccard_join.COUNT)
    assert counts.count() <= 4


def test_a_short_set_is_its_whole_sequence(spark):
    rows = [(1, "a b c"), (2, "A  b c"), (3, "a b c d"), (4, "a b c d e"), (5, ""), (6, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert _components(jaccard_join.near_duplicates(frame)) == Counter({(1, 1, 1): 1, (2, 1, 1): 1, (3, 1, 3): 1, (4, 1, 4): 1, (5, 0, 5): 1, (6, 0, 6): 1})


def _copies(name, n=40):
    w = [f"{name}{i}" for i in range(n)]
    return " ".join(w), " ".join([*w[:-1], "other"])


def test_different_texts_under_one_id(spark):
    """Ids that stand for several texts, in one shard and in several, and texts without an id."""
    (a, a2), (b, b2), (c, c2), (d, d2), (e, e2) = (_copies(x) for x in "abcde")
    rows = [(5, a), (5, b), (2, a2), (3, b2), (1, c), (1, d), (8, c2), (9, d2), (None, e), (None, f"{e} {a2}"), (11, e2), (12, f"{e} {a2} z"),
            (5, ""), (13, "none of them"), (13, c)]
    for n in (1, 4):
        frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(n)
        assert _components(jaccard_join.near_duplicates(frame)) == brute.components(rows)


def test_equal_rows_in_two_files(spark, tmp_path):
    (a, a2), (b, _) = _copies("a"), _copies("b")
    for own in ([(1, a), (2, a2), (4, b)], [(1, a), (2, a2), (3, a), (4, b)]):
        spark.createDataFrame(own, "doc_id long, text string").coalesce(1).write.mode("append").parquet(str(tmp_path / "docs"))
    rows = [(1, a), (2, a2), (4, b)] * 2 + [(3, a)]
    assert _components(jaccard_join.near_duplicates(spark.read.parquet(str(tmp_path / "docs")))) == brute.components(rows)


@pytest.mark.parametrize("seed", [1, 2])
def test_all_links_between_texts(spark, seed, monkeypatch):
    """Links inside families too: copies of one text and copies of copies, equal texts once."""
    monkeypatch.setattr(jaccard_join, "BLOCK", 4)
    rng = random.Random(seed)
    docs = []
    for family in range(4):
        first = w = [f"f{family}x{i}" for i in range(150)]
        for i in range(14):
            w = list(w if i % 2 else first)
            for _ in range(rng.randrange(3)):
                w[rng.randrange(len(w))] = f"n{rng.randrange(10**6)}"
            docs.append(" ".join(w))
    docs += docs[:5]
    rows = list(enumerate(docs))
    sets, want = {}, set()
    for i, text in rows:
        w = text.split()
        sets.setdefault(frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4)), i)
    for a, i in sets.items():
        want |= {(i, j) for b, j in sets.items() if i < j and 100 * len(a & b) >= 75 * len(a | b)}
    links, members = jaccard_join.near_links(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    found = links.collect()
    assert Counter((min(r["x_id"], r["y_id"]), max(r["x_id"], r["y_id"])) for r in found) == Counter(want)
    assert any(r["inter"] is None for r in found) and len({r["key"] for r in members.collect()}) == len(sets)


def test_leaks_of_the_table(spark, sf):
    assert difference(spark, connect(sf), sf, decontaminate.op3_decontaminate, decontaminate.SQL) is None


ITEMS = [(1, "Who wrote the quick brown fox jumps over the lazy dog? Nobody knows."), (2, "two words"), (2, "two words"),
         (3, None), (4, " ?! "), (None, "é中 ÀB 12-34")]
TEXTS = [(1, None, "x"), (2, "", "x"), (3, "Two, WORDS: two words", "x"), (4, "é中 Àb 12/34 é中 ÀB", "x"),
         (5, "wrote; the QUICK brown-fox jumps over the lazy dog and so on", "x"), (5, "wrote the quick", "x"), (6, "words two", "x")]


@pytest.mark.parametrize("slice_bytes", [1 << 20, 80])
def test_leaks_of_odd_rows(spark, slice_bytes):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string, item_id string")
    found = decontaminate.find(docs, items, slice_bytes=slice_bytes).collect()
    want = Counter()
    for d, t, x in TEXTS:
        n, hit, who = brute.hits(t, [("null" if i is None else str(i), v) for i, v in ITEMS])
        want[d, n, hit, tuple(who)] += 1
    assert Counter((r["doc_id"], r["__n_words"], r["__n_hit"], tuple(r["__items"])) for r in found) == want
    row = next(r for r in found if r["doc_id"] == 4)
    assert [row["text"][s["start"]:s["end"]] for s in row["__spans"]] == ["é中 Àb 12/34"]


def test_nothing_to_find(spark, none):
    items = spark.createDataFrame([], "item_id long, text string")
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string, item_id string")
    assert decontaminate.drop_contaminated(docs, items).count() == len(TEXTS)
    assert decontaminate.find(none, spark.createDataFrame(ITEMS, "item_id long, text string")).count() == 0
