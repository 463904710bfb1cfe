"""Dimension scan, bisector clusters and token alignment against plain versions."""

import hashlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from crawlfold.llm import bisector_clusters as bc, dimension_scan as ds, token_alignment as ta

VECTORS = "vec_id long, embedding array<double>, list int, piece int, v string, h1 string, id string, cluster int, __llm_id int"
NAN, INF = float("nan"), float("inf")


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, "x", "y", "z", 3, 4) for i, v in rows], VECTORS).repartition(3)


def plain_nearest(rows, asks, k):
    usable = {(i, tuple(v)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    out = []
    for q, v in usable:
        if asks(q):
            near = sorted((-float((np.array(v) * np.array(w)).sum()), i) for i, w in usable if i != q and len(w) == len(v))
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(near[:k])]
    return sorted(out)


def found_nearest(df, asks, **args):
    return sorted(map(tuple, ds.nearest(df, asks, **args).select("query_id", "rank", "vec_id", "score").collect()))


def test_scan_handles_odd_vectors(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.standard_normal(5).round(1).tolist()) for i in range(40)]
    rows += [(None, [1.0] * 5), (50, None), (51, []), (52, [0.0] * 5), (53, [1.0, None, 1.0, 1.0, 1.0]), (54, [NAN] * 5), (55, [INF] + [1.0] * 4)]
    rows += [(60, [1e200] * 2), (61, [1e30, 0.0]), (62, [1e-30, 1e-30]), (63, [3.0, 4.0])]  # another length, far apart in size
    rows += [(100 + i, [1.0, 2.0, 3.0, 4.0, 5.0]) for i in range(60)]  # more copies than neighbours asked for
    rows += [(3, rows[3][1]), (3, rows[3][1]), (4, [9.0] * 5)]  # a repeated row, and two vectors under one id
    with np.errstate(over="ignore"):
        assert found_nearest(frame(spark, rows), F.col("vec_id") % 3 == 0, k=4) == plain_nearest(rows, lambda i: i % 3 == 0, 4)


def test_scan_of_nothing(spark):
    assert found_nearest(frame(spark, []), F.lit(True)) == []
    assert found_nearest(frame(spark, [(1, None)]), F.lit(True)) == []
    assert found_nearest(frame(spark, [(1, [1.0])]), F.lit(True)) == []


def test_scan_cut_lists_give_the_same(spark, monkeypatch):
    """Every list in pieces of at least 256 vectors, lists of all directions and lengths of vectors."""
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((6, 24))
    x = (centres[rng.integers(0, 6, 3000)] + rng.standard_normal((3000, 24)) * 0.4) * rng.uniform(0.5, 3, (3000, 1))
    rows = [(i, v) for i, v in enumerate(x.tolist())]
    monkeypatch.setattr(ds, "PIECE_BYTES", 1)
    monkeypatch.setattr(ds, "MOST_LISTS", 4)
    assert max(ds.Lists(x, 3000, 10).pieces) > 1
    got = found_nearest(frame(spark, rows), F.col("vec_id") % 100 == 0, k=10)
    want = plain_nearest(rows, lambda i: i % 100 == 0, 10)
    assert len(got) == len(want)
    assert len(set((q, i) for q, _, i, _ in got) & set((q, i) for q, _, i, _ in want)) >= 0.95 * len(want)


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.1"])
def test_scan_recall_on_the_table(spark, scale):
    sf = f"/root/testdata/{scale}"
    got = ds.op11_dimension_scan(spark, sf)
    assert dict(got.dtypes) == {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "double"}
    got = got.collect()
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], np.float64)
    near = defaultdict(dict)
    for r in got:
        near[r["query_id"]][r["rank"]] = (r["vec_id"], r["score"])
    assert sorted(near) == sorted(i for i in ids if i % 20 == 0)
    hits = 0
    for q, own in near.items():
        score = (x * x[ids == q]).sum(axis=1)
        assert sorted(own) == list(range(1, 21))
        assert [s for _, (_, s) in sorted(own.items())] == [score[ids == i][0] for _, (i, _) in sorted(own.items())]
        assert [s for _, (_, s) in sorted(own.items())] == sorted((s for _, s in own.values()), reverse=True)
        score[ids == q] = -np.inf
        hits += len({i for i, _ in own.values()} & set(ids[np.lexsort((ids, -score))[:20]].tolist()))
    assert hits >= 0.95 * 20 * len(near)


def plain_clusters(rows, k, rounds, dims=64):
    kept = [(i, [bc.whole(np.array([x]), 1024)[0].item() for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in order[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids)) for _, v in kept]

    for _ in range(rounds):
        own = assign()
        for c in range(len(centroids)):
            members = [v for (_, v), (_, n) in zip(kept, own) if n == c]
            if members:
                centroids[c] = [Fraction(sum(x), len(members)).__floor__() for x in zip(*members)]
    own, most = assign(), 2**63 - 1
    per = Counter()
    for d, n in own:
        per[n] += min(d, most)
    total = min(sum(per.values()), most)
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, n, min(d, most), min(per[n], most), total, sha[n]) for (i, _), (d, n) in zip(kept, own)), key=str)


def found_clusters(df, **args):
    return sorted(map(tuple, bc.clusters(df, **args).collect()), key=str)


def test_clusters_with_ties_and_odd_vectors(spark):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.integers(-2, 3, 4) / 1024).tolist()) for i in range(200)]  # few places: equal distances and empty centroids
    rows += rows[:20] + [(None, [0.0] * 4), (None, [0.1] * 4), (7, [0.5] * 4), (300, None), (301, []), (302, [1.0] * 5),
                         (303, [NAN] * 4), (304, [INF] * 4), (305, [None, 1.0, 1.0, 1.0])]
    assert found_clusters(frame(spark, rows), k=5, rounds=6, dims=4) == plain_clusters(rows, 5, 6, 4)


def test_clusters_beyond_doubles(spark):
    """Sums and distances that a double does not hold exactly, and some that a long does not hold."""
    rng = np.random.default_rng(4)
    rows = [(i, (rng.integers(-(2**20), 2**20, 3) * 2.0 ** int(rng.integers(-10, 30))).tolist()) for i in range(60)]
    rows += [(60, [1e300, -1e300, 0.0])]
    assert found_clusters(frame(spark, rows), k=4, rounds=4, dims=3) == plain_clusters(rows, 4, 4, 3)


def test_clusters_of_few_and_none(spark):
    assert found_clusters(frame(spark, [(1, [1.0])])) == []
    assert found_clusters(frame(spark, [])) == []
    rows = [(1, [0.5, 0.5]), (2, [0.25, 0.5])]
    assert found_clusters(frame(spark, rows), dims=2) == plain_clusters(rows, 8, 10, 2)


def test_bisectors_give_equal_distances_to_the_smaller_number():
    b = bc.Bisectors([[0, 0], [2, 0], [0, 2], [2, 2]])
    assert b.nearest(np.array([[1, 1], [1, 0], [2, 1], [1, 2], [3, 3]])).tolist() == [0, 0, 1, 2, 3]


def test_clusters_of_the_table(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()]
    assert sorted(map(tuple, bc.op13_bisector_clusters(spark, sf).collect()), key=str) == plain_clusters(rows, 8, 10)


# Alignment

def plain_align(rows):
    a_model = Tokenizer.from_file(ta.A_FILE)
    a_model.encode_special_tokens = True
    b_model = sentencepiece.SentencePieceProcessor(model_file=ta.B_FILE)
    letters = ta._byte_letters()
    docs, counts = [], Counter()
    for i, text in rows:
        groups = []
        if text:
            data = (" " + text).encode()
            a = [(t, len(a_model.id_to_token(t)), bytes(letters[c] for c in a_model.id_to_token(t))) for t in a_model.encode(" " + text, add_special_tokens=False).ids]
            b = [(t, bytes([int(p[3:-1], 16)]) if b_model.is_byte(t) else p.replace("▁", " ").encode()) for t in b_model.encode(text) for p in [b_model.id_to_piece(t)]]
            if b"".join(x[2] for x in a) == data == b"".join(x[1] for x in b):
                while a:  # take tokens from the side that is behind, until both stand at the same byte
                    group, at = ([], []), [0, 0]
                    while not group[0] or at[0] != at[1]:
                        s = int(at[1] < at[0])
                        token = (a, b)[s].pop(0)
                        group[s].append(token[0])
                        at[s] += len(token[-1])
                    groups.append(group)
        docs.append((i, groups))
        counts.update({(x, y) for g in groups for x in g[0] for y in g[1]})
    best = {}
    for (x, _), n in counts.items():
        best[x] = max(best.get(x, 0), n)
    out = []
    for i, groups in docs:
        links = [(x, y) for g in groups for x in g[0] for y in g[1]]
        written = ";".join(",".join(map(str, g[0])) + "|" + ",".join(map(str, g[1])) for g in groups)
        out.append((i, sum(len(g[0]) for g in groups), sum(len(g[1]) for g in groups), len(groups), len(links),
                    sum(counts[p] == best[p[0]] for p in links), sum(counts[p] for p in links),
                    hashlib.sha256(written.encode()).hexdigest() if groups else ""))
    return sorted(out, key=str)


STRANGE = [
    (100, "<|endoftext|> and <s> </s> <unk> <0x41> as text"), (101, "a text with ▁ in it"), (102, " two  spaces   three\tand a tab \n"),
    (103, "\n\nlines\n \n  more\n"), (104, "日本語のテキスト、中国話。한국어 텍스트 ﬁ é é 👩‍👩‍👧‍👦 🏳️‍🌈"), (105, "\x00\x01 \x1c\x85 \xa0x y​z"),
    (106, "it's we'll I'M don't 'tis 1234567 3.14 $%&"), (107, "x" * 5000 + "yz" * 3000), (108, "   "), (109, "\t"),
    (110, "same word same word same word"), (110, "same word same word same word"), (None, "same word"),
]


def found_align(df, **args):
    return sorted(map(tuple, ta.align(df, **args).collect()), key=str)


def test_alignment_of_odd_texts(spark, odd, odd_rows):
    rows = odd_rows + STRANGE
    more = spark.createDataFrame([("p", d, t, "en", "s", 1, 1, 1.0, "x", 5) for d, t in STRANGE], odd.schema)
    want = plain_align(rows)
    assert found_align(odd.unionByName(more).repartition(3)) == want
    # many runs, few radix parts, a merge in several rounds, several copies of the counts
    assert found_align(odd.unionByName(more).repartition(5), radix=3, run_bytes=200, fan_in=2, runs_a_task=2) == want


def test_alignment_forgets_words(spark, odd, odd_rows, monkeypatch):
    monkeypatch.setattr(ta, "KEPT_WORDS", 5)
    monkeypatch.setattr(ta, "CHUNK_DOCS", 2)
    held = ta._Run(ta.Words(ta.vocabularies(ta.A_FILE, ta.B_FILE)), 4)
    for i in range(0, len(odd_rows), 2):
        held.add(*map(list, zip(*[(d, t.encode() if t else None) for d, t in odd_rows[i : i + 2]])))
    facts = np.concatenate(held.facts)
    assert [(i, *f) for (i, _), f in zip(odd_rows, facts.tolist())] == [
        next(r[:5] for r in plain_align([row])) for row in odd_rows]


def test_alignment_of_bytes_that_are_no_text(spark):
    df = spark.sql("select 1L doc_id, decode(unhex('61ff62'), 'ISO-8859-1') good, cast(unhex('61ff62') as string) text")
    assert found_align(df) == [(1, 0, 0, 0, 0, 0, 0, "")]


def test_alignment_of_nothing(spark, none):
    assert found_align(none) == []


def test_alignment_of_the_table(spark, sf, table):
    assert sorted(map(tuple, ta.op12_token_alignment(spark, sf).collect()), key=str) == plain_align(table)


def test_merge_of_blocks_keeps_order_and_sums():
    rng = np.random.default_rng(5)
    want, runs = Counter(), []
    for _ in range(7):
        pairs = np.unique(rng.integers(0, 500, 200))
        counts = rng.integers(1, 9, len(pairs))
        want.update(dict(zip(pairs.tolist(), counts.tolist())))
        runs.append([(ta._press_sorted(pairs[a : a + 13]), ta._press(counts[a : a + 13])) for a in range(0, len(pairs), 13)])
    pairs, counts = (np.concatenate(x) for x in zip(*ta.merged(runs)))
    assert (np.diff(pairs) > 0).all() and dict(zip(pairs.tolist(), counts.tolist())) == want
    marked = list(ta._with_best(ta.merged(runs), 10))
    best = {p: c & 1 for p, c in zip(*(np.concatenate(x).tolist() for x in zip(*marked)))}
    assert best == {p: int(n == max(m for q, m in want.items() if q // 10 == p // 10)) for p, n in want.items()}
