"""Quality rules, scores, main text, shards and sampled segmentations."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from crawlfold.llm import context_tree, hilbert_shards, main_text, quality_rules, sentencepiece_sampling as sp
from crawlfold.llm.exchange import NULL_ID


# Quality rules

def _counts(text):
    t = text or ""
    n, again = brute.repeats(t)
    with_word = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (n, len(re.sub(r"[\x20\x09-\x0D]", "", t)), sum(c in "#*$%&|<>" for c in t), len(with_word) - len(set(with_word)), again,
            n < 20 or 100 * again > 30 * n)


NAMES = ("__n_words", "__word_chars", "__n_symbols", "__n_dup_lines", "__n_repeat_words", "__base_failed")


def test_base_rules(spark, sf, table, odd, odd_rows, none):
    found = quality_rules.judge(quality_rules.count(odd), {}).collect()
    assert Counter((r["doc_id"], *(r[n] for n in NAMES)) for r in found) == Counter((d, *_counts(t)) for d, t in odd_rows)
    got = Counter(tuple(r)[:-1] for r in quality_rules.op6_quality_rules(spark, sf).collect())
    assert got == Counter((d, *_counts(t)) for d, t in table)
    assert quality_rules.keep_good(none).count() == 0


def test_verdict(spark, sf):
    """Of labelled documents that pass the base rules, junk goes and clean ones stay."""
    judged = quality_rules.op6_quality_rules(spark, sf.replace("0.001", "0.01")).filter("not base_failed")
    labels = spark.read.parquet(f"{sf.replace('0.001', '0.01')}/labels.parquet")
    n = {(r["quality"], r["kept"]): r["count"] for r in judged.join(labels, "doc_id").groupBy("quality", "kept").count().collect()}
    assert n[1, True] >= 0.98 * (n[1, True] + n.get((1, False), 0))
    assert n[0, False] >= 0.9 * (n[0, False] + n.get((0, True), 0))


def test_distance(spark):
    df = spark.createDataFrame([([1.0, 0.0], [0.0, 1.0]), ([3.0, 1.0], [0.75, 0.25]), ([0.0, 0.0], [0.5, 0.5])], "a array<double>, b array<double>")
    got = [r[0] for r in df.select(quality_rules.distance(df.a, df.b)).collect()]
    assert got[0] == pytest.approx(1.0) and got[1] == pytest.approx(0.0, abs=1e-7) and got[2] is None


def test_an_unknown_language_is_not_judged(spark):
    text = " ".join(f"|{i}|" for i in range(300))
    docs = spark.createDataFrame([(1, text, "xx"), (2, text, None)], "doc_id long, text string, lang string")
    assert quality_rules.keep_good(docs).count() == 2


@pytest.mark.parametrize("langs", [("it",), ("EN", "en-US", "en_GB"), (None, "xx"), ("",)])
def test_every_language_is_judged(spark, langs):
    """Clean texts stay and junk of many words goes, whatever the language code."""
    own = [f"parola{chr(97 + i)}" for i in range(20)] if langs == ("it",) else [*quality_rules.COMMON["en"], "some", "other", "plain", "words"]

    def clean(i):
        rng = random.Random(i)
        return " ".join(rng.choice(own) + (f", word{chr(97 + j % 26)}" if j % 9 == 0 else "") for j in range(120))

    rows = [(i, clean(i), "en" if langs[0] in (None, "") and i else langs[i % len(langs)]) for i in range(150)]
    rows += [(1000 + i, " ".join(f"|{j}#" for j in range(i, i + 120)), langs[i % len(langs)]) for i in range(6)]
    rows += [(2000, "中文。" * 20 + " ".join(chr(0x4e00 + j) * 9 for j in range(60)), None)]
    kept = {r["doc_id"] for r in quality_rules.keep_good(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert not [i for i in kept if 1000 <= i < 2000] and 2000 in kept and len(kept) >= 140


def test_common_words_are_counted(spark):
    words = [f"parola{chr(97 + i)}" for i in range(15)]
    rows = [(" ".join(w.capitalize() for w in words) + f" rara{chr(97 + i % 26)} 12", "IT-it") for i in range(120)] + [("the", "en")]
    found = quality_rules.common_words(spark.createDataFrame(rows, "text string, lang string"))
    assert set(found["it"]) == set(words) and found["en"] == quality_rules.COMMON["en"]


# Scores

def test_score_against_single_nodes(spark):
    rows = [(i, t) for i, t in enumerate(["the cat sat on the mat", "The cat  ate\tthe rat", "", "the bat", "zebra é"])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    got = {r["id"]: r for r in context_tree.score(docs, in_training=docs.doc_id < 3).collect()}
    stream = {d: b" ".join(t.encode().lower().split()) + b"\n" for d, t in rows}
    train = [stream[d] for d in (0, 1, 2)]
    for d, s in stream.items():
        assert got[d]["score"] == pytest.approx(brute.tree_log10(train, s, context_tree.DEPTH), rel=1e-6)
    c = Counter(w for s in train for w in [*s.split(), b"\n"])
    n, v = sum(c.values()), len(c)
    for d, s in stream.items():
        tokens = [*s.split(), b"\n"]
        base = sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens)
        assert (got[d]["n_tokens"], got[d]["n_known"], got[d]["train_tokens"]) == (len(tokens), sum(c[w] > 0 for w in tokens), n)
        assert got[d]["base_score"] == pytest.approx(base, rel=1e-9)


def test_scores_of_odd_rows(spark, odd, odd_rows, none):
    found = context_tree.score(odd).collect()
    assert Counter(r["id"] for r in found) == Counter(d for d, _ in odd_rows)
    assert len({(r["id"], r["score"]) for r in found}) == len({d for d, _ in odd_rows})
    assert context_tree.score(none).count() == 0
    import pyspark.sql.functions as F
    blind = context_tree.score(odd, in_training=F.lit(False)).filter("id = 4").first()  # "short" and an end
    assert blind["score"] == pytest.approx(8 * 6 * math.log10(0.5)) and blind["n_known"] == 0 and blind["train_tokens"] == 0


def test_held_out_texts(spark, sf):
    """The mixed contexts beat single bytes by far on texts that were not learned from."""
    rows = [r for r in context_tree.op7_context_tree(spark, sf).collect() if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 10 == 0) for r in rows)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    sizes = {r["doc_id"]: len(" ".join(r["text"].split()).encode()) + 1 for r in docs.collect()}
    bits = -sum(r["score"] for r in rows) * math.log2(10) / sum(sizes[r["doc_id"]] for r in rows)
    assert bits < 3.2


# Main text

PAGE = ('<html><head><title>t</title><script>var a = "<p>x</p>";</script></head><body><header>site</header><nav><ul><li>menu</li></ul></nav>'
        '<div class="cookie-notice">we use cookies</div><div class="{c}"><h1>Head &amp; line</h1><p>One  two<br>three<p>Four &lt;b&gt;'
        '<!-- no --> <b>five</b></p><form><p>mail</p></form></div><div class="comments"><p>{long}</p></div><footer>foot</footer></body></html>')


def test_main_text(spark):
    rows = [(i, f"http://h.example/{i}", PAGE.format(c=f"story{i}", long="a very long comment " * 50)) for i in range(4)]
    rows += [(4, None, None), (5, "no url", ""), (6, "http://h.example/6", "<p>only a paragraph"), (6, "http://h.example/6", "<p>only a paragraph"),
             (7, "http://other.example/", "<main><div>a</div><div>b <i>c</i></div></main>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = main_text.extract(pages)
    got = Counter((r["page_id"], r["__main"]) for r in found.collect())
    story = "Head & line\nOne two three\nFour <b> five"
    assert got == Counter([*((i, story) for i in range(4)), (4, ""), (5, ""), (6, "only a paragraph"), (6, "only a paragraph"), (7, "a\nb c")])
    paths = {r["host"]: (r["path"], r["votes"]) for r in main_text.host_paths(pages).collect()}
    assert paths["h.example"] == ("/html/body/div.story", 4)
    assert main_text.extract(pages.filter("false")).count() == 0


def test_consensus_outvotes_a_page(spark):
    """One page's sidebar is longer than its article; the other pages of the host know better."""
    page = "<body><div class='main'><p>{}</p></div><div class='extra'><p>{}</p></div></body>"
    rows = [(i, "https://x.example/a", page.format("text " * 30, "more")) for i in range(5)] + [(9, "https://x.example/b", page.format("short", "long " * 90))]
    got = {r["page_id"]: r["__main"] for r in main_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[9] == "short"


@pytest.mark.parametrize("wrapper", [
    "article class='post comments-open'", "div class='page has-sidebar'", "main class='no-header'", "div id='social-policy'",
    "main class='widget'", "article class='comment'", "div class='page sidebar'", "div class='overlay' id='modal'"])
def test_a_mark_does_not_drop_the_article(spark, wrapper):
    name = wrapper.split()[0]
    page = f"<body><p>top</p><{wrapper}><h2>Head</h2><p>{'text ' * 40}end</p><div class='ad-1'>buy</div><p>tail</p></{name}></body>"
    rows = [(i, f"http://w.example/{i}", page) for i in range(2)]
    got = {r["__main"] for r in main_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {f"Head\n{'text ' * 40}end\ntail"}


def test_a_page_of_marks_alone_keeps_text():
    assert main_text.Page("<div class='widget'>one</div><div class='promo'>two</div>").blocks == [(1, "one"), (2, "two")]


@pytest.mark.parametrize("page, path", [
    ("<body><article><div class='wrap'><div class='a'>{a}</div><div class='b'>{b}</div></div></article><div class='x'>out</div></body>", "/body/article"),
    ("<body><main><div><div class='a'>{a}</div><div><div><div class='b'>{b}</div></div></div></div></main><div>out</div></body>", "/body/main"),
    ("<body><div class='content'><div class='lead'>{a}</div><div class='body'>{b}</div></div><div class='x'>out</div></body>", "/body/div.content"),
    ("<body><div class='content'><div class='lead'>{a}</div><div><div class='body'>{b}</div></div></div><div class='x'>out</div></body>", "/body/div.content"),
    ("<body><div class='wrap'><div class='content'><div>{a}</div><div>{b}</div></div></div><div>out</div></body>", "/body/div.wrap/div.content"),
])
def test_an_article_in_several_blocks_is_whole(spark, page, path):
    a, b = "lead " * 12 + "end", "body " * 150 + "end"
    rows = [(i, f"http://s.example/{i}", page.format(a=a, b=b)) for i in range(3)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r["__main"] for r in main_text.extract(frame).collect()} == {f"{a}\n{b}"}
    assert [(r["path"], r["votes"]) for r in main_text.host_paths(frame).collect()] == [(path, 3)]


def test_a_list_of_links_is_not_the_best():
    links = "".join(f"<div class='l'><a href='/{i}'>a title of some words {i}</a></div>" for i in range(80))
    page = main_text.Page(f"<body><div class='list'>{links}</div><div class='story'><p>{'text ' * 60}</p></div></body>")
    assert page.paths[page.best()] == "/body/div.story"


@pytest.mark.parametrize("n_small", [1, 4])
def test_two_templates_of_a_host(spark, n_small):
    """Pages of the smaller template have an element at the other one's path too."""
    big = "<body><div><p>" + "story " * 40 + "end</p></div></body>"
    small = "<body><div>teaser</div><article>" + "long " * 60 + "end</article></body>"
    odd = "<body><div>teaser</div><section>" + "long " * 60 + "end</section></body>"
    rows = [(0, f"http://t.example/{i}", big) for i in range(9)] + [(1, f"http://t.example/s{i}", small) for i in range(n_small)]
    rows += [(2, "http://t.example/odd", odd)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {(r["page_id"], r["__main"]) for r in main_text.extract(frame).collect()}
    assert got == {(0, "story " * 40 + "end"), (1, "long " * 60 + "end"), (2, "long " * 60 + "end")}
    want = {"/body/div": (9, 10 + n_small), "/body/article": (n_small, n_small)}
    assert {r["path"]: (r["votes"], r["held"]) for r in main_text.host_paths(frame).collect()} == {k: v for k, v in want.items() if v[0] > 1}


def test_pages_without_a_host_do_not_vote_for_one_another(spark):
    rows = [(i, None, "<body><div class='a'>" + "text " * 30 + "</div><div class='b'>more</div></body>") for i in range(5)]
    rows += [(9, "no url", "<body><div class='a'>short</div><div class='b'>" + "long " * 60 + "end</div></body>")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["__main"] for r in main_text.extract(frame).collect()}
    assert got[9] == "long " * 60 + "end" and got[0] == ("text " * 30).strip()
    assert main_text.host_paths(frame).count() == 0


def own_text(source):
    page = main_text.Page(source)
    return page.text(None)


def test_quotes_open_values_after_an_equals_sign_only():
    assert own_text("<p>First</p><p data-x=it's>second</p><p>third</p>") == "First\nsecond\nthird"
    assert own_text("<p title=\"a > b's\" id='x>y'>one</p><p title=\"never closed>two</p><p>three</p>") == "one\ntwo\nthree"
    assert own_text("<div data-a='class=ad' class=\"x\"><p>kept</p></div>") == "kept"


def test_end_tags_may_be_left_out():
    cells = lambda n, end: "<table>" + "".join(f"<tr><td>cell {i} of the table{end}" for i in range(n)) + "</table>"
    for n in (100, 1000, 2000):
        assert own_text(cells(n, "")).split("\n") == [f"cell {i} of the table" for i in range(n)]
        assert own_text(cells(n, "")) == own_text(cells(n, "</td></tr>"))
    items = "<article><ul><li>a<li>b<ul><li>c</ul><li>d</ul><dl><dt>e<dd>f<dt>g</dl><table><thead><tr><th>h<th>i<tbody><tr><td>j<div>k</table><p>l<p>m</article>"
    assert own_text(items) == "\n".join("abcdefghijklm")
    assert len(main_text.Page(items).paths) == len(main_text.Page(items.replace("<li>d", "</li><li>d")).paths)


def test_deep_pages_take_memory_in_proportion():
    deep = "".join(f"<div class='c{'x' * (i % 7)}'>t{i} " for i in range(8000))
    page = main_text.Page(deep + "<p class='" + "y " * 5000 + "'>end")
    assert max(map(len, page.paths)) < 1000 and sum(map(len, page.paths)) < 8000 * 900
    assert len(page.blocks) == 8001 and len(set(page.paths)) == 8001
    assert page.paths == main_text.Page(deep).paths


def test_a_page_inside_a_form_and_a_header_inside_an_article():
    story = "<p>" + "text " * 60 + "</p>"
    assert own_text(f"<body><form action=x><div class=page><h1>Head</h1>{story}</div></form></body>").split()[:2] == ["Head", "text"]
    assert "Search" not in own_text(f"<body><form><label>Search</label><button>go</button></form><article>{story}</article></body>")
    got = own_text(f"<body><header>site name</header><article><header><h1>Head</h1><p>standfirst</p></header>{story}<footer>by</footer></article></body>")
    assert got.split("\n")[:2] == ["Head", "standfirst"] and "site" not in got and "by" not in got.split()


@pytest.mark.parametrize("mark", [
    "comments-section", "comment-list", "user-comments", "related-posts", "share-buttons", "social-links", "ad-slot", "cookie-bar",
    "newsletter-box", "ad-1", "site-notice",
])
def test_marks_with_neutral_words(mark):
    story = "<p>" + "text " * 60 + "</p>"
    assert own_text(f"<body><article>{story}<div class='x {mark}'>junk</div><p>end</p></article></body>") == ("text " * 60).strip() + "\nend"
    assert own_text(f"<body><div id='{mark}'>{story}</div></body>") == ("text " * 60).strip()  # nothing else is left


@pytest.mark.parametrize("name", ["comments-open", "has-sidebar", "no-header", "social-policy", "adele", "shared-history"])
def test_names_that_only_hold_a_mark(name):
    assert own_text(f"<body><article><p>one</p><div class='{name}'>two</div></article></body>") == "one\ntwo"


def test_a_very_long_page(spark):
    html = "<body><nav>menu</nav><main>" + "".join(f"<p>paragraph {i} of a long page<br>with a break</p>" for i in range(90_000)) + "</main></body>"
    assert len(html) > 4_500_000
    page, = main_text.extract(spark.createDataFrame([(1, "http://h/1", html)], "page_id long, url string, html string")).collect()
    assert page["__main"].split("\n") == [f"paragraph {i} of a long page with a break" for i in range(90_000)]


def test_pages_of_the_table(spark, sf):
    for r, p in zip(main_text.op8_main_text(spark, sf).orderBy("page_id").collect(), spark.read.parquet(f"{sf}/pages.parquet").orderBy("page_id").collect()):
        inner = p["html"].partition("<article>")[2].partition("</article>")[0]
        words = re.sub(r"<[^>]*>", " ", inner)
        import html
        assert html.unescape(words).split() == r["text"].split() and r["n_chars"] == len(r["text"])


# Shards

@pytest.mark.parametrize("dims,bits", [(2, 4), (3, 3), (4, 2)])
def test_the_curve_steps_from_cell_to_neighbour(dims, bits):
    """What makes it a Hilbert curve, without another copy of its formula: every cell once, each next to the one before."""
    import itertools

    cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)), np.int64).T
    index = hilbert_shards.curve_index(cells, bits)
    assert sorted(index.tolist()) == list(range(1 << (dims * bits)))
    path = cells[:, np.argsort(index)]
    assert (np.abs(np.diff(path, axis=1)).sum(axis=0) == 1).all()
    # Every aligned block of a power of two is a sub-cube: this is what lets files be skipped.
    for k in range(1, bits):
        block = path.reshape(dims, -1, 1 << (dims * k))
        assert (block.max(axis=2) - block.min(axis=2) == (1 << k) - 1).all()


def test_shards_are_runs_of_the_plain_order(spark, odd):
    """The rows sorted in Python by place on the curve, checksum and id, and cut into runs."""
    docs = odd.withColumns({"lang": F.expr("case when doc_id % 2 = 0 then 'en' when doc_id % 3 = 0 then 'de' end"),
                            "source": F.expr("concat('source_', doc_id % 4)")}).unionByName(odd)
    placed = [(r["__curve"], zlib.crc32((r["text"] or "").encode()), r["doc_id"]) for r in hilbert_shards.curve_order(docs).collect()]
    placed.sort(key=lambda r: (r[0], r[1], r[2] is not None, r[2] or 0))
    n, want = len(placed), []
    for shard in range(8):
        first, end = -(-shard * n // 8), -(-(shard + 1) * n // 8)
        want += [(placed[i][2], placed[i][1], shard, i - first) for i in range(first, end)]
    got = hilbert_shards.assign(docs).select("doc_id", "__crc", "__shard", "__slot").collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_shards(spark, sf, table, odd, none):
    rows = hilbert_shards.op2_hilbert_shards(spark, sf).collect()
    text = dict(table)
    assert all((r["size"], r["text_crc32"]) == (len(text[r["doc_id"]].encode()) + 1, zlib.crc32(text[r["doc_id"]].encode())) for r in rows)
    sizes = Counter(r["shard"] for r in rows)
    assert max(sizes.values()) - min(sizes.values()) <= 1 and set(sizes) == set(range(8))
    assert all(sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(n)) for s, n in sizes.items())
    few = hilbert_shards.assign(odd, shards=3).collect()
    assert sorted(Counter(r["__shard"] for r in few).values()) == [5, 5, 6] and hilbert_shards.assign(none).count() == 0
    assert hilbert_shards.assign(odd.limit(2), shards=8).count() == 2


@pytest.mark.parametrize("n,bits", [(1, 4), (2, 1), (2, 5), (3, 3), (4, 2)])
def test_the_curve_is_a_walk_through_all_cells(n, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * n, indexing="ij")).reshape(n, -1)
    place = hilbert_shards.curve_index(cells, bits)
    assert sorted(place.tolist()) == list(range((1 << bits) ** n))
    assert (np.abs(np.diff(cells[:, np.argsort(place)], axis=1)).sum(axis=0) == 1).all()


def test_strings_with_a_common_start_have_their_own_cells(spark):
    names = [f"https://www.a-long-common-start.example/crawl-2024-{i:03}" for i in range(64)]
    rows = [(i, "t", "en", names[i % 64], 7) for i in range(640)] + [(700, "t", None, None, 7), (701, "t", "en", "", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    at = hilbert_shards.curve_order(docs, ("source",)).collect()
    places = {r["source"]: r["__curve"] for r in at}
    assert len(at) == len(rows) and len(set(places.values())) >= 60 and min(places.values()) == places[None]
    assert [places[n] for n in names] == sorted(places[n] for n in names)


def test_files_are_skipped(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    manifest = hilbert_shards.write_shards(docs, str(tmp_path / "out"))
    assert manifest.agg({"rows": "sum"}).first()[0] == docs.count()
    near = manifest.filter("max_n_chars >= 4000").count()
    assert 0 < near < 8
    got = hilbert_shards.read_shards(spark, str(tmp_path / "out"), manifest, "n_chars", 4000, 10**9)
    assert got.count() == docs.filter("n_chars >= 4000").count()


# Segmentations

@pytest.fixture(scope="module")
def sampler():
    with open(sp.MODEL, "rb") as f:
        return sp.Sampler(sp.Lattices(sp.Vocabulary.read(f.read(), 0.2)), 5)


def _all(v, text):
    out = []

    def walk(i, ids, w):
        if i == len(text):
            out.append((tuple(ids), w))
            return
        for j in range(i + 1, min(len(text), i + 16) + 1):
            p = v.pieces.get(text[i:j])
            if p is not None:
                walk(j, [*ids, p], w + v.weights[p])
        if text[i] not in v.pieces:
            b = text[i].encode()
            walk(i + 1, [*ids, *(v.first_byte + x for x in b)], w + len(b) * v.weights[v.first_byte])

    walk(0, [], 0.0)
    z = math.log(sum(math.exp(w) for _, w in out))
    return {ids: w - z for ids, w in out}


def test_samples_follow_the_lattice(sampler):
    text, n = "the é𓀀 cat", 3000
    chance = _all(sampler.lattices.vocabulary, " " + text)
    drawn = {}
    for t, rank, ids, log_prob, perturbed, log_inclusion in sampler.draw(np.arange(n), [text] * n, 3):
        assert log_prob == pytest.approx(chance[tuple(ids.tolist())], abs=1e-9)
        drawn.setdefault(t, []).append((tuple(ids.tolist()), perturbed, log_prob - log_inclusion))
    assert all(len({x[0] for x in v}) == 3 and v[0][1] > v[1][1] > v[2][1] for v in drawn.values())
    a, b = sorted(chance, key=chance.get)[-2:]
    p, q = math.exp(chance[b]), math.exp(chance[a])
    firsts, pairs = Counter(v[0][0] for v in drawn.values()), Counter((v[0][0], v[1][0]) for v in drawn.values())
    assert firsts[b] / n == pytest.approx(p, abs=0.04)
    assert pairs[b, a] / n == pytest.approx(p * q / (1 - p), abs=0.04)  # without replacement
    # Weighted by inverse inclusion, samples stand for all segmentations.
    assert np.mean([sum(math.exp(x[2]) for x in v) for v in drawn.values()]) == pytest.approx(1, abs=0.05)


def test_few_segmentations_are_all_drawn(sampler):
    found = list(sampler.draw(np.array([1, 2, 3]), ["", "q", "\n"], 10))
    per = Counter(f[0] for f in found)
    assert per[0] == 1 and per[1] == len(_all(sampler.lattices.vocabulary, " q")) and per[2] == len(_all(sampler.lattices.vocabulary, " \n"))
    assert all(f[5] == pytest.approx(0, abs=1e-9) for f in found)


def test_odd_rows_come_back(odd, odd_rows, none):
    rows = sp.encode(odd, keep=("doc_id", "n")).collect()
    assert all(r["exact"] for r in rows)
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], Counter())[r["rank"], tuple(r["ids"]), r["log_inclusion"]] += 1
    assert set(by) == {d for d, _ in odd_rows}
    assert all(n == 2 for n in by[6].values())  # a repeated row draws the same
    assert list(by[1]) == [(1, (), 0.0)] == list(by[2])
    assert sp.encode(none).count() == 0


def test_decoding(spark, sf, table):
    encoded = sp.op1_sentencepiece_sampling(spark, sf)
    back = sp.decode(encoded.select("doc_id", "rank", "ids")).collect()
    text = dict(table)
    assert all(r["text"] == text[r["doc_id"]] for r in back)
    again = {(r["doc_id"], r["rank"]): r["ids"] for r in encoded.repartition(7).collect()}
    assert all(again[r["doc_id"], r["rank"]] == r["ids"] for r in back)


def test_pieces_decode_as_the_library_does(spark, sf):
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=sp.MODEL)
    for r in sp.op1_sentencepiece_sampling(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet"), "doc_id").limit(50).collect():
        assert lib.decode(r["ids"]) == r["text"]


def test_null_id_is_a_key(sampler):
    one, two = (list(sampler.draw(np.array([k]), ["some text here"], 2)) for k in (NULL_ID, 0))
    assert [f[3] for f in one] != [f[3] for f in two] or one[0][4] != two[0][4]


def test_words_used_most_stay(monkeypatch):
    """When words are forgotten, those used most keep their lattices, and later draws are those of a sampler that never forgets."""
    with open(sp.MODEL, "rb") as f:
        vocabulary = sp.Vocabulary.read(f.read())
    rng = random.Random(3)
    batches = [[" ".join(["the", "often", *(f"w{rng.randrange(10**6)}" for _ in range(30)), "often"]) for _ in range(5)] for _ in range(6)]
    monkeypatch.setattr(sp, "_MOST_EDGES", 10**9)
    plain = sp.Sampler(sp.Lattices(vocabulary), 1)
    whole = [[(t, r, i.tolist(), *x) for t, r, i, *x in plain.draw(np.arange(5), b, 2)] for b in batches]
    monkeypatch.setattr(sp, "_MOST_EDGES", 500)
    monkeypatch.setattr(sp, "_KEPT_EDGES", 100)
    small = sp.Sampler(sp.Lattices(vocabulary), 1)
    for b, expected in zip(batches, whole):
        assert [(t, r, i.tolist(), *x) for t, r, i, *x in small.draw(np.arange(5), b, 2)] == expected
    small.lattices.numbered([])
    assert " often" in small.lattices.number and len(small.lattices.number) < 50
    assert len(small.lattices.piece) <= 100


def test_noise_is_drawn_where_paths_part(sampler, monkeypatch):
    """Noise is drawn only for pieces that have others beside them."""
    walked, alone, drawn, walk, uniform = [], [], [], sp._walk, sp.uniform

    def counted(*a):
        found = walk(*a)
        walked.append(len(found[0]))
        alone.append(int(sampler.lattices.only[found[0]].sum()))
        return found

    monkeypatch.setattr(sp, "_walk", counted)
    monkeypatch.setattr(sp, "uniform", lambda key: (drawn.append(len(key)), uniform(key))[1])
    assert len(list(sampler.draw(np.arange(30), ["the quick brown fox jumps over the lazy dog " * 40] * 30, 2))) == 60
    assert sum(alone) > 1000
    assert sum(drawn) <= 2 * sum(walked) - sum(alone) + 8 * 30


def test_edges_are_small(sampler):
    """All that is kept of a word's edge, so that many words stay: before 38 bytes and the nodes."""
    lattices = sp.Lattices(sampler.lattices.vocabulary)
    rng = random.Random(5)
    lattices.numbered([["".join(rng.choice("aeiorstn") for _ in range(12)) for _ in range(500)]])
    n = len(lattices.piece)
    assert n > 10_000 and sum(x[:n].nbytes for name, x in lattices.room.items() if len(getattr(lattices, name)) == n) <= 25 * n


def test_letters_spelled_in_bytes(sampler):
    """Letters of one to four bytes without a piece, alone and in words, are spelled in a text's order."""
    text = "a\x01b \x02 ͸q͹ x \U0001f9ff\U000e0001 \n\x7f"
    vocabulary = sampler.lattices.vocabulary
    found = list(sampler.draw(np.array([4, 5]), [text, text], 3))
    assert {f[0] for f in found} == {0, 1} and all(vocabulary.decode(f[2].tolist()) == text.encode() for f in found)
    flat, ends = np.concatenate([f[2] for f in found]), np.cumsum([0, *(len(f[2]) for f in found)])
    assert vocabulary.gives_back(flat, ends, [text.encode()] * len(found)) == [True] * len(found)
    assert vocabulary.gives_back(flat, ends, [text.encode() + b"x"] * len(found)) == [False] * len(found)
