"""The stages of the pipeline, each held against brute force on its own input."""

from pyspark.sql import functions as F

import __spark_entry__
import brute
import corpus_pipeline
from crawlfold.llm import quality_rules
from crawlfold.session import written


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    items = [(str(r["item_id"]), r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    for name, stage in corpus_pipeline.STAGES:
        before = [tuple(r) for r in docs.select("doc_id", "text").collect()]
        out = written(stage(spark, docs, sf))
        if name == "sentencepiece":
            assert {r["doc_id"] for r in out.collect()} == {d for d, _ in before} and all(r["exact"] for r in out.collect())
            break
        assert out.columns == columns
        after = {r["doc_id"]: r["text"] for r in out.collect()}
        if name == "quality_rules":
            kept = quality_rules.op6_quality_rules(spark, sf).filter("kept").collect()
            assert set(after) == {r["doc_id"] for r in kept}
        elif name == "line_dedup":
            want = {d: digest for d, _, _, digest in brute.lines(before)}
            assert {d: brute.sha(t.encode()) for d, t in after.items()} == want
            assert all(r["n_chars"] == len(r["text"]) for r in out.collect())
        elif name == "jaccard_join":
            assert set(after) == {d for d, _, c in brute.components(before) if d == c}
        else:
            assert set(after) == {d for d, t in before if not brute.hits(t, items)[1]}
        docs = out


def test_odd_rows(spark, odd, none, sf):
    for docs in (odd, none):
        for _, stage in corpus_pipeline.STAGES:
            done = written(stage(spark, docs, sf))
            docs = done if "text" in done.columns else docs


def test_all_are_registered():
    names = set(__spark_entry__.queries())
    assert {f"op{i}" for i in range(1, 11)} <= {n.split("_")[0] for n in names} and "pipeline" in names


def test_the_sql_of_the_quality_rules_is_a_twin(spark, sf, tmp_path):
    """Codes in capitals and with regions, NULL, a rare language, one with words of its own, another script."""
    import duckdb

    docs = spark.read.parquet(f"{sf.replace('0.001', '0.01')}/documents.parquet")
    code = F.expr("""case when doc_id % 3 = 0 then upper(lang) when doc_id % 7 = 0 then lang || '-XX' when doc_id % 11 = 0 then null
        when doc_id % 13 = 0 then 'rare' when lang = 'es' then 'it' else lang end""")
    text = F.expr("case when doc_id % 17 = 0 then translate(lower(text), 'abcdefghijklmnopqrstuvwxyz', 'абцдефгхийклмнопярстувшхыз') else text end")
    docs.withColumns({"lang": code, "text": text}).coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    rows = quality_rules.op6_quality_rules(spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    cursor = con.execute(quality_rules.SQL)
    names = [d[0] for d in cursor.description]
    assert sorted(map(tuple, rows.select(*names).collect())) == sorted(cursor.fetchall())
    assert rows.groupBy("kept").count().count() == 2


def test_the_quality_stage_keeps_columns_of_any_name(spark):
    docs = spark.createDataFrame([(1, "x " * 5, "en", "w", 5)], "doc_id long, text string, lang string, __words string, `a.b` int")
    assert quality_rules.keep_good(docs).columns == docs.columns and quality_rules.keep_good(docs).count() == 0
