"""From raw documents to sampled token ids, in five stored stages.

Each stage takes the session, the documents that the stage before kept, and the folder of the tables;
all but the last return the columns of `documents`. Texts change in `line_dedup` alone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlfold.llm import decontaminate, jaccard_join, line_dedup, quality_rules, sentencepiece_sampling
from crawlfold.session import written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.keep_good(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shared lines stay in the first document that holds them. A document that loses all its lines stays, empty."""
    found = line_dedup.dedup_lines(docs)
    columns = {"text": F.col("__text"), "n_chars": F.length("__text").cast("long")}
    return found.select(*[columns[c].alias(c) if c in columns else F.col(f"`{c}`") for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of each group of linked documents stays. Rows that share an id stay or go together.

    The ids that go are stored first, so that Spark knows their size when it joins.
    """
    found = jaccard_join.near_duplicates(docs)
    gone = written(found.filter(~F.col("id").eqNullSafe(F.col("component"))).select(F.col("id").alias("__gone")).distinct())
    return docs.join(gone, F.col("doc_id").eqNullSafe(F.col("__gone")), "left_anti")


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Two sampled segmentations of every document, as ids."""
    return sentencepiece_sampling.encode(docs, keep=("doc_id", "lang", "source"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("jaccard_join", near_duplicates),
    ("decontamination", decontaminated),
    ("sentencepiece", pieces),
]

#: Sampling, and hashes inside the stages before it, are not for SQL; tests/llm holds the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
