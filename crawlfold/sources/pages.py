"""Page tables, batch and stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from crawlfold.schemas import PAGES


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Stored pages. Partition them by fetch date, so that a date filter prunes files."""
    return spark.read.schema(PAGES).parquet(path)


def stream_pages(spark: SparkSession, path: str, files_per_trigger: int = 1000) -> DataFrame:
    """Stored pages as they arrive."""
    return (
        spark.readStream.schema(PAGES)
        .option("maxFilesPerTrigger", files_per_trigger)
        .parquet(path)
    )
