"""Rows that are much work are dealt to all cores, however few files they come from."""

from pyspark.sql import functions as F

from driver import bindings as b, queries


def customers(spark, n=200):
    return spark.range(n).coalesce(1).selectExpr("id c_custkey", "concat('N', id) c_name", "cast(id % 25 as int) c_nationkey")


def test_detail_pages_are_made_by_many_tasks(spark):
    pages = b.as_detail_pages(customers(spark), nested=True)
    busy = pages.select(F.spark_partition_id().alias("task")).distinct().count()
    assert busy > spark.sparkContext.defaultParallelism
    assert pages.select("url").distinct().count() == pages.count() == 200


def test_parts_of_a_stored_stream_are_several_files(spark, tmp_path):
    rows = spark.range(300).coalesce(1)
    stream = queries._stored_stream(rows, f"{tmp_path}/in", 3, F.col("id") % 3, files=4)
    assert len(list((tmp_path / "in").glob("part-*.parquet"))) == 12
    stream.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/ck").trigger(
        availableNow=True).start().awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(f"{tmp_path}/out").collect()) == list(range(300))
    assert len(list((tmp_path / "ck" / "commits").glob("[0-9]*"))) == 3


def test_deliveries_come_one_batch_each(spark, tmp_path):
    seen, rows = [], spark.range(300).coalesce(1)
    for stream in queries._deliveries(rows, f"{tmp_path}/in", 3, F.col("id") % 3):
        stream.writeStream.foreachBatch(lambda df, i: seen.append((i, sorted(r.id for r in df.collect())))).option(
            "checkpointLocation", f"{tmp_path}/ck").trigger(availableNow=True).start().awaitTermination()
    assert seen == [(i, list(range(i, 300, 3))) for i in range(3)]
