"""Snapshots, counters and the folder for files."""

import threading
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from crawlfold import session, sinks


def test_snapshot_versions(spark, tmp_path):
    root = str(tmp_path)
    assert sinks.read_snapshot(spark, root) is None
    sinks.write_snapshot(spark.range(3), root, 1)
    sinks.write_snapshot(sinks.read_snapshot(spark, root).filter("id > 0"), root, 2)
    sinks.write_snapshot(spark.range(7), root, 10)
    assert sinks.latest_version(spark, root) == 10
    assert sinks.read_snapshot(spark, root).count() == 7


def test_a_failed_write_leaves_the_old_version(spark, tmp_path):
    root = str(tmp_path)
    sinks.write_snapshot(spark.range(3), root, 1)
    broken = spark.range(3).select(F.when(F.col("id") == 2, F.raise_error(F.lit("stop"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception, match="stop"):
        sinks.write_snapshot(broken, root, 2)
    assert sinks.latest_version(spark, root) == 1
    assert sinks.read_snapshot(spark, root).count() == 3


def test_two_writers_of_one_version(spark, tmp_path):
    root = str(tmp_path)
    sinks.write_snapshot(spark.range(3), root, 1)
    sinks.write_snapshot(spark.range(5), root, 2)
    with pytest.raises(sinks.Conflict, match="version 2"):
        sinks.write_snapshot(spark.range(9), root, 2)
    assert sinks.read_snapshot(spark, root).count() == 5
    assert sinks.read_snapshot(spark, root, 1).count() == 3
    assert sinks.sweep_snapshots(spark, root, 1) == 2
    assert sinks.latest_version(spark, root) == 2 and sinks.read_snapshot(spark, root).count() == 5


def test_updates_at_the_same_time_all_count(spark, tmp_path):
    """Writers that read the same version: all start before any commits, and each merges again when it comes late."""
    root, together = str(tmp_path), threading.Barrier(3, timeout=60)
    sinks.write_snapshot(spark.range(1), root, 1)

    def add(n):
        first = []

        def change(old):
            if not first:
                first.append(together.wait())
            return old.unionByName(spark.range(n, n + 1))

        return sinks.update_snapshot(spark, root, change)

    with ThreadPoolExecutor(3) as pool:
        versions = sorted(pool.map(add, (10, 20, 30)))
    assert versions == [2, 3, 4]
    assert sorted(r["id"] for r in sinks.read_snapshot(spark, root).collect()) == [0, 10, 20, 30]


def test_a_writer_gives_up_in_the_end(spark, tmp_path):
    root = str(tmp_path)

    def overtaken(old):
        sinks.write_snapshot(spark.range(1), root, (sinks.latest_version(spark, root) or 0) + 1)
        return spark.range(2)

    with pytest.raises(sinks.Conflict):
        sinks.update_snapshot(spark, root, overtaken, tries=2)
    assert sinks.read_snapshot(spark, root).count() == 1


def test_counters(spark, tmp_path):
    rows = spark.createDataFrame([("a", "insert"), ("b", "update"), ("c", "keep"), ("d", "update")], "id string, action string")
    df, seen = sinks.counted(rows, "upsert")
    df.write.parquet(str(tmp_path / "x"))
    assert seen.get == {"rows": 4, "inserted": 1, "updated": 2}


def test_written_table(spark):
    df = session.written(spark.range(5))
    assert df.count() == 5 and df.dtypes == [("id", "bigint")]
    # A stored column may always be NULL, so only names and types carry over.


def test_cluster_needs_a_shared_folder():
    class Conf:
        def get(self, key, default):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_root(Session())


def test_the_session_names_the_folder():
    class Conf:
        def get(self, key, default):
            return "hdfs://shared/x"

    class Session:
        conf = Conf()

    assert session.new_folder(Session(), "log").startswith("hdfs://shared/x/log-")
