"""Session builder for local runs, and the one place that decides where files may go."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int = 8, app: str = "crawlfold") -> SparkSession:
    """A session for tests and the bench. On a cluster, use the session you are given."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        # Small test tables: keep a shuffle's partitions apart, so that all cores work.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach: `spark.checkpoint.dir` of the session.

    Only a local master may fall back to a temporary folder; a cluster without the
    setting is an error, because a machine-local folder is lost with its machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="crawlfold-"))
    return sc.getCheckpointDir()


def new_folder(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """Store `df` in the shared folder and return the stored table.

    Cuts the lineage: later steps start from files that outlive any executor, know their
    size, and are counted from the files' footers.
    """
    folder = new_folder(df.sparkSession, "step")
    df.write.parquet(folder)
    stored = df.sparkSession.read.schema(df.schema).parquet(folder)
    stored._step_folder = folder
    return stored


def remove(*tables: DataFrame) -> None:
    """Delete the files of tables that came from `written`, once everything made from them is stored itself."""
    for table in tables:
        if folder := getattr(table, "_step_folder", None):
            path = table.sparkSession._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
