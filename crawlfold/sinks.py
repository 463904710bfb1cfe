"""Sinks: versioned snapshots, batch logs and write counters.

Parquet tables cannot be updated in place. A new version of a table is written to a folder of its
own and becomes visible when a commit file of that number appears, so a failed write leaves the old
version in force. The commit file is only ever created, never replaced: of two writers of one version
the first wins, and the other is told.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


class Conflict(RuntimeError):
    """Another writer has committed the version."""


_COMMIT = ".commit"


def _files(spark: SparkSession, path: str):
    """Hadoop path, its file system, and the JVM's name space."""
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration()), jvm


def _publish(spark: SparkSession, path: str, text: str) -> bool:
    """Create the file `path` holding `text`, whole or not at all; False when it is there already.

    The text is staged under another name first, so nobody reads half a file. A rename that must not replace is one step
    on a distributed file system; a local one checks and renames in two, so there a hard link is made instead.
    """
    where, fs, jvm = _files(spark, path)
    staged = jvm.org.apache.hadoop.fs.Path(where.getParent(), f"_{where.getName()}-{uuid.uuid4().hex}")
    fs.mkdirs(where.getParent())
    out = fs.create(staged, False)
    out.write(bytearray(text.encode()))
    out.close()
    try:
        if fs.getScheme() == "file":
            at = lambda p: jvm.java.nio.file.Path.of(p.toUri().getPath(), spark.sparkContext._gateway.new_array(jvm.java.lang.String, 0))
            jvm.java.nio.file.Files.createLink(at(where), at(staged))
        else:
            option = jvm.org.apache.hadoop.fs.Options.Rename
            options = spark.sparkContext._gateway.new_array(option, 1)
            options[0] = option.NONE
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri()).rename(staged, where, options)
        return True
    except Exception:
        if fs.exists(where):
            return False
        raise
    finally:
        if fs.exists(staged):
            fs.delete(staged, False)


def _versions(spark: SparkSession, root: str) -> list[int]:
    pattern, fs, _ = _files(spark, f"{root}/v=*{_COMMIT}")
    names = [s.getPath().getName() for s in fs.globStatus(pattern) or []]
    return sorted(int(n.removeprefix("v=").removesuffix(_COMMIT)) for n in names)


def _folder(spark: SparkSession, root: str, version: int) -> str:
    """Folder of a committed version, as its commit file names it."""
    where, fs, jvm = _files(spark, f"{root}/v={version}{_COMMIT}")
    stream = fs.open(where)
    try:
        return f"{root}/{jvm.org.apache.commons.io.IOUtils.toString(stream, 'UTF-8')}"
    finally:
        stream.close()


def _writer(df: DataFrame, by: str | None):
    return df.write.partitionBy(by) if by else df.write


def write_snapshot(df: DataFrame, root: str, version: int, by: str | None = None) -> None:
    """Store `df` as a version of the table, in folders of the column `by` if given; `Conflict` when somebody else has
    committed that version.

    What a loser has written stays in a folder that nothing names; `sweep_snapshots` removes such folders.
    """
    folder = f"data-{version}-{uuid.uuid4().hex}"
    _writer(df, by).parquet(f"{root}/{folder}")
    if not _publish(df.sparkSession, f"{root}/v={version}{_COMMIT}", folder):
        raise Conflict(f"version {version} of {root} is taken")


def latest_version(spark: SparkSession, root: str) -> int | None:
    """Greatest version that was committed, None when there is none."""
    return max(_versions(spark, root), default=None)


def read_snapshot(spark: SparkSession, root: str, version: int | None = None) -> DataFrame | None:
    """A version of the table, the latest by default; None when nothing was committed."""
    if version is None:
        version = latest_version(spark, root)
    return None if version is None else spark.read.parquet(_folder(spark, root, version))


def update_snapshot(spark: SparkSession, root: str, change: Callable[[DataFrame | None], DataFrame], tries: int = 5) -> int:
    """Commit `change` of the latest version as the next one; returns its number.

    The version read is the version built upon: when another writer commits first, the change is applied again, to
    what that one committed, so neither update is lost. `change` gets None for an empty table.
    """
    for left in reversed(range(tries)):
        version = latest_version(spark, root)
        old = None if version is None else read_snapshot(spark, root, version)
        try:
            write_snapshot(change(old), root, (version or 0) + 1)
            return (version or 0) + 1
        except Conflict:
            if not left:
                raise


def sweep_snapshots(spark: SparkSession, root: str, keep: int) -> int:
    """Remove what no commit names and all but the `keep` latest versions. Run it while no writer is at work.

    Returns how many folders went.
    """
    versions = _versions(spark, root)
    kept = {_folder(spark, root, v).rsplit("/", 1)[1] for v in versions[max(0, len(versions) - keep):]}
    for v in versions[: max(0, len(versions) - keep)]:
        where, fs, _ = _files(spark, f"{root}/v={v}{_COMMIT}")
        fs.delete(where, False)
    pattern, fs, _ = _files(spark, f"{root}/data-*")
    gone = [s.getPath() for s in fs.globStatus(pattern) or [] if s.getPath().getName() not in kept]
    for path in gone:
        fs.delete(path, True)
    return len(gone)


def _batches(spark: SparkSession, root: str) -> dict[int, str]:
    """Folders of the batches whose write was committed, by number."""
    pattern, fs, _ = _files(spark, f"{root}/batch_id=*/_SUCCESS")
    folders = [s.getPath().getParent() for s in fs.globStatus(pattern) or []]
    return {int(f.getName().removeprefix("batch_id=")): f.toString() for f in folders}


def write_batch(df: DataFrame, log: str, batch_id: int, by: str | None = None) -> None:
    """Store a micro-batch under its id, in folders of the column `by` if given; a retry of the batch replaces it."""
    _writer(df, by).mode("overwrite").parquet(f"{log}/batch_id={batch_id}")


def read_log(spark: SparkSession, log: str, snapshots: str | None = None) -> DataFrame | None:
    """All committed batches, with the column batch_id; None when there are none.

    With `snapshots`, the latest one stands for the batches up to its version, and only the
    folders of later batches are read.
    """
    version = latest_version(spark, snapshots) if snapshots else None
    later = [f for n, f in sorted(_batches(spark, log).items()) if version is None or n > version]
    batches = spark.read.option("basePath", log).parquet(*later) if later else None
    if batches is not None:  # the folder's number, whatever type its text was read as
        batches = batches.withColumn("batch_id", F.col("batch_id").cast("bigint"))
    if version is None:
        return batches
    base = read_snapshot(spark, snapshots, version).withColumn("batch_id", F.lit(version).cast("bigint"))
    return base if batches is None else base.unionByName(batches)


def compact(spark: SparkSession, log: str, snapshots: str, fold: Callable[[DataFrame], DataFrame],
            retire: bool = False, by: str | None = None) -> int | None:
    """Fold the log into a new snapshot, so that reading does not grow with the number of batches.

    With `retire`, the batch folders that the snapshot stands for are removed once it is committed;
    from then on the log is only whole together with its snapshots. Returns the newest batch.
    """
    batches = _batches(spark, log)
    newest = max([*batches, *([v] if (v := latest_version(spark, snapshots)) is not None else [])], default=None)
    rows = read_log(spark, log, snapshots)
    if rows is None:
        return None
    if newest != v:
        write_snapshot(fold(rows), snapshots, newest, by)
    for number, folder in batches.items():
        if retire and number <= newest:
            path, fs, _ = _files(spark, folder)
            fs.delete(path, True)
    return newest


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count rows per action while they are written, without another pass.

    Read the result with `observation.get` once the write has run.
    """
    seen = Observation(name)
    inserts = F.count_if(F.col("action") == "insert").alias("inserted")
    updates = F.count_if(F.col("action") == "update").alias("updated")
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), inserts, updates), seen
