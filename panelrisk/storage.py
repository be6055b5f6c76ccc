"""Tables written to the shared folder, to cut lineage and share results."""

from __future__ import annotations

import atexit
import shutil
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    A local session without that setting uses a folder in its warehouse, which
    is removed when the process ends.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_steps"
    spark.sparkContext.setCheckpointDir(folder)
    if folder.startswith("file:") or "://" not in folder:
        own = "/" + folder.removeprefix("file:").lstrip("/")
        atexit.register(shutil.rmtree, f"{own}/panelrisk/{spark.sparkContext.applicationId}", True)
    return folder


def run_dir(spark: SparkSession) -> str:
    """Folder of this application's tables."""
    return f"{shared_dir(spark)}/panelrisk/{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, label: str) -> str:
    return f"{run_dir(spark)}/{label}-{uuid.uuid4().hex}"


def delete(spark: SparkSession, path: str) -> None:
    """Remove a stored table; nothing happens if there is none."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def release(spark: SparkSession) -> None:
    """Remove all tables this application stored; results read from them must be written before."""
    delete(spark, run_dir(spark))


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Size of a stored table in bytes."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return int(files.getContentSummary(target).getLength())


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet and continue from the file.

    The plan runs a single time, a lost executor costs a re-read and not a
    recomputation, and later scans can prune columns.
    """
    return materialize_at(df, new_path(df.sparkSession, label))


def materialize_at(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
