"""Where long plans are cut: tables written to the folder that all executors share."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def _on_one_machine(spark: SparkSession) -> bool:
    """Whether all tasks run in this process, so that any folder is shared."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Where it is unset, a temporary one on a single machine, and an error on a cluster."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found
    held = spark.sparkContext._jsc.sc().getCheckpointDir()
    if held.isDefined():
        return held.get()
    if not _on_one_machine(spark):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    made = "file://" + tempfile.mkdtemp(prefix="quernstone-")
    spark.sparkContext.setCheckpointDir(made)
    return made


def _run_dir(spark: SparkSession) -> str:
    """This application's own folder inside the shared one; it is deleted when the application ends."""
    path = os.path.join(shared_dir(spark), f"quernstone-{spark.sparkContext.applicationId}")
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(at)
    return path


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: computed once, and safe if executors are lost."""
    path = os.path.join(_run_dir(df.sparkSession), uuid.uuid4().hex, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Delete all tables of `cut` of this application now. Results that weren't written yet can't be read any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_run_dir(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def spread(df: DataFrame) -> DataFrame:
    """df in as many partitions as tasks can run, where the session asks for it (spark.quernstone.spread = true).

    For one machine and tables of a single row group, as in the bench. Unset, every table is read in its own splits, whatever its size.
    """
    spark = df.sparkSession
    if spark.conf.get("spark.quernstone.spread", "false").lower() != "true":
        return df
    return df.repartition(spark.sparkContext.defaultParallelism)
