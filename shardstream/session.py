"""The shared work folder of a session, and tables pinned in it."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def work_folder(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it in ``spark.checkpoint.dir``.

    Where the setting is absent a local session gets a temporary folder; a cluster session is
    refused, because a folder on one machine would be lost with it.
    """
    sc = spark.sparkContext
    folder = spark.conf.get(CHECKPOINT_CONF, None) or sc.getCheckpointDir()
    if folder is None:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder that every executor can reach")
        folder = tempfile.mkdtemp(prefix="shardstream-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(folder)
    return spark.conf.get(CHECKPOINT_CONF, None) or folder


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A path in the work folder that nothing has used before."""
    return f"{work_folder(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def store(table: DataFrame, purpose: str) -> DataFrame:
    """Write a table to the work folder and go on from its files, which go with the session."""
    spark, path = table.sparkSession, new_folder(table.sparkSession, purpose)
    table.write.parquet(path)
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    there.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(there)
    return spark.read.schema(table.schema).parquet(path)


def settle(table: DataFrame) -> DataFrame:
    """Compute a table once, write it to the work folder and go on from the written rows.

    For small tables that several steps read, and for columns (generated ids) that must not change
    when a lost executor makes Spark compute them again.
    """
    work_folder(table.sparkSession)
    return table.checkpoint()
