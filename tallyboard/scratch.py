"""Intermediate tables in the folder that all executors share.

The folder is the one the cluster names in ``spark.checkpoint.dir``. Only a local session
without that setting gets a temporary folder of its own.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    context = spark.sparkContext
    named = spark.conf.get(SETTING, None) or context.getConf().get(SETTING)
    if named:
        return named.rstrip("/")
    current = context.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {SETTING} to a folder that every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tallyboard-"))
    return context.getCheckpointDir().rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder, grouped by application."""
    return f"{shared_folder(spark)}/tallyboard/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and go on from the written table.

    Cuts the lineage, freezes values that a recomputation could change (row positions, range
    bounds), survives the loss of executors, and keeps column pruning for later reads.
    """
    return _staged(df, new_folder(df.sparkSession, label))


def _staged(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """Tables staged for one operation; leaving the block removes them."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []

    def stage(self, df: DataFrame, label: str) -> DataFrame:
        self.paths.append(new_folder(self.spark, label))
        return _staged(df, self.paths[-1])

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_: object) -> None:
        for path in self.paths:
            drop_folder(self.spark, path)


def drop_folder(spark: SparkSession, path: str) -> None:
    """Remove a path made by :func:`new_folder`, wherever it is stored."""
    if "/tallyboard/" not in path:
        raise ValueError(f"not a scratch path: {path}")
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def drop_all(spark: SparkSession) -> None:
    """Remove every intermediate table this application wrote; call it when a job is done."""
    drop_folder(spark, f"{shared_folder(spark)}/tallyboard/{spark.sparkContext.applicationId}")
