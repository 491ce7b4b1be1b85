"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or where it is unset one in the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return (folder or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints").rstrip("/")


def stage(df: DataFrame) -> DataFrame:
    """The frame written to the shared folder as Parquet and read back.

    It cuts the lineage, so that lost executors cost no more than their running tasks, and fixes
    row keys that depend on the partitioning. The tables of an application lie together in one
    folder named after it, to be removed with the other checkpoints of that application.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    # Shuffle files are of no use once the table is written; else they stay until the driver's next
    # garbage collection.
    before = spark.conf.get(_CLEANUP, None)
    try:
        if before is not None:
            spark.conf.set(_CLEANUP, "true")
        # By place, as names may differ in their case only.
        names = [f"_{i}" for i in range(len(df.columns))]
        plain = df.toDF(*names)
        plain.write.parquet(path)
    finally:
        if before is not None:
            spark.conf.set(_CLEANUP, before)
    out = spark.read.schema(plain.schema).parquet(path).toDF(*df.columns)
    out.staged_path = path
    return out


def discard(staged: DataFrame) -> None:
    """Remove a staged table that nothing reads any more."""
    jvm = staged.sparkSession._jvm
    path = jvm.org.apache.hadoop.fs.Path(staged.staged_path)
    path.getFileSystem(staged.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
