"""Materialised intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for checkpoints; else the context's own. In local mode, one inside the warehouse will do."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return (folder or spark.conf.get("spark.sql.warehouse.dir") + "/shared").rstrip("/")


def new_folder(spark: SparkSession) -> str:
    """A path of its own in the shared folder, removed when the session's JVM ends."""
    path = f"{shared_folder(spark)}/triagelake/{uuid.uuid4().hex}"
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(jvm_path)
    return path


def materialise(df: DataFrame) -> DataFrame:
    """Write a table to the shared folder and read it back.

    For narrow intermediates several later steps read: they are computed once,
    outlive lost executors, and stop the optimiser from pushing filters on
    computed columns (and with them the computation) into every reader. The
    files go when the session's JVM ends.
    """
    spark = df.sparkSession
    path = new_folder(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
