"""Folders and tables that all executors share, and small column helpers."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Separators of the word pattern: U+0020 and U+0009 to U+000D.
WORD = "[^\\x20\\x09-\\x0D]+"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def shared_folder(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; where that is unset (tests), the context's own or one inside the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return (folder or spark.conf.get("spark.sql.warehouse.dir") + "/shared").rstrip("/")


def new_path(spark: SparkSession, what: str) -> str:
    """A path of its own for each run, removed when the session's JVM ends."""
    path = f"{shared_folder(spark)}/{what}-{uuid.uuid4().hex}"
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(jvm_path)
    return path


def written(df: DataFrame, what: str) -> DataFrame:
    """The table as Parquet in the shared folder: computed once, outlives lost executors, and its real size is known
    to the planner, which then broadcasts it only below the session's threshold. Nothing reads the write's shuffles again,
    so Spark is told to remove their files when it ends, not when the driver collects garbage."""
    spark = df.sparkSession
    path = new_path(spark, what)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def settled(df: DataFrame) -> DataFrame:
    """A reliable checkpoint: cuts the lineage, and Spark removes the files once nothing refers to them."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z alone; other letters stay as they are."""
    return F.translate(text, UPPER, UPPER.lower())


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def own_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Only the named columns, so that extra columns of any name can't clash with derived ones."""
    return df.select(*[F.col(f"`{name}`") for name in names])
