"""Review tables: readers, required columns, writers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from ..functions.base import require_columns

REVIEW_SCHEMA = StructType([
    StructField("id", LongType()),
    StructField("title", StringType()),
    StructField("body", StringType()),
])
LABELLED_SCHEMA = StructType(REVIEW_SCHEMA.fields + [
    StructField("department", StringType()),
    StructField("sentiment", StringType()),
])
QUEUE_SCHEMA = StructType([
    StructField("id", LongType()),
    StructField("title", StringType()),
    StructField("body", StringType()),
    StructField("pred_department", StringType()),
    StructField("pred_sentiment", StringType()),
    StructField("department_confidence", DoubleType()),
    StructField("sentiment_confidence", DoubleType()),
    StructField("uncertainty_score", DoubleType()),
    StructField("diversity_score", DoubleType()),
    StructField("business_cost_score", DoubleType()),
    StructField("acquisition_score", DoubleType()),
    StructField("needs_review_diag", StringType()),
    StructField("priority", StringType()),
    StructField("risk_score", DoubleType()),
    StructField("true_department", StringType()),
    StructField("true_sentiment", StringType()),
    StructField("reviewer_notes", StringType()),
])


def read_reviews_csv(spark: SparkSession, path: str | Sequence[str], schema: StructType | None = LABELLED_SCHEMA) -> DataFrame:
    """CSV with header and quoted multi-line cells; ``schema=None`` infers types from the data."""
    reader = spark.read.option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"')
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.option("enforceSchema", False).schema(schema).csv(path)


def read_reviews(spark: SparkSession, path: str, fmt: str = "csv", schema: StructType | None = LABELLED_SCHEMA) -> DataFrame:
    """Reviews from CSV or from a columnar format (parquet, orc), title and body required."""
    df = read_reviews_csv(spark, path, schema) if fmt == "csv" else spark.read.format(fmt).load(path)
    require_columns(df, ["title", "body"], "reviews")
    return df


def read_benchmark_folder(spark: SparkSession, folder: str, schema: StructType = LABELLED_SCHEMA) -> DataFrame:
    """Every benchmark file of a folder as one table with the file name in ``section``."""
    df = read_reviews_csv(spark, f"{folder.rstrip('/')}/*.csv", schema)
    return df.withColumn("section", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1))


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite", partition_by: Sequence[str] = ()) -> None:
    """Write in parallel, one file per task; CSV gets a header and safe quoting."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer = writer.option("header", True).option("quote", '"').option("escape", '"')
    writer.format(fmt).save(path)


def write_predictions(df: DataFrame, path: str, fmt: str = "csv", diagnostic_review: bool = True) -> DataFrame:
    """Export scored rows; without diagnostics the review flag is left out."""
    out = df if diagnostic_review else df.drop("needs_review_diag")
    write_table(out, path, fmt)
    return out
