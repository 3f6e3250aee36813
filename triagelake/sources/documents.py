"""JSON documents: metrics, thresholds, roll-up summaries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, MapType, StringType, StructField, StructType

from ..functions.base import col, lit_d

THRESHOLDS_SCHEMA = StructType([
    StructField("timestamp", StringType()),
    StructField("department", MapType(StringType(), StringType())),
    StructField("sentiment", MapType(StringType(), StringType())),
    StructField("diagnostic_only", StringType()),
])
DEFAULT_THRESHOLDS = {"department": {"default": 0.55}, "sentiment": {"default": 0.55}}


def read_json(spark: SparkSession, path: str, schema: StructType | None = None, default: DataFrame | None = None) -> DataFrame:
    """Multi-line JSON; a path that does not exist gives ``default`` when there is one."""
    reader = spark.read.option("multiLine", True)
    if schema is not None:
        reader = reader.schema(schema)
    try:
        return reader.json(path)
    except AnalysisException as error:
        if default is not None and error.getCondition() == "PATH_NOT_FOUND":
            return default
        raise


def read_thresholds(spark: SparkSession, path: str | None = None) -> DataFrame:
    """Threshold file as (task, class, threshold) rows with the raw text value."""
    default = _threshold_rows(spark, DEFAULT_THRESHOLDS)
    if path is None:
        return default
    wide = read_json(spark, path, THRESHOLDS_SCHEMA, default=spark.createDataFrame([], "task string"))
    if "department" not in wide.columns:
        return default
    tasks = F.explode(F.array(
        *[F.struct(F.lit(t).alias("task"), F.col(t).alias("m")) for t in ("department", "sentiment")]
    )).alias("t")
    return wide.select(tasks).select("t.task", F.explode("t.m").alias("class", "threshold"))


def _threshold_rows(spark: SparkSession, maps: Mapping[str, Mapping[str, float]]) -> DataFrame:
    rows = [(t, c, str(v)) for t, m in maps.items() for c, v in m.items()]
    return spark.createDataFrame(rows, "task string, class string, threshold string")


def normalise_thresholds(table: DataFrame, classes: DataFrame, fallback: float = 0.55) -> DataFrame:
    """A usable threshold for every class, plus ``default``.

    ``table`` is (class, threshold) with possibly unreadable values, which are
    skipped; ``classes`` is (class). Classes without a value take the default.
    """
    good = (
        table.select("class", F.expr("try_cast(threshold AS double)").alias("threshold"))
        .filter(F.col("threshold").isNotNull())
    )
    stated = good.filter(F.col("class") == "default").agg(F.max("threshold")).scalar()
    default = F.coalesce(stated, lit_d(fallback))
    names = classes.select("class").union(good.select("class")).filter(F.col("class") != "default").distinct()
    filled = names.join(good, "class", "left").select("class", F.coalesce("threshold", default).alias("threshold"))
    only_default = table.sparkSession.range(1).select(F.lit("default").alias("class"), default.alias("threshold"))
    return filled.unionByName(only_default)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)


def write_sla_summary(df: DataFrame, path: str) -> None:
    """The roll-up as one JSON document ``{"rows": [...]}``; its size is the department list."""
    rows = F.collect_list(F.struct(*[col(c) for c in df.columns])).alias("rows")
    df.agg(rows).write.mode("overwrite").json(path)


def write_metrics(metrics: DataFrame, path: str) -> None:
    """Long metrics (section, task, class, metric, value) as nested JSON, one line per section.

    A section's metrics are one row per (task, class, metric), so each group is small.
    """
    leaf = metrics.withColumn("_name", F.concat_ws(".", F.col("task"), F.col("class"), F.col("metric")))
    entries = F.map_from_entries(F.collect_list(F.struct("_name", "value"))).alias("metrics")
    leaf.groupBy("section").agg(entries).write.mode("overwrite").json(path)


def _recall_facts(fact, task: str):
    recalls = F.map_entries(F.col(f"s.{task}.recall_by_class"))
    return F.transform(recalls, lambda e: fact(task, "recall", e["value"], e["key"]))


def read_reported_metrics(spark: SparkSession, path: str) -> DataFrame:
    """Evaluation report file as long metrics (section, task, class, metric, value).

    Understands the report layout ``{test_split: {...}, benchmarks: {name: {...}}}``
    with per-task ``accuracy``, ``f1_macro``, ``recall_by_class``, an optional
    ``calibration`` block, ``coverage`` and ``needs_review_rate``.
    """
    task = "struct<accuracy:double,f1_macro:double,recall_by_class:map<string,double>>"
    calibration = "struct<department:struct<ece:double,brier:double>,sentiment:struct<ece:double,brier:double>>"
    section = (
        f"struct<department:{task},sentiment:{task},calibration:{calibration},"
        "coverage:double,needs_review_rate:double>"
    )
    raw = spark.read.option("multiLine", True).schema(
        f"test_split {section}, benchmarks map<string,{section}>"
    ).json(path)
    sections = raw.select(F.explode(F.map_concat(
        F.create_map(F.lit("test_split"), F.col("test_split")),
        F.coalesce(F.col("benchmarks"), F.expr(f"cast(map() AS map<string,{section}>)")),
    )).alias("section", "s"))

    def fact(task_name: str | None, metric: str, value, cls=None):
        return F.struct(
            F.lit(task_name).cast("string").alias("task"),
            (F.lit(None) if cls is None else cls).cast("string").alias("class"),
            F.lit(metric).alias("metric"), value.cast("double").alias("value"),
        )

    facts = [
        F.array(
            fact(None, "coverage", F.col("s.coverage")),
            fact(None, "needs_review_rate", F.col("s.needs_review_rate")),
            *[fact(t, m, F.col(f"s.{t}.{m}")) for t in ("department", "sentiment") for m in ("accuracy", "f1_macro")],
            *[fact(t, m, F.col(f"s.calibration.{t}.{m}")) for t in ("department", "sentiment") for m in ("ece", "brier")],
        )
    ]
    for t in ("department", "sentiment"):
        recalls = _recall_facts(fact, t)
        facts.append(F.coalesce(
            recalls, F.array().cast("array<struct<task:string,class:string,metric:string,value:double>>")
        ))
    return (
        sections.select("section", F.inline(F.concat(*facts)))
        .filter(F.col("value").isNotNull())
    )
