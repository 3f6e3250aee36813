"""Run-against-run comparison of long metrics (section, task, class, metric, value)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.base import col, lit_d

# Figures of the before/after report: (name, task, metric, class, value when missing)
REPORT_FIGURES = (
    ("department_f1", "department", "f1_macro", None, 0.0),
    ("sentiment_f1", "sentiment", "f1_macro", None, 0.0),
    ("sentiment_recall_neg", "sentiment", "recall", "neg", 0.0),
    ("sentiment_recall_pos", "sentiment", "recall", "pos", 0.0),
    ("coverage", None, "coverage", None, None),
    ("needs_review_rate", None, "needs_review_rate", None, None),
)


def _pick(task: str | None, metric: str, cls: str | None) -> Column:
    cond = (F.col("metric") == metric) & F.col("task").eqNullSafe(F.lit(task))
    if cls is not None:
        cond = cond & (F.col("class") == cls)
    return F.max(F.when(cond, F.col("value")))


def report_figures(metrics: DataFrame, sections: Sequence[str] | None = None, figures=REPORT_FIGURES) -> DataFrame:
    """(section, metric, value) with missing scores as 0 and missing coverage as null."""
    wide = metrics.groupBy("section").agg(*[_pick(t, m, c).alias(n) for n, t, m, c, _ in figures])
    if sections is not None:
        names = metrics.sparkSession.range(1).select(F.explode(F.array(*[F.lit(s) for s in sections])).alias("section"))
        wide = names.join(wide, "section", "left")
    cells = [
        F.struct(
            F.lit(n).alias("metric"),
            (F.col(n) if missing is None else F.coalesce(F.col(n), lit_d(missing))).alias("value"),
        )
        for n, _, _, _, missing in figures
    ]
    return wide.select("section", F.inline(F.array(*cells)))


def metric_delta(before: DataFrame, after: DataFrame, keys: Sequence[str] = ("section", "metric")) -> DataFrame:
    """Full outer comparison: (keys..., before, after, delta); the delta needs both sides."""
    b = before.select(*keys, F.col("value").alias("before"))
    a = after.select(*keys, F.col("value").alias("after"))
    return b.join(a, list(keys), "full_outer").withColumn("delta", F.col("after") - F.col("before"))


def safety_report(before: DataFrame, after: DataFrame, sections: Sequence[str] | None = None) -> DataFrame:
    """Before/after/delta of the report figures per section, from two runs' long metrics."""
    return metric_delta(report_figures(before, sections), report_figures(after, sections))


def percentage_points(delta: Column) -> Column:
    return F.coalesce(delta, lit_d(0.0)) * lit_d(100.0)


def advanced_delta(base: DataFrame, advanced: DataFrame) -> DataFrame:
    """F1 and calibration-error differences for sections present in both runs.

    A calibration error the base run does not report gives a null difference.
    """
    def wide(df: DataFrame, suffix: str) -> DataFrame:
        return df.groupBy("section").agg(*[
            _pick(t, m, None).alias(f"{t}_{n}_{suffix}")
            for t in ("department", "sentiment") for n, m in (("f1", "f1_macro"), ("ece", "ece"))
        ])

    both = wide(base, "base").join(wide(advanced, "adv"), "section")
    return both.select("section", *[
        (F.col(f"{t}_{n}_adv") - F.col(f"{t}_{n}_base")).alias(f"{t}_{n}_delta")
        for n in ("f1", "ece") for t in ("department", "sentiment")
    ])


def model_comparison(metrics: DataFrame, models: tuple[str, str], model: str = "model", metric: str = "f1_macro") -> DataFrame:
    """Per (section, task): the metric of two models side by side and its difference."""
    first, second = models
    wide = metrics.filter(F.col("metric") == metric).groupBy("section", "task").agg(
        F.max(F.when(col(model) == first, F.col("value"))).alias(first),
        F.max(F.when(col(model) == second, F.col("value"))).alias(second),
    )
    return wide.withColumn("delta", col(second) - col(first))


def run_summary(metrics: DataFrame, run: str = "run", test: str = "test_split", safety: str = "reviews_safety_critical.csv") -> DataFrame:
    """One row per run: macro-F1 of both tasks on the test split and the safety set."""
    def cell(section: str, task: str) -> Column:
        cond = (F.col("section") == section) & (F.col("task") == task) & (F.col("metric") == "f1_macro")
        return F.max(F.when(cond, F.col("value")))

    return metrics.groupBy(run).agg(
        cell(test, "department").alias("test_department_f1"),
        cell(test, "sentiment").alias("test_sentiment_f1"),
        cell(safety, "department").alias("safety_department_f1"),
        cell(safety, "sentiment").alias("safety_sentiment_f1"),
    )
