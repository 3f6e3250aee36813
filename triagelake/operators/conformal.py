"""Split-conformal prediction sets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.base import argmax_label, clip, col, lit_d
from .ranking import order_statistics
from .scoring import proba_column
from .thresholds import true_class_probability

METHODS = ("aps", "threshold")


def ranked_with_mass(classes: Sequence[str], task: str) -> Column:
    """Classes by falling probability, each with the mass accumulated up to it.

    One short array per row; equal probabilities keep class order.
    """
    entries = F.array(*[
        F.struct((-col(proba_column(task, c))).alias("neg_p"), F.lit(i).alias("i"), F.lit(c).alias("name"))
        for i, c in enumerate(classes)
    ])
    start = F.array().cast("array<struct<name:string,mass:double>>")
    mass_so_far = lambda acc: F.coalesce(F.get(acc, F.size(acc) - 1)["mass"], lit_d(0.0))
    return F.aggregate(
        F.array_sort(entries), start,
        lambda acc, e: F.concat(acc, F.array(F.struct(e["name"].alias("name"), (mass_so_far(acc) - e["neg_p"]).alias("mass")))),
    )


def conformal_scores(df: DataFrame, task: str, truth: str, classes: Sequence[str], method: str = "aps", out: str = "conformal_score") -> DataFrame:
    """Non-conformity of the true class: accumulated mass (aps) or one minus its probability."""
    if method == "aps":
        out_df = df.withColumn("_ranked", ranked_with_mass(classes, task))
        mine = F.filter(F.col("_ranked"), lambda e: e["name"] == col(truth))
        return out_df.withColumn(out, F.get(mine, F.lit(0))["mass"]).drop("_ranked")
    return df.withColumn(out, lit_d(1.0) - true_class_probability(classes, truth, task))


def conformal_fit(df: DataFrame, task: str, truth: str, classes: Sequence[str], alpha: float = 0.10, method: str = "aps") -> DataFrame:
    """One row (method, alpha, n, qhat, threshold): the calibrated cut."""
    if method not in METHODS:
        raise ValueError(f"unknown conformal method {method!r}")
    scored = conformal_scores(df, task, truth, classes, method)

    def rank(n: Column) -> Column:
        level = clip(F.ceil((n + 1).cast("double") * lit_d(1.0 - alpha)).cast("double") / n.cast("double"), 0.0, 1.0)
        return F.ceil(level * (n - 1).cast("double"))

    cut = order_statistics(scored, [], "conformal_score", {"qhat": rank})
    threshold = F.lit(None).cast("double") if method == "aps" else lit_d(1.0) - F.col("value")
    return cut.select(
        F.lit(method).alias("method"), lit_d(alpha).alias("alpha"), F.col("group_rows").alias("n"),
        F.col("value").alias("qhat"), threshold.alias("threshold"),
    )


def conformal_sets(
    df: DataFrame, fitted: DataFrame | float, task: str, classes: Sequence[str], method: str = "aps",
    prefix: str | None = None, as_text: bool = False,
) -> DataFrame:
    """Add ``<task>_conformal_set`` and ``<task>_conformal_size``.

    ``fitted`` is the table of :func:`conformal_fit` (read as a one-value
    subquery) or a qhat. Only expressions on the row: no shuffle.
    """
    name = prefix or task
    df = df.withColumn("_qhat", lit_d(fitted) if isinstance(fitted, (int, float)) else fitted.select("qhat").scalar())
    qhat = F.col("_qhat")
    probs = [col(proba_column(task, c)) for c in classes]
    if method == "aps":
        df = df.withColumn("_ranked", ranked_with_mass(classes, task))
        below = F.size(F.filter(F.col("_ranked"), lambda e: e["mass"] < qhat))
        keep = F.least(below + F.lit(1), F.lit(len(classes)))
        members = F.transform(F.slice(F.col("_ranked"), F.lit(1), keep), lambda e: e["name"])
    else:
        cut = lit_d(1.0) - qhat
        inside = F.array_compact(F.array(*[F.when(p >= cut, F.lit(c)) for c, p in zip(classes, probs)]))
        members = F.when(F.size(inside) > 0, inside).otherwise(F.array(argmax_label(classes, probs)))
    df = df.withColumn(f"{name}_conformal_set", members).drop("_ranked", "_qhat")
    df = df.withColumn(f"{name}_conformal_size", F.size(f"{name}_conformal_set"))
    return df.withColumn(f"{name}_conformal_set", F.concat_ws("|", f"{name}_conformal_set")) if as_text else df


def conformal_evaluation(df: DataFrame, truth: str, members: str, by: Sequence[str] = ()) -> DataFrame:
    """Coverage and mean set size; 0 without rows."""
    covered = F.array_contains(col(members), col(truth)).cast("double")
    return df.groupBy(*by).agg(
        F.count("*").alias("rows"),
        F.coalesce(F.avg(covered), lit_d(0.0)).alias("coverage"),
        F.coalesce(F.avg(F.size(col(members))), lit_d(0.0)).alias("avg_set_size"),
    )
