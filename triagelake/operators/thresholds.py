"""Per-class confidence thresholds from a calibration set."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.base import clip, col, lit_d
from .ranking import quantiles
from .scoring import proba_column


def true_class_probability(classes: Sequence[str], truth: str, task: str) -> Column:
    """Probability the row gave to its true class; null for a class the model does not know."""
    out = None
    for c in classes:
        p = col(proba_column(task, c))
        out = F.when(col(truth) == c, p) if out is None else out.when(col(truth) == c, p)
    return out


def class_thresholds(
    df: DataFrame, task: str, truth: str, classes: Sequence[str],
    quantile: float = 0.08, floor: float = 0.45, ceiling: float = 0.90,
) -> DataFrame:
    """(class, threshold) with a ``default`` row.

    A class gets a low quantile of the probabilities its own rows received,
    kept within [floor, ceiling]; a class without rows gets the floor. The
    default is the mean over classes. Without any row only ``default`` = floor
    is left.
    """
    known = [c for c in classes if proba_column(task, c) in df.columns]
    p = df.select(col(truth).alias("class"), true_class_probability(known, truth, task).alias("_p"))
    found = quantiles(p, ["class"], "_p", quantile)
    spine = df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(c) for c in classes])).alias("class"))
    any_row = F.coalesce(df.select(F.lit(True).alias("x")).limit(1).agg(F.max("x")).scalar(), F.lit(False))
    per_class = spine.join(found, "class", "left").select(
        "class", F.coalesce(clip(F.col("quantile"), floor, ceiling), lit_d(floor)).alias("threshold")
    )
    # clip() would turn a missing quantile into the floor anyway; the coalesce states the rule
    default = per_class.agg(clip(F.avg("threshold"), floor, ceiling).alias("threshold")).select(
        F.lit("default").alias("class"), F.when(any_row, F.col("threshold")).otherwise(lit_d(floor)).alias("threshold")
    )
    return per_class.filter(any_row).unionByName(default)
