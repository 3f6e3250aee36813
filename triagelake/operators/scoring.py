"""Attach class probabilities, predictions and confidences to a table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.base import argmax_label, col, prefixed_classes, row_max


def proba_column(task: str, cls: str) -> str:
    return f"proba_{task}_{cls}"


def attach_scores(df: DataFrame, task: str, probabilities: Mapping[str, Column] | Sequence[str], array: str | None = None) -> DataFrame:
    """Add ``proba_<task>_<class>``, ``pred_<task>`` and ``<task>_confidence``.

    ``probabilities`` maps class to column, or is the class order of the
    ``array`` column holding the probabilities.
    """
    if array is not None:
        probabilities = {c: F.get(col(array), F.lit(i)) for i, c in enumerate(probabilities)}
    df = df.withColumns({proba_column(task, c): p.cast("double") for c, p in probabilities.items()})
    return refresh_prediction(df, task)


def refresh_prediction(df: DataFrame, task: str) -> DataFrame:
    """Prediction and confidence from the current probability columns.

    Ties go to the first class in sorted order.
    """
    classes = sorted(prefixed_classes(df, f"proba_{task}_"))
    probs = [col(proba_column(task, c)) for c in classes]
    return df.withColumns({
        f"pred_{task}": argmax_label(classes, probs),
        f"{task}_confidence": row_max(probs),
    })


def align_probabilities(df: DataFrame, task: str, classes: Sequence[str], out: str) -> DataFrame:
    """Probability columns as one array in the wanted class order."""
    return df.withColumn(out, F.array(*[col(proba_column(task, c)) for c in classes]))
