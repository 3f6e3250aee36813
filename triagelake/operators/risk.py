"""Review flag, risk score, priority band."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.base import clip, col, lit_d, map_from_table, map_lookup

# Fixed values
DEFAULT_THRESHOLD = 0.55
RISK_WEIGHTS = {"p_neg": 0.62, "department_doubt": 0.24, "sentiment_doubt": 0.14}
RISK_BONUS = {"review": 0.05, "multi": 0.04, "hazard_step": 0.06, "hazard_cap": 0.24}
HAZARD_FLOOR = (2.0, 0.58)
PRIORITY_BANDS = ((0.78, "URGENT"), (0.58, "HIGH"), (0.38, "MEDIUM"))
LOWEST_PRIORITY = "LOW"
FALLBACK_P_NEG = {"neg": 0.70, "other": 0.30}

Thresholds = Mapping[str, float] | DataFrame


def below_threshold(label: Column, confidence: Column, thresholds: Thresholds, fallback: float = DEFAULT_THRESHOLD) -> Column:
    """True when a confidence is below the threshold of its class.

    Thresholds are a dict or a (class, threshold) table; the entry ``default``
    serves classes without their own.
    """
    if isinstance(thresholds, DataFrame):
        table = map_from_table(thresholds, "class", "threshold")
        default = F.coalesce(F.try_element_at(table, F.lit("default")), lit_d(fallback))
        limit = map_lookup(label, table, default)
    else:
        limit = map_lookup(label, thresholds, float(thresholds.get("default", fallback)))
    return confidence < limit


def review_flag(df: DataFrame, department: Thresholds, sentiment: Thresholds) -> Column:
    """Row needs a human look: either task is below its threshold."""
    return below_threshold(col("pred_department"), col("department_confidence"), department) | below_threshold(
        col("pred_sentiment"), col("sentiment_confidence"), sentiment
    )


def risk_score(p_neg: Column, dep_conf: Column, sent_conf: Column, review: Column, hazard: Column, multi: Column) -> Column:
    hazard = F.greatest(hazard.cast("double"), lit_d(0.0))
    risk = (
        lit_d(RISK_WEIGHTS["p_neg"]) * p_neg
        + lit_d(RISK_WEIGHTS["department_doubt"]) * (lit_d(1.0) - dep_conf)
        + lit_d(RISK_WEIGHTS["sentiment_doubt"]) * (lit_d(1.0) - sent_conf)
        + F.when(review, lit_d(RISK_BONUS["review"])).otherwise(lit_d(0.0))
        + F.when(multi, lit_d(RISK_BONUS["multi"])).otherwise(lit_d(0.0))
        + F.least(lit_d(RISK_BONUS["hazard_cap"]), lit_d(RISK_BONUS["hazard_step"]) * hazard)
    )
    risk = clip(risk, 0.0, 1.0)
    return F.when(hazard >= HAZARD_FLOOR[0], F.greatest(risk, lit_d(HAZARD_FLOOR[1]))).otherwise(risk)


def priority_band(risk: Column) -> Column:
    out = None
    for low, name in PRIORITY_BANDS:
        out = F.when(risk >= low, F.lit(name)) if out is None else out.when(risk >= low, F.lit(name))
    return out.otherwise(F.lit(LOWEST_PRIORITY))


def apply_operational_fields(
    df: DataFrame,
    department_thresholds: Thresholds | None = None,
    sentiment_thresholds: Thresholds | None = None,
    diagnostic_review: bool = False,
) -> DataFrame:
    """Add ``needs_review_diag``, ``risk_score`` and ``priority``.

    Which inputs exist is settled while the plan is built: without a negative
    probability the predicted label stands in, without hazard or department
    columns their terms are zero.
    """
    if diagnostic_review and department_thresholds and sentiment_thresholds:
        out = df.withColumn("needs_review_diag", review_flag(df, department_thresholds, sentiment_thresholds))
    else:
        out = df.withColumn("needs_review_diag", F.lit(False))

    if "proba_sentiment_neg" in out.columns:
        p_neg = col("proba_sentiment_neg").cast("double")
    else:
        p_neg = F.when(col("pred_sentiment") == "neg", lit_d(FALLBACK_P_NEG["neg"])).otherwise(
            lit_d(FALLBACK_P_NEG["other"]))
    hazard = col("sentiment_hazard_score") if "sentiment_hazard_score" in out.columns else F.lit(0)
    if "impacted_departments_count" in out.columns:
        multi = col("impacted_departments_count") > 1
    elif "cross_department_signal" in out.columns:
        multi = F.coalesce(col("cross_department_signal"), F.lit(False))
    else:
        multi = F.lit(False)
    out = out.withColumn("risk_score", risk_score(
        p_neg, col("department_confidence").cast("double"), col("sentiment_confidence").cast("double"),
        col("needs_review_diag"), hazard, multi,
    ))
    return out.withColumn("priority", priority_band(col("risk_score")))
