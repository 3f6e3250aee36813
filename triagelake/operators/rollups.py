"""Aggregations over scored tables: load, priorities, coverage, KPIs, profiles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.base import clip, col, lit_d, map_lookup

# Fixed values
SLA_HOURS = {"Reception": 2.0, "Housekeeping": 4.0, "F&B": 6.0}
CAPACITY_PER_HOUR = {"Reception": 14.0, "Housekeeping": 10.0, "F&B": 8.0}
UNKNOWN_SLA_HOURS = 4.0
UNKNOWN_CAPACITY = 8.0
DEPARTMENTS = ("Reception", "Housekeeping", "F&B")
URGENT_BANDS = ("URGENT", "HIGH")
RESPONSE_SLOPE, HIT_SLOPE, URGENT_SLOPE = 1.75, 0.55, 0.12


def sla_load(
    df: DataFrame,
    window_hours: float = 8,
    sla_hours: Mapping[str, float] | None = None,
    capacity_per_hour: Mapping[str, float] | None = None,
    departments: Sequence[str] = DEPARTMENTS,
    by: Sequence[str] = (),
    department: str = "pred_department",
    urgent: Column | None = None,
    rounded: bool = True,
) -> DataFrame:
    """Volume, backlog, expected response and service-level hit rate per department.

    One aggregation with map-side combine; a department holding most rows still
    leaves every task as a single row. Departments without rows are kept.
    ``rounded=False`` returns the rates unrounded.
    """
    sla_hours = SLA_HOURS if sla_hours is None else sla_hours
    capacity_per_hour = CAPACITY_PER_HOUR if capacity_per_hour is None else capacity_per_hour
    urgent = col("priority").isin(*URGENT_BANDS) if urgent is None else urgent
    # One count per wanted department instead of a filter and a join: a filter on the
    # computed department would be pushed into the scoring projections and evaluate
    # them a second time. The department list is a short parameter.
    here = [col(department) == F.lit(d) for d in departments]
    counts = df.groupBy(*[col(b) for b in by]).agg(*[
        c for i, h in enumerate(here)
        for c in (F.count_if(h).alias(f"_v{i}"), F.count_if(h & urgent).alias(f"_u{i}"))
    ])
    out = counts.select(*[col(b) for b in by], F.inline(F.array(*[
        F.struct(F.lit(d).alias("department"), F.col(f"_v{i}").alias("volume"), F.col(f"_u{i}").alias("urgent"))
        for i, d in enumerate(departments)
    ])))

    name = col("department")
    out = out.withColumns({
        "sla_target_hours": map_lookup(name, sla_hours, UNKNOWN_SLA_HOURS),
        "_cap": map_lookup(name, capacity_per_hour, UNKNOWN_CAPACITY) * lit_d(window_hours),
    })
    volume, cap = F.col("volume"), F.col("_cap")
    out = out.withColumns({
        "window_hours": F.lit(int(window_hours)),
        "capacity_tickets": cap.cast("long"),
        "_over": F.greatest(F.when(cap > 0, volume / cap).otherwise(lit_d(1.0)) - lit_d(1.0), lit_d(0.0)),
        "_share": F.when(volume > 0, F.col("urgent") / volume).otherwise(lit_d(0.0)),
    })
    over = F.col("_over")
    response = F.col("sla_target_hours") * (lit_d(1.0) + over * lit_d(RESPONSE_SLOPE))
    hit = clip(lit_d(1.0) - over * lit_d(HIT_SLOPE) - F.col("_share") * lit_d(URGENT_SLOPE), 0.0, 1.0)
    return out.select(
        *[col(b) for b in by], "department", "volume", "window_hours", "capacity_tickets",
        F.greatest(volume - F.col("capacity_tickets"), F.lit(0)).alias("backlog_estimated"),
        "sla_target_hours",
        (F.bround(response, 2) if rounded else response).alias("estimated_avg_response_hours"),
        (F.bround(hit, 3) if rounded else hit).alias("estimated_sla_hit_rate"),
    )


def value_share(df: DataFrame, value: str = "priority", by: Sequence[str] = ()) -> DataFrame:
    """Normalised value counts; values that do not occur are absent."""
    counts = df.groupBy(*by, value).agg(F.count("*").alias("rows"))
    if by:
        # a window, not a join: null groups stay
        out = counts.withColumn("share", F.col("rows") / F.sum("rows").over(Window.partitionBy(*by)))
    else:
        out = counts.withColumn("share", F.col("rows") / counts.agg(F.sum("rows")).scalar())
    return out.select(*by, value, "rows", "share")


def coverage(df: DataFrame, flag: str = "needs_review_diag", by: Sequence[str] = (), enabled: bool = True) -> DataFrame:
    """Automation coverage and review rate; null when diagnostics are off, 0 without rows."""
    rate = F.avg(col(flag).cast("double"))
    agg = df.groupBy(*by).agg(F.count("*").alias("rows"), rate.alias("_rate"))
    if not enabled:
        return agg.select(*by, "rows", *[F.lit(None).cast("double").alias(n) for n in ("coverage", "needs_review_rate")])
    return agg.select(
        *by, "rows",
        F.coalesce(lit_d(1.0) - F.col("_rate"), lit_d(0.0)).alias("coverage"),
        F.coalesce(F.col("_rate"), lit_d(0.0)).alias("needs_review_rate"),
    )


def flag_rate(df: DataFrame, flag: str, out: str) -> DataFrame:
    return df.agg(F.avg(col(flag).cast("double")).alias(out))


def batch_kpis(df: DataFrame) -> DataFrame:
    """One row of headline figures of a scored batch; absent columns give no figure."""
    n = F.greatest(F.count("*"), F.lit(1))
    figures = [
        F.count("*").alias("rows"),
        F.count_if(col("priority").isin(*URGENT_BANDS)).alias("high_priority_rows"),
        (F.count_if(col("priority").isin(*URGENT_BANDS)) / n).alias("high_priority_share"),
        F.avg("risk_score").alias("mean_risk"),
    ]
    for flag, name in (
        ("sentiment_guardrail_applied", "guardrail"),
        ("sentiment_hazard_flag", "hazard"),
        ("needs_review_diag", "review"),
    ):
        if flag in df.columns:
            figures += [
                F.count_if(col(flag)).alias(f"{name}_rows"),
                (F.count_if(col(flag)) / n).alias(f"{name}_share"),
            ]
    if "department_conformal_size" in df.columns:
        figures.append(F.avg("department_conformal_size").alias("mean_conformal_size"))
    return df.agg(*figures)


def dataset_profile(df: DataFrame, dimensions: Sequence[str]) -> DataFrame:
    """Row count and class counts per label column, as (dimension, value, rows), in one pass.

    Each row is turned into its (dimension, value) facts, which are combined
    inside the task before the shuffle.
    """
    facts = F.array(
        F.struct(F.lit("rows").alias("dimension"), F.lit("all").alias("value")),
        *[F.struct(F.lit(d).alias("dimension"), col(d).cast("string").alias("value")) for d in dimensions],
    )
    return df.select(F.inline(facts)).groupBy("dimension", "value").agg(F.count("*").alias("rows"))
