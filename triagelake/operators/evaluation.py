"""Classification, calibration and operational metrics.

``evaluation_facts`` reads a scored table once and reduces it to a few counters
per section; the metric functions work on those counters. The single metric
operators below it do the same for one metric.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.base import argmax_label, col, lit_d, prefixed_classes, row_max, same_keys, total
from ..sources.materialise import materialise
from .scoring import proba_column

# Fixed value
CALIBRATION_BINS = 15


def confusion_counts(df: DataFrame, truth: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """(by..., truth, prediction, n) for pairs that occur."""
    return df.groupBy(
        *[col(b) for b in by], col(truth).cast("string").alias("truth"), col(prediction).cast("string").alias("prediction")
    ).agg(F.count("*").alias("n"))


def confusion_matrix(df: DataFrame, truth: str, prediction: str, classes: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Square matrix as one row per true class and one column per predicted class, zeros kept."""
    known = col(truth).isin(*classes)
    names = F.explode(F.array(*[F.lit(c) for c in classes])).alias("truth")
    cells = df.filter(known).groupBy(*[col(b) for b in by], col(truth).alias("truth")).agg(
        *[F.count_if(col(prediction) == c).alias(c) for c in classes]
    )
    if by:
        spine = df.select(*[col(b) for b in by]).distinct().select(*[col(b) for b in by], names)
    else:
        spine = df.sparkSession.range(1).select(names)
    return same_keys(spine, cells, [*by, "truth"], "left").fillna(0, list(classes))


def class_report(counts: DataFrame, by: Sequence[str] = (), labels: Sequence[str] | None = None) -> DataFrame:
    """Per-class precision, recall, F1, support from confusion counts; 0 where undefined.

    Classes are all that occur as truth or as prediction, or ``labels``.
    """
    hit = F.when(F.col("truth") == F.col("prediction"), F.col("n")).otherwise(F.lit(0))
    zero = F.lit(0).cast("long")
    sides = F.array(
        F.struct(F.col("truth").alias("class"), hit.cast("long").alias("tp"), F.col("n").alias("support"), zero.alias("predicted")),
        F.struct(F.col("prediction").alias("class"), zero.alias("tp"), zero.alias("support"), F.col("n").alias("predicted")),
    )
    sums = counts.select(*[col(b) for b in by], F.inline(sides)).groupBy(*by, "class").agg(
        *[F.sum(c).alias(c) for c in ("tp", "support", "predicted")]
    )
    if labels is not None:
        names = F.explode(F.array(*[F.lit(c) for c in labels])).alias("class")
        if by:
            spine = counts.select(*[col(b) for b in by]).distinct().select(*[col(b) for b in by], names)
        else:
            spine = counts.sparkSession.range(1).select(names)
        sums = same_keys(spine, sums, [*by, "class"], "left").fillna(0, ["tp", "support", "predicted"])
    else:
        sums = sums.filter(F.col("class").isNotNull())

    def ratio(a: Column, b: Column) -> Column:
        return F.when(b > 0, a / b).otherwise(lit_d(0.0))

    tp, support, predicted = F.col("tp"), F.col("support"), F.col("predicted")
    return sums.select(
        *by, "class",
        ratio(tp, predicted).alias("precision"),
        ratio(tp, support).alias("recall"),
        ratio(lit_d(2.0) * tp, support + predicted).alias("f1"),
        "support", "tp",
    )


def report_summary(report: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy, macro and support-weighted averages of a class report."""
    all_rows = F.sum("support")

    def weighted(name: str) -> Column:
        return F.when(all_rows > 0, F.sum(F.col(name) * F.col("support")) / all_rows).otherwise(lit_d(0.0))

    return report.groupBy(*by).agg(
        all_rows.alias("rows"),
        F.when(all_rows > 0, F.sum("tp") / all_rows).otherwise(lit_d(0.0)).alias("accuracy"),
        *[F.avg(m).alias(f"macro_{m}") for m in ("precision", "recall", "f1")],
        *[weighted(m).alias(f"weighted_{m}") for m in ("precision", "recall", "f1")],
    )


def calibration_bin(confidence: Column, bins: int = CALIBRATION_BINS) -> Column:
    """Equal-width bin 0..bins-1; bins are closed below, the last one also above.

    The edges are ``b * (1 / bins)`` in double arithmetic; a confidence on the
    wrong side of such an edge after the division is moved over.
    """
    step = 1.0 / bins
    guess = F.least(F.floor(confidence * lit_d(bins)), F.lit(bins - 1))
    return (
        F.when(confidence < guess.cast("double") * lit_d(step), guess - 1)
        .when((guess < bins - 1) & (confidence >= (guess + 1).cast("double") * lit_d(step)), guess + 1)
        .otherwise(guess)
        .cast("int")
    )


def raw_prediction(df: DataFrame, task: str) -> tuple[Column, Column]:
    """Class and confidence from the probability columns alone."""
    classes = sorted(prefixed_classes(df, f"proba_{task}_"))
    probs = [col(proba_column(task, c)) for c in classes]
    return argmax_label(classes, probs), row_max(probs)


def calibration_table(df: DataFrame, task: str, truth: str, by: Sequence[str] = (), bins: int = CALIBRATION_BINS) -> DataFrame:
    """(by..., bin, n, accuracy, confidence) for occupied bins."""
    label, confidence = raw_prediction(df, task)
    rows = df.select(
        *[col(b) for b in by], calibration_bin(confidence, bins).alias("bin"),
        F.coalesce(label == col(truth), F.lit(False)).cast("double").alias("_hit"), confidence.alias("_conf"),
    )
    return rows.groupBy(*by, "bin").agg(
        F.count("*").alias("n"), F.avg("_hit").alias("accuracy"), F.avg("_conf").alias("confidence")
    )


def expected_calibration_error(table: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    gap = F.abs(F.col("accuracy") - F.col("confidence")) * F.col("n")
    return table.groupBy(*by).agg(F.coalesce(F.sum(gap) / F.sum("n"), lit_d(0.0)).alias("ece"))


def brier_row(df: DataFrame, task: str, truth: str) -> Column:
    """Squared distance to the one-hot truth; an unknown truth is all zeros."""
    terms = []
    for c in prefixed_classes(df, f"proba_{task}_"):
        is_true = F.coalesce(col(truth) == c, F.lit(False)).cast("double")
        gap = col(proba_column(task, c)) - is_true
        terms.append(gap * gap)
    return total(terms)


def brier_score(df: DataFrame, task: str, truth: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(F.avg(brier_row(df, task, truth)).alias("brier"))


def evaluation_facts(
    df: DataFrame, tasks: dict[str, str], by: Sequence[str] = ("section",), review: str | None = "needs_review_diag",
    priority: str | None = "priority", conformal: tuple[str, str] | None = None,
) -> DataFrame:
    """Everything the section report needs, in one pass and one small shuffle.

    ``tasks`` maps task to truth column; ``conformal`` is (truth, set column).
    Each row becomes a handful of facts (kind, task, a, b, x, y) that are
    combined inside the task. Confusion uses the final predictions, calibration
    the ``raw_*`` probability columns when present (before the guardrail), else
    the current ones.
    """
    null = F.lit(None).cast("string")

    def fact(kind: str, task: str | None = None, a=None, b=None, x=None, y=None) -> Column:
        return F.struct(
            F.lit(kind).alias("kind"), F.lit(task).cast("string").alias("task"),
            (null if a is None else a.cast("string")).alias("a"), (null if b is None else b.cast("string")).alias("b"),
            (lit_d(0.0) if x is None else x.cast("double")).alias("x"),
            (lit_d(0.0) if y is None else y.cast("double")).alias("y"),
        )

    facts = [fact("rows")]
    for task, truth in tasks.items():
        facts.append(fact("pair", task, col(truth), col(f"pred_{task}")))
        source = f"raw_{task}" if prefixed_classes(df, f"proba_raw_{task}_") else task
        label, confidence = raw_prediction(df, source)
        hit = F.coalesce(label == col(truth), F.lit(False))
        facts.append(fact("bin", task, calibration_bin(confidence), None, hit, confidence))
        facts.append(fact("brier", task, x=brier_row(df, source, truth)))
    if review is not None and review in df.columns:
        facts.append(fact("review", x=col(review)))
    if priority is not None and priority in df.columns:
        facts.append(fact("priority", a=col(priority)))
    if conformal is not None:
        truth, members = conformal
        facts.append(fact("conformal", x=F.array_contains(col(members), col(truth)), y=F.size(col(members))))
    return df.select(*[col(b) for b in by], F.inline(F.array(*facts))).groupBy(*by, "kind", "task", "a", "b").agg(
        F.count("*").alias("n"), F.sum("x").alias("x"), F.sum("y").alias("y")
    )


def section_metrics(facts: DataFrame, by: Sequence[str] = ("section",)) -> DataFrame:
    """Long metrics (by..., task, class, metric, value) from evaluation facts."""
    by = list(by)
    facts = materialise(facts)  # a few counters, read by every metric below

    def kind(name: str) -> DataFrame:
        return facts.filter(F.col("kind") == name)

    def long(df: DataFrame, names: Sequence[str], cls: str | None = None, task: bool = True) -> DataFrame:
        pairs = F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("value")) for n in names])
        return df.select(
            *by, (F.col("task") if task else F.lit(None).cast("string")).alias("task"),
            (F.col(cls) if cls else F.lit(None).cast("string")).alias("class"), F.inline(pairs),
        )

    pairs = kind("pair").select(*by, "task", F.col("a").alias("truth"), F.col("b").alias("prediction"), "n")
    keys = [*by, "task"]
    report = class_report(pairs, keys)
    summary = report_summary(report, keys).withColumn("f1_macro", F.col("macro_f1"))
    bins = kind("bin").select(
        *keys, "n", (F.col("x") / F.col("n")).alias("accuracy"), (F.col("y") / F.col("n")).alias("confidence")
    )
    parts = [
        long(kind("rows").withColumn("rows", F.col("n")), ["rows"], task=False),
        long(report, ["precision", "recall", "f1", "support"], "class"),
        long(summary, ["accuracy", "f1_macro"]),
        long(expected_calibration_error(bins, keys), ["ece"]),
        long(kind("brier").withColumn("brier", F.col("x") / F.col("n")), ["brier"]),
        long(
            kind("review").withColumns({
                "needs_review_rate": F.col("x") / F.col("n"), "coverage": lit_d(1.0) - F.col("x") / F.col("n"),
            }), ["coverage", "needs_review_rate"], task=False,
        ),
        long(
            kind("conformal").withColumns({
                "conformal_coverage": F.col("x") / F.col("n"), "avg_set_size": F.col("y") / F.col("n"),
            }), ["conformal_coverage", "avg_set_size"], task=False,
        ),
    ]
    shares = kind("priority").select(*by, F.col("a").alias("class"), "n")
    totals = shares.groupBy(*by).agg(F.sum("n").alias("_all"))
    with_total = shares.join(totals, by) if by else shares.withColumn("_all", shares.agg(F.sum("n")).scalar())
    parts.append(long(
        with_total.withColumn("priority_share", F.col("n") / F.col("_all")), ["priority_share"], "class", task=False
    ))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def metric_summary(runs: DataFrame, metrics: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Mean, population deviation, min and max of each metric over runs: (by..., metric, mean, std, min, max, runs)."""
    pairs = F.array(*[F.struct(F.lit(m).alias("metric"), col(m).cast("double").alias("_v")) for m in metrics])
    return runs.select(*[col(b) for b in by], F.inline(pairs)).groupBy(*by, "metric").agg(
        F.avg("_v").alias("mean"), F.stddev_pop("_v").alias("std"), F.min("_v").alias("min"), F.max("_v").alias("max"),
        F.count("_v").alias("runs"),
    )


def fold_summary(folds: DataFrame, metric: str, fold: str = "fold", by: Sequence[str] = ()) -> DataFrame:
    """Cross-validation summary with the fold values in fold order; one value per fold."""
    values = F.transform(
        F.array_sort(F.collect_list(F.struct(col(fold).alias("f"), col(metric).alias("v")))), lambda s: s["v"]
    )
    return folds.groupBy(*by).agg(
        F.avg(col(metric)).alias("mean"), F.stddev_pop(col(metric)).alias("std"), values.alias("folds")
    )


def best_calibration(results: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Method with the lowest (ece, brier, -accuracy)."""
    order = F.struct(F.col("ece"), F.col("brier"), (-F.col("accuracy")).alias("worse"), F.col("method"))
    return results.groupBy(*by).agg(F.min_by("method", order).alias("method"))
