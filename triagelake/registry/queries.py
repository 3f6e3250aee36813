"""Queries over the given tables, one or more per operator."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.base import col
from ..functions.lexicon import (
    department_profile, lexicon_scores, lexicon_scores_by_join, lexicon_table, negated, sentinel_text, unmatched_words,
)
from ..functions.text import clean_text, merge_title_body, safe_text, tokens
from ..operators import (
    active, comparison, conformal, evaluation, generate, linear, models, novelty, rollups, splits, tfidf,
)
from ..operators.guardrail import apply_guardrail
from ..operators.presentation import presentation_view
from ..operators.ranking import quantiles
from ..operators.risk import apply_operational_fields, below_threshold
from ..operators.routing import impacted_departments
from ..operators.scoring import align_probabilities
from ..operators.thresholds import class_thresholds
from ..plans import driver_tables as given
from ..plans.batch import score_reviews
from ..sources.documents import normalise_thresholds
from ..sources.materialise import materialise, new_folder
from ..streaming import load

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def r6(df: DataFrame, *names: str) -> DataFrame:
    """Round to six places for comparison across engines."""
    return df.withColumns({n: F.round(col(n), 6) for n in names})


# --- text and lexicon --------------------------------------------------------

@query
def text_normalize(spark, sf):
    return given.texts(spark, sf).select("id", "text")


@query
def title_body_merge(spark, sf):
    return given.reviews(spark, sf).select("id", merge_title_body(F.col("title"), F.col("body")).alias("merged"))


@query
def text_safe(spark, sf):
    d = given.reviews(spark, sf)
    return d.select("id", safe_text(F.col("body")).alias("line"))


@query
def sentinel_tokens(spark, sf):
    d = given.reviews(spark, sf)
    return d.select("id", sentinel_text(safe_text(F.col("body"))).alias("enriched"))


@query
def lexicon_polarity(spark, sf):
    out = lexicon_scores(given.texts(spark, sf), given.LEXICONS, clean=True)
    return out.select("id", "negative_score", "hazard_score", "positive_score")


@query
def lexicon_by_join(spark, sf):
    lex = given.LEXICONS
    return lexicon_scores_by_join(given.texts(spark, sf), lexicon_table(spark, lex), lex.negators)


@query
def lexicon_unmatched(spark, sf):
    return unmatched_words(given.texts(spark, sf), lexicon_table(spark, given.LEXICONS))


@query
def negation_window(spark, sf):
    lex = given.LEXICONS
    cues = sorted({c for s in lex.polarity().values() for c in s.cues})
    d = given.texts(spark, sf).select("id", tokens(F.col("text")).alias("w"))
    all_cues = F.filter("w", lambda x: x.isin(*cues))
    kept = F.filter("w", lambda x, i: x.isin(*cues) & ~negated(F.col("w"), i, lex.negators))
    return d.select("id", F.size(all_cues).alias("cues"), (F.size(all_cues) - F.size(kept)).alias("negated"))


@query
def dept_cue_profile(spark, sf):
    out = department_profile(given.texts(spark, sf), given.LEXICONS, clean=True)
    return out.select(
        "id", *[col(f"cue_score_{n}").alias(f"score_{k}") for n, k in KEYS.items()],
        *[F.concat_ws(",", col(f"cue_match_{n}")).alias(f"match_{k}") for n, k in KEYS.items()],
    )


KEYS = {"Reception": "rec", "Housekeeping": "hk", "F&B": "fb"}


# --- runtime layer -----------------------------------------------------------

@query
def scored_predictions(spark, sf):
    out = given.scored_texts(spark, sf)
    out = align_probabilities(out, "department", ["Reception", "Housekeeping", "F&B"], "p")
    out = out.select(
        "id", "pred_department", "pred_sentiment", "department_confidence", "sentiment_confidence",
        F.col("p")[0].alias("p_rec"), F.col("p")[1].alias("p_hk"), F.col("p")[2].alias("p_fb"),
    )
    return r6(out, "department_confidence", "sentiment_confidence", "p_rec", "p_hk", "p_fb")


@query
def guardrail_override(spark, sf):
    out = apply_guardrail(given.scored_texts(spark, sf, cues=True), given.LEXICONS)
    return r6(out.select(
        "id", "pred_sentiment", "proba_sentiment_neg", "proba_sentiment_pos", "sentiment_confidence",
        "sentiment_guardrail_applied", "sentiment_guardrail_score", "sentiment_hazard_score", "sentiment_hazard_flag",
        "sentiment_guardrail_reason",
    ), "proba_sentiment_neg", "proba_sentiment_pos", "sentiment_confidence")


@query
def impacted_department_lists(spark, sf):
    out = impacted_departments(given.scored_texts(spark, sf, cues=True), given.LEXICONS)
    return out.select(
        "id", "impacted_departments", "impacted_departments_count", "impacted_departments_reason", "cross_department_signal"
    )


@query
def review_flags(spark, sf):
    d = given.scored_reviews(spark, sf)
    return d.select("id", "needs_review_diag")


@query
def review_flags_from_table(spark, sf):
    """Thresholds held in a table built from the data: one per language, plus a default."""
    d = given.scored_texts(spark, sf)
    per_class = d.groupBy(F.col("pred_department").alias("class")).agg(F.avg("department_confidence").alias("threshold"))
    flag = below_threshold(F.col("pred_department"), F.col("department_confidence"), per_class)
    return d.select("id", flag.alias("below"))


@query
def risk_priority(spark, sf):
    return r6(given.scored_reviews(spark, sf).select("id", "risk_score", "priority"), "risk_score")


@query
def risk_without_runtime_columns(spark, sf):
    """Review off, no guardrail and no routing columns: the fallback branches."""
    d = given.scored_texts(spark, sf).drop("proba_sentiment_neg", "proba_sentiment_pos")
    return r6(apply_operational_fields(d).select("id", "needs_review_diag", "risk_score", "priority"), "risk_score")


@query
def presentation_labels(spark, sf):
    d = given.scored_reviews(spark, sf).select(
        "id", "pred_department", "priority", "needs_review_diag", "sentiment_guardrail_applied", "impacted_departments",
        "impacted_departments_reason", F.round("proba_sentiment_neg", 6).alias("proba_sentiment_neg"),
    )
    return presentation_view(d)


# --- roll-ups ----------------------------------------------------------------

@query
def sla_rollup(spark, sf):
    return r6(
        rollups.sla_load(given.scored_reviews(spark, sf), rounded=False),
        "estimated_avg_response_hours", "estimated_sla_hit_rate",
    )


@query
def sla_rollup_orders(spark, sf):
    """Order statuses as departments: overloaded ones, and one without any volume."""
    out = rollups.sla_load(
        given.table(spark, sf, "orders").select("o_orderstatus", "o_orderpriority"),
        window_hours=400, sla_hours={"O": 2.0, "F": 4.0, "P": 6.0}, capacity_per_hour={"O": 14.0, "F": 10.0, "P": 8.0},
        departments=("O", "F", "P", "X"), department="o_orderstatus",
        urgent=F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), rounded=False,
    )
    return r6(out, "estimated_avg_response_hours", "estimated_sla_hit_rate")


@query
def sla_rollup_by_source(spark, sf):
    d = given.scored_reviews(spark, sf).select("source", "pred_department", "priority")
    out = rollups.sla_load(d, window_hours=1, by=["source"], rounded=False)
    return r6(out.select("source", "department", "volume", "backlog_estimated", "estimated_sla_hit_rate"), "estimated_sla_hit_rate")


@query
def priority_distribution(spark, sf):
    return r6(rollups.value_share(given.scored_reviews(spark, sf), "priority"), "share")


@query
def order_priority_distribution(spark, sf):
    d = given.table(spark, sf, "orders").select("o_orderstatus", "o_orderpriority")
    return r6(rollups.value_share(d, "o_orderpriority", by=["o_orderstatus"]), "share")


@query
def coverage_review_rate(spark, sf):
    out = rollups.coverage(given.scored_reviews(spark, sf), by=["lang"])
    return r6(out, "coverage", "needs_review_rate")


@query
def guardrail_rate(spark, sf):
    d = given.scored_reviews(spark, sf)
    return r6(rollups.flag_rate(d, "sentiment_guardrail_applied", "rate"), "rate")


@query
def batch_kpis(spark, sf):
    out = rollups.batch_kpis(given.scored_reviews(spark, sf))
    return r6(out, *[c for c in out.columns if c.endswith("_share")], "mean_risk")


@query
def dataset_profile(spark, sf):
    return rollups.dataset_profile(given.labelled_reviews(spark, sf), ["department", "sentiment"])


@query
def event_profile(spark, sf):
    return rollups.dataset_profile(given.table(spark, sf, "events").select("event_type"), ["event_type"])


# --- evaluation --------------------------------------------------------------

@query
def confusion_matrix(spark, sf):
    d = given.scored_labelled(spark, sf).select("true_department", "pred_department")
    out = evaluation.confusion_matrix(d, "true_department", "pred_department", ["F&B", "Housekeeping", "Reception"])
    return out.withColumnsRenamed({"F&B": "p_fb", "Housekeeping": "p_hk", "Reception": "p_rec"})


def _report(spark, sf):
    counts = evaluation.confusion_counts(given.scored_labelled(spark, sf), "true_department", "pred_department")
    return evaluation.class_report(counts)


@query
def classification_report(spark, sf):
    return r6(_report(spark, sf).select("class", "precision", "recall", "f1", "support"), "precision", "recall", "f1")


@query
def macro_f1(spark, sf):
    out = evaluation.report_summary(_report(spark, sf))
    names = ["accuracy", "macro_precision", "macro_recall", "macro_f1", "weighted_precision", "weighted_recall", "weighted_f1"]
    return r6(out.select("rows", *names), *names)


@query
def ece_bins(spark, sf):
    return r6(evaluation.calibration_table(given.route_scores(spark, sf), "route", "truth"), "accuracy", "confidence")


@query
def ece_brier(spark, sf):
    d = given.route_scores(spark, sf).withColumn("section", F.when(F.pmod("vec_id", F.lit(2)) == 0, "even").otherwise("odd"))
    bins = evaluation.calibration_table(d, "route", "truth", by=["section"])
    ece = evaluation.expected_calibration_error(bins, by=["section"])
    return r6(ece.join(evaluation.brier_score(d, "route", "truth", by=["section"]), "section"), "ece", "brier")


@query
def class_threshold_table(spark, sf):
    out = class_thresholds(given.route_scores(spark, sf), "route", "truth", [*given.ROUTE_CLASSES, "none"], floor=0.05)
    return r6(out, "threshold")


@query
def exact_quantiles(spark, sf):
    d = given.table(spark, sf, "orders").select(
        "o_orderstatus", (F.col("o_totalprice") / F.lit(600000.0)).alias("x")
    )
    return r6(quantiles(d, ["o_orderstatus"], "x", 0.08), "quantile")


@query
def threshold_map(spark, sf):
    """Usable thresholds for every language from a table with gaps and unreadable values."""
    d = given.table(spark, sf, "documents")
    classes = d.select(F.col("lang").alias("class")).distinct()
    raw = d.groupBy(F.col("lang").alias("class")).agg(F.avg("n_chars").alias("m"), F.count("*").alias("n"))
    share = F.round(F.col("n") / F.lit(1000.0), 6).cast("string")
    raw = raw.select("class", F.when(F.col("class") == "fr", "n/a").otherwise(share).alias("threshold"))
    return r6(normalise_thresholds(raw, classes, 0.55), "threshold")


@query
def section_eval(spark, sf):
    d = given.scored_labelled(spark, sf)
    facts = evaluation.evaluation_facts(d, {"department": "true_department", "sentiment": "true_sentiment"})
    out = evaluation.section_metrics(facts)
    return r6(out.fillna("", ["task", "class"]), "value")


def _run_metrics(d: DataFrame, tasks=None) -> DataFrame:
    tasks = tasks or {"department": "true_department", "sentiment": "true_sentiment"}
    return evaluation.section_metrics(evaluation.evaluation_facts(d, tasks))


@query
def metric_delta(spark, sf):
    """The run without the guardrail (before) against the one with it (after)."""
    after = given.scored_labelled(spark, sf)
    raw_neg, raw_pos = col("proba_raw_sentiment_neg"), col("proba_raw_sentiment_pos")
    before = after.withColumn("pred_sentiment", F.when(raw_neg >= raw_pos, "neg").otherwise("pos"))
    out = comparison.safety_report(_run_metrics(before), _run_metrics(after), ["quality", "other", "absent"])
    out = out.withColumn("delta_pp", comparison.percentage_points(F.col("delta")))
    return r6(out, "before", "after", "delta", "delta_pp")


@query
def advanced_delta(spark, sf):
    after = given.scored_labelled(spark, sf)
    raw_neg, raw_pos = col("proba_raw_sentiment_neg"), col("proba_raw_sentiment_pos")
    before = after.withColumn("pred_sentiment", F.when(raw_neg >= raw_pos, "neg").otherwise("pos"))
    base = _run_metrics(before).filter("metric <> 'ece'")
    out = comparison.advanced_delta(base, _run_metrics(after))
    return r6(out, *[c for c in out.columns if c != "section"])


@query
def model_compare(spark, sf):
    """Words-only sentiment against the same with the guardrail, per quality section."""
    d = given.scored_labelled(spark, sf)
    raw = F.when(col("proba_raw_sentiment_neg") >= col("proba_raw_sentiment_pos"), "neg").otherwise("pos")
    both = F.array(
        F.struct(F.lit("plain").alias("model"), raw.alias("pred")),
        F.struct(F.lit("guarded").alias("model"), F.col("pred_sentiment").alias("pred")),
    )
    rows = d.select("section", F.col("true_sentiment").alias("truth"), F.inline(both))
    counts = evaluation.confusion_counts(rows, "truth", "pred", by=["section", "model"])
    report = evaluation.class_report(counts, ["section", "model"])
    summary = evaluation.report_summary(report, ["section", "model"])
    metrics = summary.select(
        "section", F.lit("sentiment").alias("task"), "model", F.lit("f1_macro").alias("metric"), F.col("macro_f1").alias("value")
    )
    return r6(comparison.model_comparison(metrics, ("plain", "guarded")), "plain", "guarded", "delta")


@query
def run_summary(spark, sf):
    """Every document source as a run: macro-F1 on its two quality sections."""
    d = given.scored_labelled(spark, sf)
    facts = evaluation.evaluation_facts(
        d, {"department": "true_department", "sentiment": "true_sentiment"}, by=["source", "section"]
    )
    metrics = evaluation.section_metrics(facts, ["source", "section"])
    out = comparison.run_summary(metrics, "source", test="quality", safety="other")
    return r6(out, *[c for c in out.columns if c != "source"])


@query
def seed_summary(spark, sf):
    """Accuracy of the centroid scores on five seeded 20 % hold-outs, summarised."""
    d = given.route_scores(spark, sf).select("vec_id", "truth", (F.col("pred_route") == F.col("truth")).alias("ok"))
    runs = None
    for seed in (13, 21, 34, 42, 55):
        held = splits.stratified_split(d, F.col("truth"), 0.20, seed, "vec_id").filter("is_test")
        run = held.agg(F.lit(seed).alias("seed"), F.avg(F.col("ok").cast("double")).alias("accuracy"))
        runs = run if runs is None else runs.unionByName(run)
    return r6(evaluation.metric_summary(runs, ["accuracy"]), "mean", "std", "min", "max")


@query
def fold_summary(spark, sf):
    d = given.route_scores(spark, sf).select("vec_id", "truth", (F.col("pred_route") == F.col("truth")).alias("ok"))
    folds = splits.stratified_folds(d, F.col("truth"), 5, 42, "vec_id").groupBy("fold").agg(
        F.round(F.avg(F.col("ok").cast("double")), 6).alias("accuracy")
    )
    out = evaluation.fold_summary(folds, "accuracy")
    return r6(out.withColumn("folds", F.array_join(F.transform("folds", lambda v: F.format_number(v, 6)), ",")), "mean", "std")


@query
def calibration_choice(spark, sf):
    """Which of two temperings of the centroid scores is calibrated best."""
    d = given.route_scores(spark, sf)
    results = None
    for name, power in (("plain", 1.0), ("sharp", 2.0)):
        powered = {c: F.pow(col(f"proba_route_{c}"), F.lit(power)) for c in given.ROUTE_CLASSES}
        t = d.select("vec_id", "truth", *[p.alias(f"_q{c}") for c, p in powered.items()])
        norm = sum((F.col(f"_q{c}") for c in given.ROUTE_CLASSES[1:]), F.col(f"_q{given.ROUTE_CLASSES[0]}"))
        t = t.select("vec_id", "truth", *[(F.col(f"_q{c}") / norm).alias(f"proba_route_{c}") for c in given.ROUTE_CLASSES])
        label, _ = evaluation.raw_prediction(t, "route")
        bins = evaluation.calibration_table(t, "route", "truth").withColumn("method", F.lit(name))
        ece = evaluation.expected_calibration_error(bins, ["method"])
        brier = evaluation.brier_score(t, "route", "truth").withColumn("method", F.lit(name))
        acc = t.agg(F.avg((label == F.col("truth")).cast("double")).alias("accuracy")).withColumn("method", F.lit(name))
        one = ece.join(brier, "method").join(acc, "method")
        results = one if results is None else results.unionByName(one)
    chosen = evaluation.best_calibration(results).withColumnRenamed("method", "chosen")
    out = results.withColumn("chosen", F.col("method") == chosen.scalar())
    return r6(out, "ece", "brier", "accuracy")


# --- conformal ---------------------------------------------------------------

@query
def conformal_scores(spark, sf):
    d = given.route_scores(spark, sf)
    out = conformal.conformal_scores(d, "route", "truth", given.ROUTE_CLASSES)
    out = conformal.conformal_scores(out, "route", "truth", given.ROUTE_CLASSES, "threshold", "threshold_score")
    return r6(out.select("vec_id", "conformal_score", "threshold_score"), "conformal_score", "threshold_score")


@query
def conformal_qhat(spark, sf):
    d = given.route_scores(spark, sf)
    parts = [conformal.conformal_fit(d, "route", "truth", given.ROUTE_CLASSES, method=m) for m in conformal.METHODS]
    return r6(parts[0].unionByName(parts[1]), "qhat", "threshold")


def _sets(spark, sf, method):
    d = given.route_scores(spark, sf)
    fitted = conformal.conformal_fit(d, "route", "truth", given.ROUTE_CLASSES, method=method)
    return conformal.conformal_sets(d, fitted, "route", given.ROUTE_CLASSES, method)


@query
def conformal_sets_aps(spark, sf):
    out = _sets(spark, sf, "aps")
    return out.select("vec_id", F.concat_ws("|", "route_conformal_set").alias("members"), "route_conformal_size")


@query
def conformal_sets_threshold(spark, sf):
    out = _sets(spark, sf, "threshold")
    return out.select("vec_id", F.concat_ws("|", "route_conformal_set").alias("members"), "route_conformal_size")


@query
def conformal_eval(spark, sf):
    out = conformal.conformal_evaluation(_sets(spark, sf, "aps"), "truth", "route_conformal_set", by=["truth"])
    return r6(out, "coverage", "avg_set_size")


# --- splits and set operations -------------------------------------------------

STRATUM = splits.joint_stratum


@query
def stratified_split(spark, sf):
    d = given.labelled_reviews(spark, sf).select("id", "department", "sentiment")
    return splits.stratified_split(d, STRATUM("department", "sentiment")).select("id", "is_test")


@query
def stratified_split_orders(spark, sf):
    d = given.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    out = splits.stratified_split(d, STRATUM("o_orderstatus", "o_orderpriority"), 0.2, 7, "o_orderkey")
    return out.filter("is_test").select("o_orderkey")


@query
def three_way_split(spark, sf):
    d = given.labelled_reviews(spark, sf).select("id", "department", "sentiment")
    return splits.three_way_split(d, STRATUM("department", "sentiment")).select("id", "split")


@query
def stratified_kfold(spark, sf):
    d = given.labelled_reviews(spark, sf).select("id", "department", "sentiment")
    return splits.stratified_folds(d, STRATUM("department", "sentiment"), 5).select("id", "fold")


@query
def stratified_kfold_lineitem(spark, sf):
    d = given.table(spark, sf, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("k"), "l_returnflag"
    )
    return splits.stratified_folds(d, F.col("l_returnflag"), 5, 3, "k").select("k", "fold")


@query
def largest_remainder_quota(spark, sf):
    d = given.labelled_reviews(spark, sf)
    counts = d.groupBy("department", "sentiment").agg(F.count("*").alias("rows"))
    out = splits.largest_remainder(counts, 50, ["department", "sentiment"])
    return r6(out.select("department", "sentiment", "rows", "quota_raw", "quota"), "quota_raw")


@query
def replay_sample(spark, sf):
    d = given.labelled_reviews(spark, sf).select("id", "department", "sentiment")
    return splits.replay_sample(d, 50).select("id", "department", "sentiment")


@query
def augment_union(spark, sf):
    d = given.labelled_reviews(spark, sf)
    extra = d.filter(F.col("sentiment") == "neg")
    return splits.augment_union(d, extra, 2).select("copy", "id", "department", "sentiment")


@query
def labelled_queue_rows(spark, sf):
    """Messages as a queue: the role is the label, a blank second label drops the row."""
    c = given.table(spark, sf, "conversations")
    queue = c.select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("id"), F.lit("").alias("title"), F.col("text").alias("body"),
        F.col("role").alias("true_department"), F.when(F.col("turn") % 2 == 0, "  ").otherwise("neg").alias("true_sentiment"),
    )
    return splits.labelled_rows(queue).select("id", "true_department")


@query
def append_labeled(spark, sf):
    """Labelled reviews grown by a queue of all conversation turns and a replay sample."""
    base = given.labelled_reviews(spark, sf)
    c = given.table(spark, sf, "conversations")
    queue = c.select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("id"), F.lit("reply").alias("title"), F.col("text").alias("body"),
        F.lit("en").alias("true_department"), F.lit("pos").alias("true_sentiment"),
    )
    out = splits.append_labelled(base, queue, replay_size=40)
    return out.select("id", "origin", "department", "sentiment", "body")


# --- active learning -----------------------------------------------------------

@query
def tfidf_weights(spark, sf):
    """Word n-gram weights of the benchmark texts, sublinear, df limits on."""
    d = given.table(spark, sf, "benchmark").select("item_id", clean_text(F.col("text")).alias("text"))
    counts = tfidf.term_counts(d, ["item_id"], tfidf.terms_of(F.col("text"), "word", (1, 2)))
    vocab = tfidf.vocabulary(counts, d.agg(F.count("*")).scalar(), min_df=2, max_df=0.98)
    return r6(tfidf.tfidf_weights(counts, vocab, ["item_id"], sublinear=True), "weight")


@query
def tfidf_vocabulary(spark, sf):
    """Document and corpus frequencies of all word uni- and bigrams of the documents."""
    d = given.texts(spark, sf).select("id", "text")
    counts = tfidf.term_counts(tfidf.dealt(d, ["id"]), ["id"], tfidf.terms_of(F.col("text"), "word", (1, 2)))
    vocab = tfidf.vocabulary(counts, d.agg(F.count("*")).scalar())
    return r6(vocab, "idf")


@query
def char_ngrams(spark, sf):
    """Character n-gram counts over all documents."""
    d = given.texts(spark, sf).select("id", "text")
    counts = tfidf.char_counts(tfidf.dealt(d, ["id"], 512), ["id"], "text", (3, 5))
    return counts.groupBy("term").agg(F.sum("tf").alias("total_tf"), F.count("*").alias("df"))


def _pool_and_base(spark, sf):
    texts = given.texts(spark, sf).select("id", "text")
    labels = given.table(spark, sf, "labels").select(F.col("doc_id").alias("id"))
    return texts.join(labels, "id", "left_anti"), texts.join(labels, "id", "left_semi")


@query
def novelty_max_cosine(spark, sf):
    pool, base = _pool_and_base(spark, sf)
    return r6(novelty.novelty_scores(pool, base), "diversity_score")


@query
def operational_cost(spark, sf):
    d = given.scored_reviews(spark, sf)
    return r6(d.select("id", active.operational_cost().alias("business_cost_score")), "business_cost_score")


def _acquisition(spark, sf, strategy="hybrid_v2", with_novelty=True):
    d = given.scored_reviews(spark, sf)
    labels = given.table(spark, sf, "labels").select(F.col("doc_id").alias("id"))
    pool = d.join(labels, "id", "left_anti")
    scores = None
    if with_novelty:
        pool_texts, base_texts = _pool_and_base(spark, sf)
        scores = novelty.novelty_scores(pool_texts, base_texts)
    return active.acquisition_scores(pool, scores, strategy=strategy)


@query
def acquisition_queue(spark, sf):
    queue = active.labelling_queue(_acquisition(spark, sf))
    names = ["uncertainty_score", "diversity_score", "business_cost_score", "acquisition_score", "risk_score"]
    return r6(queue.select("id", "pred_department", "priority", "true_department", *names), *names)


@query
def acquisition_queue_uncertainty(spark, sf):
    queue = active.labelling_queue(_acquisition(spark, sf, "uncertainty_only", False), 40, only_flagged=True)
    return r6(queue.select("id", "acquisition_score", "needs_review_diag", "reviewer_notes"), "acquisition_score")


@query
def queue_means(spark, sf):
    out = active.queue_means(active.labelling_queue(_acquisition(spark, sf)))
    return r6(out, *[c for c in out.columns if c.startswith("mean_")])


# --- explanations ----------------------------------------------------------------

@query
def token_explanations(spark, sf):
    """Top words per review for a fixed linear model: log-odds of a word by language."""
    # each of the three passes over the texts would clean them again
    d = materialise(given.texts(spark, sf).select("id", F.coalesce("lang", F.lit("")).alias("lang"), "text"))
    source = linear.Features("word", (1, 1))
    counted = linear.count_rows(d, "lang", [source])
    sums = linear.class_sums(counted, source)
    coefs = np.round(sums - sums.sum(axis=1, keepdims=True) / 4.0, 6)
    number = F.array_position(F.array(*[F.lit(c) for c in counted.classes]), F.col("lang")).cast("int") - 1
    top = models.top_term_lists(d, counted.vocabulary[source.family], counted.scale(source, None), coefs, 5, digits=6)
    named = models.with_arrow(d, [source.terms(F.col("text")), source.hashed(F.col("text")), number], "top", models.TOP_TERMS, top, ["id", "lang"])
    ranked = named.filter("lang <> ''").select("id", F.posexplode("top").alias("place", "t"))
    return r6(ranked.select("id", (F.col("place") + 1).alias("rank"), "t.term", "t.contribution"), "contribution")


# --- generation and noise ----------------------------------------------------------

@query
def label_noise(spark, sf):
    """Order lines relabelled: department by line number, sentiment by return flag."""
    rows = given.table(spark, sf, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("id"),
        F.get(F.array(*[F.lit(d) for d in generate.DEPARTMENTS]), F.pmod("l_linenumber", F.lit(3)).cast("int")).alias("department"),
        F.when(F.col("l_returnflag") == "R", "neg").otherwise("pos").alias("sentiment"),
    )
    return generate.label_noise(rows, 42, "noisy").select("id", "department", "sentiment")


@query
def typo_noise(spark, sf):
    """Typos in the documents, with frequent words of theirs as the misspelt ones."""
    d = given.reviews(spark, sf).select("id", "body")
    return generate.typo_noise(d, 42, level=0.3, phrases=TYPO_PHRASES, words=TYPO_WORDS)


TYPO_PHRASES = (("of the", "ofthe"), ("de la", "dela"))
TYPO_WORDS = {"the": "teh", "with": "wiht", "les": "lse", "und": "udn"}


@query
def synthetic_reviews(spark, sf):
    """One review per order, profile of the noisy benchmark."""
    ids = given.table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"))
    return generate.synthetic_reviews(ids, 42, "noisy")


@query
def synthetic_safety_reviews(spark, sf):
    ids = given.table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"))
    return generate.safety_reviews(ids, 446)


@query
def synthetic_family_profile(spark, sf):
    """Label profile of the whole benchmark family, one row set per customer."""
    ids = given.table(spark, sf, "customer").select(F.col("c_custkey").alias("id"))
    family = generate.benchmark_family(ids)
    return family.groupBy("section", "department", "sentiment").agg(F.count("*").alias("rows"))


# --- trained models ------------------------------------------------------------------

def _training(spark, sf):
    """Labelled documents with text, split 60/20/20-like by label pair; the split reads the written rows, so texts are cleaned once."""
    return materialise(splits.three_way_split(_labelled_texts(spark, sf), splits.joint_stratum("department", "sentiment")))


@query
def train_eval_baseline(spark, sf):
    """Calibrated word model of the language label: fitted, tested."""
    d = _training(spark, sf)
    model = models.fit_calibrated(d.filter("split = 'train'"), "department", "department", models.Features("word", (1, 2), 2, 0.98))
    test = model.transform(d.filter("split = 'test'"))
    report = evaluation.class_report(evaluation.confusion_counts(test, "department", "pred_department"))
    return r6(report.select("class", "precision", "recall", "f1", "support"), "precision", "recall", "f1")


@query
def calibrated_scores(spark, sf):
    """Class probabilities of a calibrated character model of the toxic label on the test rows."""
    d = _training(spark, sf)
    model = models.fit_calibrated(
        d.filter("split = 'train'"), "sentiment", "sentiment", models.Features("char_wb", (3, 5), 1, 0.98),
        weights=models.SENTIMENT_CLASS_WEIGHTS["logistic"], enriched=True,
    )
    out = model.transform(d.filter("split = 'test'")).select("id", "pred_sentiment", "proba_sentiment_neg", "proba_sentiment_pos")
    return r6(out, "proba_sentiment_neg", "proba_sentiment_pos")


def _ensemble(spark, sf):
    d = _training(spark, sf)
    return d, models.fit_stacked(d.filter("split = 'train'"), d.filter("split = 'calibration'"), "department", "department")


@query
def stacked_ensemble(spark, sf):
    d, model = _ensemble(spark, sf)
    test = model.transform(d.filter("split = 'test'"))
    report = evaluation.class_report(evaluation.confusion_counts(test, "department", "pred_department"))
    return r6(report.select("class", "precision", "recall", "f1", "support"), "precision", "recall", "f1")


@query
def ensemble_batch_scores(spark, sf):
    """Batch prediction of every document with a fitted ensemble for one task and cue shares for the other.

    What must hold whatever was fitted: probabilities add up to 1, the prediction has the largest, the confidence is it.
    """
    _, model = _ensemble(spark, sf)

    def scorer(df):
        sentiment = ("proba_sentiment_neg", "proba_sentiment_pos", "pred_sentiment", "sentiment_confidence")
        return model.transform(given.cue_share_scorer(df).select(*df.columns, *sentiment))

    out = score_reviews(given.reviews(spark, sf), scorer, given.LEXICONS, {"default": 0.55}, given.SENTIMENT_THRESHOLDS, True)
    p = [col(f"proba_department_{c}") for c in model.classes]
    best = F.greatest(*p)
    return out.select(
        "id", F.round(sum(p[1:], p[0]), 6).alias("mass"), (F.col("department_confidence") == best).alias("confidence_is_largest"),
        (F.element_at(F.create_map(*[x for c, v in zip(model.classes, p) for x in (F.lit(c), v)]), F.col("pred_department")) == best).alias("prediction_is_largest"),
        (F.col("needs_review_diag") | (F.col("department_confidence") >= 0.55)).alias("doubtful_flagged"),
    )


@query
def embedding_classifier(spark, sf):
    """Calibrated logistic model on the given vectors, tested on a stratified hold-out."""
    e = given.table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("label").cast("string").alias("truth"), "embedding"
    )
    rows = materialise(splits.stratified_split(e, F.col("truth")))
    model = models.fit_calibrated(rows.filter(~F.col("is_test")), "route", "truth", linear.Dense("embedding"), c=1.0)
    out = model.transform(rows.filter("is_test")).select("id", "truth", "pred_route", "route_confidence")
    return r6(out, "route_confidence")


@query
def model_calibration_probe(spark, sf):
    """Sigmoid against isotonic for the toxic label."""
    d = _training(spark, sf)
    out = models.calibration_probe(d.filter("split = 'train'"), d.filter("split = 'calibration'"), "sentiment", "sentiment")
    return r6(out, "accuracy", "ece", "brier")


# --- refits: all folds, seeds and candidates in the same passes --------------------------

GRID = models.expand_grid("word", models.WORD_GRID)


def _labelled_texts(spark, sf):
    return materialise(given.prepare_text(given.labelled_reviews(spark, sf)).select("id", "text", "department", "sentiment"))


@query
def grid_search_report(spark, sf):
    """The word grid of the toxic label: 12 candidates on 3 folds, each with its 3 calibrated fold models."""
    out = models.grid_search(_labelled_texts(spark, sf), "sentiment", GRID, weights=models.SENTIMENT_CLASS_WEIGHTS["logistic"])
    return r6(out.drop("folds"), "mean", "std")


@query
def cross_validation_report(spark, sf):
    """Five folds with one candidate: every fold's macro-F1 and accuracy."""
    out = models.cross_validate(_labelled_texts(spark, sf), "department", models.Features("word", (1, 2), 2, 0.98), 1.2)
    return r6(out, "macro_f1", "accuracy")


@query
def multi_seed_report(spark, sf):
    """Five hold-outs with one candidate: mean, deviation, smallest and largest of each metric."""
    runs = models.multi_seed(_labelled_texts(spark, sf), "department", models.Features("word", (1, 2), 2, 0.98), 1.2)
    return r6(models.seed_report(runs), "mean", "std", "min", "max")


@query
def fold_masks(spark, sf):
    """Rows and document frequencies that each fold's feature space stands on, out of one count of the terms.

    (fold, rows, terms, occurrences): terms the space keeps with min_df 2 and max_df 0.98, and the documents holding them.
    """
    rows = models.with_folds(_labelled_texts(spark, sf), "department", 5, 42, "id", models.OUTER)
    source, masks = models.Features("word", (1, 2), 2, 0.98), [(models.OUTER, f) for f in range(5)]
    counted = linear.count_rows(rows, "department", [source], [models.OUTER], masks)
    out = [(m[1], *figures) for m, figures in zip(masks, counted.space_sizes(source, masks))]
    return spark.createDataFrame(out, "fold int, rows long, terms long, occurrences long")


# --- windowed load on events ---------------------------------------------------------------

#: Event types as departments: hours to respond, tickets an hour; signup has the values for unknown ones.
EVENT_LOAD = {
    "window_hours": 8, "departments": ["click", "error", "purchase", "signup", "view"], "department": "event_type",
    "sla_hours": {"click": 2.0, "error": 1.0, "purchase": 4.0, "view": 6.0}, "capacity_per_hour": {"click": 3.0, "error": 2.0, "purchase": 2.5, "view": 4.0},
    "rounded": False,
}
EVENT_DELAY = "60 minutes"


def _arrived():
    """Events say how many minutes late they arrived."""
    minutes = F.get_json_object("props", "$.k").cast("int")
    return F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), minutes, F.lit(0))


def _event_load():
    return {**EVENT_LOAD, "urgent": F.coalesce(F.col("value") > 30.0, F.lit(False))}


def _event_figures(df):
    return r6(df.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm")), "estimated_avg_response_hours", "estimated_sla_hit_rate")


@query
def windowed_load_events(spark, sf):
    events = given.table(spark, sf, "events")
    return _event_figures(load.windowed_load(load.on_time(events, "ts", _arrived(), EVENT_DELAY), "ts", **_event_load()))


@query
def windowed_load_stream(spark, sf):
    """The same from a stream over the whole table, read to its end."""
    stream, folder = given.table_stream(spark, sf, "events"), new_folder(spark)
    load.stream_windowed_load(stream, "ts", _arrived(), EVENT_DELAY, f"{folder}/load", f"{folder}/checkpoint", **_event_load()).awaitTermination()
    return _event_figures(load.read_windowed_load(spark, f"{folder}/load"))
