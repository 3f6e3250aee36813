import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from triagelake.operators import linear, models
from triagelake.operators.generate import benchmark_family, synthetic_reviews
from triagelake.functions.text import prepare_text
from triagelake.plans.batch import model_scorer, score_reviews
from triagelake.sources.models import load_model, save_model, versions, write_arrays
from triagelake.streaming.scoring import stream_scores


def test_synthetic_reviews_are_balanced_and_repeatable(spark):
    ids = spark.range(1, 301)
    one = synthetic_reviews(ids, 42, "colloquial")
    two = synthetic_reviews(ids.repartition(7), 42, "colloquial")
    assert one.exceptAll(two).count() == 0
    counts = [r["count"] for r in one.groupBy("department", "sentiment").count().collect()]
    assert counts == [50] * 6  # this profile flips no label
    assert one.filter("body is null or title is null or body like '%{%'").count() == 0
    sections = {r["section"]: r["count"] for r in benchmark_family(spark.range(1, 41)).groupBy("section").count().collect()}
    assert len(sections) == 5 and set(sections.values()) == {40}


def labelled(spark, n=180):
    return prepare_text(synthetic_reviews(spark.range(1, n + 1), 1, "colloquial")).select("id", "title", "body", "text", "department", "sentiment").cache()


def test_text_model_end_to_end(spark, tmp_path):
    rows = labelled(spark)
    model = models.fit_calibrated(rows, "department", "department", models.Features("word", (1, 2), 1, 0.98))
    model.extras = {"thresholds": {"default": 0.5}}
    scored = model.transform(rows).cache()
    total = sum((F.col(f"`proba_department_{c}`") for c in model.classes[1:]), F.col(f"`proba_department_{model.classes[0]}`"))
    assert scored.filter(F.abs(total - 1) > 1e-9).count() == 0
    assert models.macro_f1(scored, "department", "department") > 0.9
    path = str(tmp_path / "bundle")
    save_model(spark, model, path)
    again = load_model(spark, path)
    assert again.extras == model.extras
    both = scored.alias("a").join(again.transform(rows).alias("b"), "id")
    assert both.count() == 180 and both.filter(F.col("a.department_confidence") != F.col("b.department_confidence")).count() == 0
    # scoring is a projection
    plan = again.transform(rows)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Aggregate" not in plan
    coefs = model.coefficients(rows).cache()
    top = {r["class"]: r["term"] for r in coefs.groupBy("class").agg(F.max_by("term", "coef").alias("term")).collect()}
    assert set(top) == {"F&B", "Housekeeping", "Reception"}


def test_explanations_equal_a_join_of_weights_and_coefficients(spark):
    rows = labelled(spark, 60)
    model = models.fit_calibrated(rows, "department", "department", models.Features("word", (1, 2), 1, 0.98))
    scored = model.transform(rows).cache()
    got = {r["id"]: r["why"] for r in model.explain(scored, "why", 4).collect()}
    head = model.linear
    idf = {int(v): float(x) for v, x in zip(head.vocabulary, head.scale)}
    coef = {(r["class"], r["term"]): r["coef"] for r in model.coefficients(rows).collect()}
    terms = scored.select("id", "pred_department", head.source.terms(F.col("text")).alias("t"), head.source.hashed(F.col("text")).alias("h"))
    for r in terms.collect():
        counts, number = Counter(r["t"]), dict(zip(r["t"], r["h"]))
        length = math.sqrt(sum(((1 + math.log(n)) * idf.get(number[t], 0.0)) ** 2 for t, n in counts.items()))
        values = {t: (1 + math.log(n)) * coef.get((r["pred_department"], t), 0.0) / length for t, n in counts.items() if number[t] in idf}
        chosen = [t for t, v in values.items() if v > 0] or list(values)
        want = sorted(chosen, key=lambda t: (-abs(values[t]), t))[:4]
        mine = got[r["id"]].split(", ")
        assert [abs(values[t]) for t in mine] == pytest.approx([abs(values[t]) for t in want], rel=1e-9)


def test_interrupted_write_is_not_read(spark, tmp_path):
    path = str(tmp_path / "bundle")
    with pytest.raises(FileNotFoundError):
        load_model(spark, path)
    dense = spark.createDataFrame([(i, "ab"[i % 2], [float(i % 2), 0.1 * (i % 3)]) for i in range(12)], "id long, label string, v array<double>")
    model = models.fit_calibrated(dense, "x", "label", linear.Dense("v"))
    first = save_model(spark, model, path)
    write_arrays(spark, {"linear/vocabulary": model.linear.vocabulary}, f"{path}/99999999999999999999-half/arrays")  # the writer stops here
    assert list(versions(spark, path)) == [first]
    want = model.transform(dense).orderBy("id").collect()
    assert load_model(spark, path).transform(dense).orderBy("id").collect() == want
    second = save_model(spark, model, path)
    assert list(versions(spark, path)) == [first, second]
    with pytest.raises(FileNotFoundError):
        load_model(spark, path, "nothing")


def test_stream_with_a_fitted_ensemble(spark, tmp_path):
    """A stacked ensemble saved, loaded and applied to a stream gives what the batch gives; every base model can score alone."""
    rows = labelled(spark, 120)
    train, meta = rows.filter("id <= 90"), rows.filter("id > 90")
    path = str(tmp_path / "bundle")
    for task in ("department", "sentiment"):
        save_model(spark, models.fit_stacked(train, meta, task, task), f"{path}/{task}")
    loaded = {task: load_model(spark, f"{path}/{task}") for task in ("department", "sentiment")}
    assert all(m.meta is not None and len(m.heads) == 3 for m in loaded.values())
    scorer = lambda df: loaded["sentiment"](loaded["department"](df))
    source = str(tmp_path / "in")
    rows.select("id", "title", "body").repartition(3).write.parquet(source)
    stream = spark.readStream.schema("id long, title string, body string").option("maxFilesPerTrigger", 1).parquet(source)
    stream_scores(stream, scorer, str(tmp_path / "out"), str(tmp_path / "ckpt"), diagnostic_review=True, department_thresholds={"default": 0.5}, sentiment_thresholds={"default": 0.5}).awaitTermination()
    batch = score_reviews(spark.read.parquet(source), scorer, diagnostic_review=True, department_thresholds={"default": 0.5}, sentiment_thresholds={"default": 0.5})
    names = ["id", "pred_department", "pred_sentiment", "risk_score", "priority", "needs_review_diag", "impacted_departments"]
    streamed = spark.read.parquet(str(tmp_path / "out")).select(*names)
    assert streamed.count() == 120 and streamed.exceptAll(batch.select(*names)).count() == 0
    assert models.macro_f1(loaded["department"].transform(rows), "department", "department") > 0.9


def test_batch_prediction_with_explanations(spark):
    """Both linear: two columns of terms that occur in the text. A stacked model has none."""
    rows = labelled(spark, 60)
    one = models.fit_calibrated(rows, "department", "department", models.Features("word", (1, 2), 1, 0.98))
    other = models.fit_calibrated(rows, "sentiment", "sentiment", models.Features("word", (1, 1), 1, 0.98), enriched=True)
    out = score_reviews(rows.select("id", "title", "body"), model_scorer(one, other, 3), guardrail=False).collect()
    assert len(out) == 60
    for r in out:
        terms, words = r["explain_dep_top_tokens"].split(", "), " ".join(w for w in r["text"].split() if len(w) > 1)
        assert 1 <= len(terms) <= 3 and all(f" {t} " in f" {words} " for t in terms)
        assert len(r["explain_sent_top_tokens"].split(", ")) <= 3
    stacked = models.TextModel("department", one.classes, {"a": one.linear, "b": one.linear}, (np.eye(2 * len(one.classes), len(one.classes)), np.zeros(len(one.classes))))
    scored = model_scorer(stacked, other, 3)(rows)
    assert not [c for c in scored.columns if c.startswith("explain")]
    assert scored.filter("department_confidence is null").count() == 0


def test_isotonic_knots_interpolate():
    c = linear.Knots(boundaries=np.array([0.0, 1.0, 3.0]), values=np.array([0.1, 0.5, 0.9]))
    assert c.apply(np.array([-1.0, 0.0, 0.5, 1.0, 2.0, 9.0])) == pytest.approx([0.1, 0.1, 0.3, 0.5, 0.7, 0.9])
