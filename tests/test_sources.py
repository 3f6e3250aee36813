import os

import pytest
from pyspark.sql import functions as F

from conftest import REFERENCE
from triagelake.operators.comparison import safety_report
from triagelake.plans.batch import predict_batch
from triagelake.sources.documents import normalise_thresholds, read_json, read_reported_metrics, read_thresholds
from triagelake.sources.reviews import read_benchmark_folder, read_reviews
from triagelake.streaming.scoring import stream_scores

pytestmark = pytest.mark.skipif(not os.path.exists(REFERENCE), reason="published files not present")


def test_benchmark_folder(spark):
    df = read_benchmark_folder(spark, f"{REFERENCE}/data/benchmarks")
    rows = {(r["section"], r["sentiment"]): r["count"] for r in df.groupBy("section", "sentiment").count().collect()}
    assert rows == {("reviews_safety_critical.csv", "neg"): 151, ("reviews_safety_critical.csv", "pos"): 29}


def test_required_columns(spark, tmp_path):
    spark.range(2).write.parquet(str(tmp_path / "x"))
    with pytest.raises(ValueError):
        read_reviews(spark, str(tmp_path / "x"), "parquet")


def test_thresholds(spark, tmp_path):
    got = read_thresholds(spark, f"{REFERENCE}/outputs/thresholds.json")
    dep = got.filter("task = 'department'").select("class", "threshold")
    classes = spark.createDataFrame([("F&B",), ("Spa",)], "class string")
    table = {r["class"]: r["threshold"] for r in normalise_thresholds(dep, classes).collect()}
    assert table["Spa"] == table["default"] == pytest.approx(0.6157216124481728)
    assert table["F&B"] == pytest.approx(0.631776620763245)
    missing = read_thresholds(spark, str(tmp_path / "none.json"))
    assert {(r["task"], r["class"], r["threshold"]) for r in missing.collect()} == {
        ("department", "default", "0.55"), ("sentiment", "default", "0.55")}
    default = spark.range(1)
    assert read_json(spark, str(tmp_path / "none.json"), default=default) is default


def test_safety_report_from_published_runs(spark):
    before = read_reported_metrics(spark, f"{REFERENCE}/outputs/baseline_pure/metrics.json")
    after = read_reported_metrics(spark, f"{REFERENCE}/outputs/baseline_hardened/metrics.json")
    rows = {(r["section"], r["metric"]): r for r in safety_report(before, after).collect()}
    safety = rows[("reviews_safety_critical.csv", "department_f1")]
    assert safety["before"] == pytest.approx(0.7789, abs=1e-4) and safety["after"] == pytest.approx(1.0)
    assert rows[("test_split", "coverage")]["delta"] == pytest.approx(0.8239 - 0.9429, abs=2e-4)


def test_predict_batch_and_stream(spark, tmp_path):
    gold = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option(
        "inferSchema", True).csv(f"{REFERENCE}/outputs/predictions_demo_refresh.csv")
    predict_batch(gold, str(tmp_path / "p"), str(tmp_path / "s"), "parquet", diagnostic_review=False)
    assert "needs_review_diag" not in spark.read.parquet(str(tmp_path / "p")).columns
    assert len(spark.read.json(str(tmp_path / "s")).first()["rows"]) == 3

    def constant(df):
        return df.withColumns({
            "pred_department": F.lit("Reception"), "department_confidence": F.lit(0.9),
            "pred_sentiment": F.lit("pos"), "sentiment_confidence": F.lit(0.8),
            "proba_sentiment_neg": F.lit(0.2), "proba_sentiment_pos": F.lit(0.8),
        })

    gold.select("id", "title", "body").write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema("id int, title string, body string").parquet(str(tmp_path / "in"))
    run = stream_scores(source, constant, str(tmp_path / "out"), str(tmp_path / "cp"))
    run.awaitTermination(120)
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.count() == 6 and out.filter("sentiment_guardrail_applied").count() > 0
