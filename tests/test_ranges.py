"""Null groups, shared folders, calibration and two-class models."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from triagelake.operators import evaluation, linear, models, ranking, rollups
from triagelake.sources.materialise import materialise, shared_folder


def test_null_groups_stay(spark):
    d = spark.createDataFrame([(None, "x", 0.1), (None, "y", 0.3), ("a", "x", 0.5)], "g string, v string, x double")
    shares = {(r.g, r.v): r.share for r in rollups.value_share(d, "v", by=["g"]).collect()}
    assert shares == {(None, "x"): 0.5, (None, "y"): 0.5, ("a", "x"): 1.0}
    found = {r.g: (r.group_rows, r.quantile) for r in ranking.quantiles(d, ["g"], "x", 0.5).collect()}
    assert found == {None: (2, 0.2), "a": (1, 0.5)}
    matrix = evaluation.confusion_matrix(d.withColumn("p", F.col("v")), "v", "p", ["x", "y"], by=["g"]).collect()
    assert sum(r.x + r.y for r in matrix if r.g is None) == 2


def test_intermediates_stay_in_the_shared_folder(spark):
    out = materialise(spark.range(3))
    assert out.count() == 3
    assert all(f.removeprefix("file:").lstrip("/").startswith(shared_folder(spark).removeprefix("file:").lstrip("/")) for f in out.inputFiles())


def test_sigmoid_calibration_converges(spark):
    r = np.random.default_rng(1)
    m = r.normal(0, 30, 400)
    y = (r.random(400) < 1 / (1 + np.exp(-(0.4 * m - 2)))).astype(int)
    rows = [(j, float(a if j else -a), bool(b == j)) for a, b in zip(m, y, strict=True) for j in range(2)]
    fitted = linear.fit_sigmoids(spark.createDataFrame(rows, "j long, m double, mine boolean"))[1]
    n, pos = len(y), y.sum()
    t = np.where(y == 1, (pos + 1) / (pos + 2), 1 / (n - pos + 2))
    p = 1 / (1 + np.exp(-(fitted.slope * m + fitted.offset)))
    assert abs(((p - t) * m).sum()) < 1e-3 and abs((p - t).sum()) < 1e-4


def test_two_class_svm_has_coefficients(spark):
    rows = [(i, "good" if i % 2 else "bad", "fine nice" if i % 2 else "awful dirty") for i in range(40)]
    d = spark.createDataFrame(rows, "id long, label_text string, text string")
    model = models.fit_calibrated(d, "t", "label_text", models.Features("word", (1, 1)), kind="svm")
    coefs = {(r["class"], r.term): r.coef for r in model.coefficients(d).collect()}
    assert coefs["good", "nice"] > 0 > coefs["bad", "nice"]


def test_an_outlying_id_leaves_the_buckets_balanced(spark):
    d = spark.range(1000).union(spark.createDataFrame([(1 << 60,)], "id long"))
    sizes = d.withColumn("b", ranking.range_bucket(d, "id")).groupBy("b").count()
    assert sizes.agg(F.max("count")).first()[0] <= 10
    ranked = ranking.row_ranks(d, [], ranking.range_bucket(d, "id"), [F.col("id")], "rank").orderBy("id").collect()
    assert [r["rank"] for r in ranked] == list(range(1001))
