import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from triagelake.operators import conformal, splits
from triagelake.operators.ranking import hex_bucket, order_statistics, quantiles, range_bucket, row_ranks
from triagelake.operators.thresholds import class_thresholds


@pytest.fixture(scope="module")
def scores(spark):
    rng = random.Random(3)
    rows = [("a", rng.random()) for _ in range(400)] + [("b", 0.999999 + rng.random() * 1e-7) for _ in range(300)]
    rows += [("c", 0.25)] * 50 + [("d", 1.0)]
    return rows, spark.createDataFrame(rows, "k string, v double")


def test_quantiles_match_numpy(scores):
    rows, df = scores
    for r in quantiles(df, ["k"], "v", 0.08).collect():
        values = [v for k, v in rows if k == r["k"]]
        assert r["group_rows"] == len(values)
        assert r["quantile"] == pytest.approx(np.quantile(values, 0.08), abs=1e-15)


def test_order_statistics_without_keys(scores):
    rows, df = scores
    got = order_statistics(df, [], "v", {"tenth": lambda n: F.lit(9), "last": lambda n: n - 1}).collect()
    ordered = sorted(v for _, v in rows)
    assert {r["name"]: r["value"] for r in got} == {"tenth": ordered[9], "last": ordered[-1]}


def test_row_ranks(spark):
    df = spark.range(500).withColumn("k", F.col("id") % 3).withColumn("h", F.md5(F.col("id").cast("string")))
    got = row_ranks(df, ["k"], hex_bucket(F.col("h"), 0), [F.col("h")]).collect()
    for k in range(3):
        mine = sorted((r for r in got if r["k"] == k), key=lambda r: r["h"])
        assert [r["rank"] for r in mine] == list(range(len(mine)))
    ids = spark.createDataFrame([(i,) for i in (5, -7, 900, 12, 13)], "id long")
    got = {r["id"]: r["rank"] for r in row_ranks(ids, [], range_bucket(ids, "id"), [F.col("id")]).collect()}
    assert got == {-7: 0, 5: 1, 12: 2, 13: 3, 900: 4}


def test_split_is_exact_and_repeatable(spark):
    df = spark.range(203).withColumn("s", F.when(F.col("id") % 7 == 0, "rare").otherwise("usual"))
    one = splits.stratified_split(df, F.col("s"), 0.2, 42)
    two = splits.stratified_split(df.repartition(5), F.col("s"), 0.2, 42)
    picked = {r["id"] for r in one.filter("is_test").collect()}
    assert len(picked) == 41  # ceil(0.2 * 203)
    assert picked == {r["id"] for r in two.filter("is_test").collect()}
    rare = [i for i in range(203) if i % 7 == 0]
    key = lambda i: hashlib.md5(f"{i}-42".encode()).hexdigest()
    want = sorted(rare, key=key)[: sum(i in picked for i in rare)]
    assert set(want) == {i for i in rare if i in picked}


def test_replay_small_groups_and_missing_labels(spark):
    rows = [(i, "a", "x") for i in range(50)] + [(100, "b", "y"), (101, None, "y")]
    df = spark.createDataFrame(rows, "id long, department string, sentiment string")
    got = splits.replay_sample(df, 52).collect()
    assert len(got) == 51 and all(r["department"] for r in got)
    assert splits.replay_sample(df, 0).count() == 0


def test_append_labelled(spark):
    base = spark.createDataFrame(
        [(i, "t", "b", "a" if i % 2 else "c", "pos") for i in range(1, 21)], "id long, title string, body string, department string, sentiment string")
    queue = spark.createDataFrame(
        [(7, "q", "x", "a", "neg"), (3, "q", "y", " ", "neg"), (2, "q", "z", "c", "pos")],
        "id long, title string, body string, true_department string, true_sentiment string")
    out = splits.append_labelled(base, queue, replay_size=6).collect()
    ids = sorted(r["id"] for r in out)
    assert len(out) == 28 and ids == list(range(1, 29))
    assert [(r["id"], r["body"]) for r in out if r["origin"] == "labelled"] == [(21, "z"), (22, "x")]
    with pytest.raises(ValueError):
        splits.append_labelled(base, queue.filter("id = 3"))


def test_thresholds_for_absent_class_and_empty_set(spark):
    rows = [("a", 0.9, 0.1), ("a", 0.7, 0.3), ("b", 0.2, 0.8)]
    df = spark.createDataFrame(rows, "y string, proba_t_a double, proba_t_b double")
    got = {r["class"]: r["threshold"] for r in class_thresholds(df, "t", "y", ["a", "b", "z"]).collect()}
    assert got["a"] == pytest.approx(np.quantile([0.9, 0.7], 0.08)) and got["b"] == pytest.approx(0.8) and got["z"] == 0.45
    assert got["default"] == pytest.approx(np.mean([got["a"], got["b"], got["z"]]))
    empty = {r["class"]: r["threshold"] for r in class_thresholds(df.filter("y = 'q'"), "t", "y", ["a", "b"]).collect()}
    assert empty == {"default": 0.45}


@pytest.mark.parametrize("n", [1, 2, 37])
def test_conformal_against_numpy(spark, n):
    rng = np.random.default_rng(n)
    p = rng.dirichlet([1, 1, 1], n)
    y = rng.integers(0, 3, n)
    rows = [(i, "abc"[y[i]], *map(float, p[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "id long, y string, proba_t_a double, proba_t_b double, proba_t_c double")
    scores = []
    for row, c in zip(p, y):
        order = np.argsort(-row, kind="stable")
        scores.append(np.cumsum(row[order])[list(order).index(c)])
    level = float(np.clip(np.ceil((n + 1) * 0.9) / n, 0, 1))
    qhat = float(np.quantile(scores, level, method="higher"))
    fitted = conformal.conformal_fit(df, "t", "y", ["a", "b", "c"])
    assert fitted.first()["qhat"] == pytest.approx(qhat, abs=1e-12)
    for r in conformal.conformal_sets(df, fitted, "t", ["a", "b", "c"]).collect():
        row = p[r["id"]]
        order = np.argsort(-row, kind="stable")
        keep = max(1, min(int(np.sum(np.cumsum(row[order]) < qhat - 1e-12)) + 1, 3))
        assert r["t_conformal_set"] == ["abc"[i] for i in order[:keep]]
