"""Hold-out splits, folds, quotas, replay samples and dataset growth.

Every choice is made by a seeded hash of the row key, so it does not depend on
partitioning and repeats on every run. Keys must be unique.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.base import col, hash_hex, lit_d, require_columns
from ..sources.materialise import materialise
from .ranking import hex_bucket, order_statistics, range_bucket, row_ranks


def joint_stratum(*names: str) -> Column:
    return F.concat_ws("__", *[col(n).cast("string") for n in names])


def largest_remainder(counts: DataFrame, size: int | Column, keys: Sequence[str], count: str = "rows") -> DataFrame:
    """Share ``size`` out over groups in proportion to their counts.

    ``counts`` has one row per group. Whole parts first, then one more for the
    largest remainders; equal remainders go in key order.
    """
    counts = materialise(counts)
    size = F.lit(size) if isinstance(size, int) else size
    raw = col(count) / counts.agg(F.sum(col(count))).scalar() * size.cast("double")
    parts = counts.withColumn("quota_raw", raw).withColumn("quota", F.floor("quota_raw"))
    left = size - parts.agg(F.sum("quota")).scalar()
    order = Window.partitionBy(F.lit(0)).orderBy(
        (F.col("quota_raw") - F.col("quota")).desc(), *[col(k).asc() for k in keys]
    )
    extra = F.when(F.row_number().over(order) <= left, F.lit(1)).otherwise(F.lit(0))
    return parts.withColumn("quota", (F.col("quota") + extra).cast("long"))


def lowest_hashes(df: DataFrame, stratum: str, quota: DataFrame, key: str, seed: int, out: str) -> DataFrame:
    """Flag the ``quota`` rows with the lowest seeded hash in each stratum.

    ``quota`` is (stratum, quota). Only the hash at the cut is searched for;
    marking the rows is then a projection against one cut value per stratum.
    """
    hashed = df.withColumn("_h", hash_hex(col(key), seed))
    ranks = quota.filter(F.col("quota") > 0).select(
        stratum, F.lit("cut").alias("name"), (F.col("quota") - 1).alias("rank")
    )
    cuts = order_statistics(hashed, [stratum], "_h", ranks, bucket=hex_bucket)
    table = cuts.agg(F.map_from_entries(F.collect_list(F.struct(col(stratum), F.col("value"))))).scalar()
    cut = F.try_element_at(table, F.coalesce(col(stratum), F.lit("")))
    return hashed.withColumn(out, F.coalesce(F.col("_h") <= cut, F.lit(False))).drop("_h")


def stratified_split(
    df: DataFrame, stratum: Column, share: float = 0.20, seed: int = 42, key: str = "id", out: str = "is_test"
) -> DataFrame:
    """Exact stratified hold-out of ``ceil(share * rows)`` rows."""
    rows = df.withColumn("_stratum", F.coalesce(stratum, F.lit("")))
    counts = rows.groupBy("_stratum").agg(F.count("*").alias("rows"))
    size = F.ceil(counts.agg(F.sum("rows")).scalar().cast("double") * lit_d(share))
    quota = largest_remainder(counts, size, ["_stratum"])
    return lowest_hashes(rows, "_stratum", quota, key, seed, out).drop("_stratum")


def three_way_split(
    df: DataFrame, stratum: Column, test_share: float = 0.20, second_share: float = 0.20, seed: int = 42,
    key: str = "id", names: tuple[str, str, str] = ("train", "calibration", "test"),
) -> DataFrame:
    """Hold-out, then a second stratified split of the rest with ``seed + 1``; adds ``split``."""
    first = stratified_split(df, stratum, test_share, seed, key, "_test")
    test = first.filter(F.col("_test")).drop("_test").withColumn("split", F.lit(names[2]))
    rest = first.filter(~F.col("_test")).drop("_test")
    second = stratified_split(rest, stratum, second_share, seed + 1, key, "_second")
    second = second.withColumn(
        "split", F.when(F.col("_second"), F.lit(names[1])).otherwise(F.lit(names[0]))
    ).drop("_second")
    return second.unionByName(test)


def stratified_folds(df: DataFrame, stratum: Column, k: int, seed: int = 42, key: str = "id", out: str = "fold") -> DataFrame:
    """Shuffled stratified fold number 0..k-1."""
    rows = df.withColumns({"_stratum": stratum, "_h": hash_hex(col(key), seed)})
    ranked = row_ranks(rows, ["_stratum"], hex_bucket(F.col("_h"), 0), [F.col("_h"), col(key)], "_rank")
    return ranked.withColumn(out, F.pmod(F.col("_rank"), F.lit(k)).cast("int")).drop("_stratum", "_h", "_rank")


def replay_sample(
    base: DataFrame, size: int, seed: int = 42, groups: Sequence[str] = ("department", "sentiment"), key: str = "id"
) -> DataFrame:
    """Sample ``size`` historical rows in proportion to the label groups.

    Rows with a missing label count in the proportions but are never drawn; a
    group smaller than its quota gives all its rows.
    """
    if size <= 0:
        return base.filter(F.lit(False))
    counts = base.groupBy(*[col(g) for g in groups]).agg(F.count("*").alias("rows"))
    labelled = F.lit(True)
    for g in groups:
        labelled = labelled & col(g).isNotNull()
    quota = largest_remainder(counts, size, groups).filter(labelled).select(
        joint_stratum(*groups).alias("_stratum"), F.least("quota", "rows").alias("quota")
    )
    rows = base.filter(labelled).withColumn("_stratum", joint_stratum(*groups))
    return lowest_hashes(rows, "_stratum", quota, key, seed, "_keep").filter("_keep").drop("_keep", "_stratum")


def augment_union(base: DataFrame, extra: DataFrame, repeat: int = 1, needed: Sequence[str] = ("title", "body", "department", "sentiment")) -> DataFrame:
    """Base rows plus ``repeat`` copies of the extra rows; ``copy`` is 0 for base rows.

    Columns the extra rows lack are null.
    """
    require_columns(extra, list(needed), "augmentation")
    out = base.withColumn("copy", F.lit(0))
    if repeat <= 0:
        return out
    copies = extra.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(int(repeat)))))
    return out.unionByName(copies, allowMissingColumns=True)


def labelled_rows(queue: DataFrame) -> DataFrame:
    """Queue rows whose two true labels are filled in."""
    require_columns(queue, ["title", "body", "true_department", "true_sentiment"], "labelled queue")
    filled = [F.coalesce(F.trim(col(c).cast("string")), F.lit("")) != "" for c in ("true_department", "true_sentiment")]
    return queue.filter(filled[0] & filled[1])


def sequential_ids(df: DataFrame, order: str, start: Column) -> DataFrame:
    """Replace ``id`` by ``start``, ``start + 1``, ... in the order of an integer column."""
    ranked = row_ranks(df, [], range_bucket(df, order), [col(order)], "_rank")
    return ranked.withColumn("id", (start + F.col("_rank")).cast("long")).drop("_rank")


def append_labelled(base: DataFrame, queue: DataFrame, replay_size: int = 0, replay_seed: int = 42) -> DataFrame:
    """Base set, then the labelled queue rows, then a replay sample, with fresh ids.

    Raises when the queue holds no labelled row. ``origin`` tells the parts apart.
    """
    labelled = labelled_rows(queue)
    if labelled.isEmpty():
        raise ValueError("labelled queue: no row has both true labels")
    columns = ["id", "title", "body", "department", "sentiment"]
    next_id = F.coalesce(base.agg(F.max("id")).scalar(), F.lit(0)) + F.lit(1)
    new = labelled.select(
        "id", "title", "body",
        col("true_department").alias("department"), col("true_sentiment").alias("sentiment"),
    )
    new = sequential_ids(new, "id", next_id)
    out = base.select(*columns).withColumn("origin", F.lit("base")).unionByName(
        new.select(*columns).withColumn("origin", F.lit("labelled"))
    )
    if replay_size > 0:
        after = next_id + labelled.agg(F.count("*")).scalar()
        replay = sequential_ids(replay_sample(base, replay_size, replay_seed).select(*columns), "id", after)
        out = out.unionByName(replay.withColumn("origin", F.lit("replay")))
    return out
