"""Mixing sources to target weights by Efraimidis-Spirakis sampling, in DataFrame operations alone.

Every document gets the exponential key -ln(u) / w, u a hash of the document and the seed, w its quality weight; taking
documents in key order is weighted sampling without replacement. A source's target is met by whole epochs (every document
once each) and then by documents in key order up to the remaining words; the last one is taken in part.

The order inside a source is never sorted in one task: keys fall into buckets of a few thousand documents by the key's
distribution function, buckets are summed first, and each bucket is then sorted alone and shifted by the words before it.

Defined cases: null or empty text has size 0 and takes 0; null source is a source of its own, last in order; null or
repeated doc_ids are rows like any other (fully equal rows are interchangeable); an empty table gives an empty result;
a source without words has target 0; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import WORD, own_columns, written

WEIGHTS = (3, 1, 2)
SHARE_PERCENT = 150
MOST = 2
BUCKET_ROWS = 4096
CLASSES = 20


def quality_class(text: Column, symbols: str = "#*$%&|<>!") -> Column:
    """From 1 to CLASSES: the share of characters that are not junk symbols, rounded up; a weight is class / CLASSES."""
    length = F.length("text")
    share = F.ceil((length - F.length(F.regexp_replace(text, "[^" + symbols.replace("&", "\\&") + "]", ""))) * CLASSES / length)
    return F.when(length > 0, F.greatest(share, F.lit(1))).otherwise(F.lit(1)).cast("int")


def keyed(documents: DataFrame, seed: int, keep: list[str]) -> DataFrame:
    """(keep, source, size, class, tie, draw): draw is the exponential key; rows that still tie are equal."""
    size = F.coalesce(F.call_function("regexp_count", F.col("text"), F.lit(WORD)), F.lit(0)).cast("long")
    tie = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.coalesce("text", F.lit(""))))
    rows = documents.select(*keep, "source", size.alias("size"), quality_class(F.col("text")).alias("class"), tie.alias("tie"))
    # 52 bits and a half: never 0 or 1
    u = (F.conv(F.substring("tie", 1, 13), 16, 10).cast("long").cast("double") + 0.5) / F.lit(float(1 << 52))
    return rows.withColumn("draw", -F.log(u) / (F.col("class") / float(CLASSES)))


def targets(sources: DataFrame) -> DataFrame:
    """sources (source, source_size, ...) -> with target. One row per source.

    Resharing the excess until no source is above its limit ends at min(limit, level * weight) with one level for all:
    in order of limit / weight the first sources are full, and the level follows from what is left.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    n = len(WEIGHTS)
    weighted = sources.withColumn("w", F.element_at(F.array(*[F.lit(float(x)) for x in WEIGHTS]), (F.row_number().over(order) - 1) % n + 1)).withColumn("limit", F.col("source_size") * float(MOST))
    every = Window.partitionBy()
    fill = Window.orderBy("ratio", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    filled = (
        weighted.withColumn("ratio", F.col("limit") / F.col("w"))
        .withColumns({"total": F.sum("source_size").over(every) * (SHARE_PERCENT / 100), "all_w": F.sum("w").over(every)})
        .withColumns({"full": F.coalesce(F.sum("limit").over(fill), F.lit(0.0)), "full_w": F.coalesce(F.sum("w").over(fill), F.lit(0.0))})
        .withColumn("level", (F.col("total") - F.col("full")) / (F.col("all_w") - F.col("full_w")))
    )
    # the level of the first source that it doesn't fill; where it fills all, every source is at its limit
    level = F.min(F.when(F.col("level") < F.col("ratio"), F.struct("ratio", F.col("source").isNull(), "source", "level"))).over(every)["level"]
    return filled.withColumn("target", F.coalesce(F.least(F.col("limit"), level * F.col("w")), F.col("limit"))).drop("w", "limit", "ratio", "total", "all_w", "full", "full_w", "level")


def mixed(documents: DataFrame, seed: int = 0, keep: list[str] | None = None) -> DataFrame:
    """documents (doc_id, text, source) -> keep (doc_id), source, size, source_size, target, taken."""
    keep = keep or ["doc_id"]
    rows = written(keyed(documents, seed, keep), "mix-keys")  # narrow; the texts are read once
    by_class = rows.groupBy("source", "class").agg(F.sum("size").alias("size"), F.count("*").alias("n"))
    sources = by_class.groupBy("source").agg(F.sum("size").alias("source_size"), F.sum("n").alias("n_docs"), F.sort_array(F.collect_list(F.struct("class", "n"))).alias("classes"))  # CLASSES entries at most
    plan = written(
        targets(sources)
        .withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)))
        .withColumn("rest", F.round(F.col("target") - F.col("epochs") * F.col("source_size")).cast("long"))
        .withColumn("n_buckets", F.ceil(F.col("n_docs") / BUCKET_ROWS)),
        "mix-plan",
    )
    # the source's distribution function of keys, a mixture of exponentials: buckets of about equal size, in key order
    below = F.aggregate("classes", F.lit(0.0), lambda acc, c: acc + c["n"] * (1 - F.exp(-F.col("draw") * c["class"] / float(CLASSES)))) / F.col("n_docs")
    # one row per source: Spark broadcasts it below its threshold, and splits the hot source's side where it does not
    placed = rows.join(plan.withColumnRenamed("source", "source_"), F.col("source").eqNullSafe(F.col("source_"))).withColumn("bucket", F.least(F.floor(below * F.col("n_buckets")), F.col("n_buckets") - 1))
    sums = placed.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = written(sums.select(F.col("source").alias("s"), F.col("bucket").alias("b"), F.coalesce(F.sum("bucket_size").over(earlier), F.lit(0)).alias("before")), "mix-starts")
    inside = Window.partitionBy("source", "bucket").orderBy("draw", "tie", "size").rowsBetween(Window.unboundedPreceding, -1)
    ordered = placed.join(starts, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b"))).withColumn("before", F.col("before") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
    part = F.greatest(F.least(F.col("rest") - F.col("before"), F.col("size")), F.lit(0))
    return ordered.select(*keep, "source", "size", "source_size", "target", (F.col("epochs") * F.col("size") + part).cast("long").alias("taken"))


def mix_of(documents: DataFrame, seed: int = 0) -> DataFrame:
    """doc_id, size, source_size, target, taken."""
    return mixed(own_columns(documents, ["doc_id", "text", "source"]), seed).select("doc_id", "size", "source_size", "target", "taken")


def mixed_documents(documents: DataFrame, seed: int = 0) -> DataFrame:
    """The mix itself, with all columns: each document once for each whole taking, and its first words for a partial one.
    n_chars, where there is one, follows the text."""
    row = F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row")
    chosen = mixed(documents.select("doc_id", "text", "source", row), seed, ["row"]).where("taken > 0")
    space = "\\x20\\x09-\\x0D"
    words = F.split("row.text", f"(?<=[^{space}])(?=[{space}])")  # each word with the white space before it
    rest = (F.col("taken") % F.col("size")).cast("int")
    texts = F.concat(F.array_repeat("row.text", F.floor(F.col("taken") / F.col("size")).cast("int")), F.when(rest > 0, F.array(F.array_join(F.slice(words, 1, rest), ""))).otherwise(F.array().cast("array<string>")))
    out = chosen.select("row", F.explode(texts).alias("part"))
    kinds = dict(documents.dtypes)
    return out.select(*[F.col("part").alias("text") if c == "text" else F.length("part").cast(kinds[c]).alias(c) if c == "n_chars" else F.col(f"row.`{c}`").alias(c) for c in documents.columns])
