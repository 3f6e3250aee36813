"""The given tables seen as reviews, labels and model scores.

The tables hold invented prose in four languages, so the lexicons here are
frequent words of it, and two score sources stand in for fitted models: cue
shares on the text and class centroids on the embeddings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.base import col, lit_d, total
from ..functions.lexicon import CueSet, Lexicons, department_score, with_cue_columns
from ..functions.text import prepare_text, tokens
from ..operators.scoring import attach_scores
from .batch import runtime_layer

LEXICONS = Lexicons(
    negative=CueSet(("with", "und", "les"), ("and the", "de de")),
    hazard=CueSet(("orre", "ment"), ("the anea",)),
    positive=CueSet(("is", "was", "el", "ein", "eau"), ("in the", "la de")),
    negators=("the", "la", "der"),
    departments={
        "Reception": ("the", "of", "and", "of the"),
        "Housekeeping": ("de", "la", "que", "le", "de la"),
        "F&B": ("der", "die", "und", "den"),
    },
)
POLARITY_WORDS = {"neg": ("to", "n", "en"), "pos": ("in", "la", "a")}
DEPARTMENT_CLASSES = ("F&B", "Housekeeping", "Reception")
SENTIMENT_CLASSES = ("neg", "pos")
DEPARTMENT_THRESHOLDS = {"default": 0.45, "F&B": 0.50}
SENTIMENT_THRESHOLDS = {"default": 0.60, "neg": 0.65}
ROUTE_CLASSES = tuple(str(i) for i in range(10))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table as a stream over its files; a table of one file is picked out of its folder by name."""
    path = f"{sf_dir}/{name}.parquet"
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if place.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(place).isFile():
        return reader.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)
    return reader.parquet(path)


def spread(rows: DataFrame, key: str) -> DataFrame:
    """Rows dealt out anew where their scan has fewer tasks than the session has cores, as files of a single row group do; else as scanned."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores, key) if rows.rdd.getNumPartitions() < cores else rows


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as (id, title, body, lang, source): the first line is the title."""
    d = spread(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"), "doc_id")
    return d.select(
        F.col("doc_id").alias("id"), F.substring_index("text", "\n", 1).alias("title"), F.col("text").alias("body"),
        "lang", "source",
    )


def labelled_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews with labels: department = language, sentiment = neg when toxic."""
    labels = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("id"), "quality",
        F.when(F.col("toxic") == 1, "neg").otherwise("pos").alias("sentiment"),
    )
    return reviews(spark, sf_dir).withColumnRenamed("lang", "department").join(labels, "id")


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare_text(reviews(spark, sf_dir))


def cue_share_scorer(df: DataFrame) -> DataFrame:
    """Department and sentiment scores from cue counts with add-one smoothing."""
    df = df if "_cue_text" in df.columns else with_cue_columns(df, LEXICONS, clean=True)
    counts = {c: department_score(c) for c in DEPARTMENT_CLASSES}
    df = df.withColumn("_all_cues", total(list(counts.values())))
    k = lit_d(len(DEPARTMENT_CLASSES))
    df = attach_scores(df, "department", {
        c: (lit_d(1.0) + n) / (k + F.col("_all_cues")) for c, n in counts.items()
    })
    words = tokens(F.col("text"))

    def occurrences(side: str) -> Column:
        return F.size(F.filter(words, lambda w: w.isin(*POLARITY_WORDS[side])))

    df = df.withColumns({f"_n_{s}": occurrences(s) for s in SENTIMENT_CLASSES})
    both = lit_d(2.0) + F.col("_n_neg") + F.col("_n_pos")
    df = attach_scores(df, "sentiment", {s: (lit_d(1.0) + F.col(f"_n_{s}")) / both for s in SENTIMENT_CLASSES})
    return df.drop("_all_cues", "_n_neg", "_n_pos")


def scored_texts(spark: SparkSession, sf_dir: str, cues: bool = False) -> DataFrame:
    """Texts with model scores, before the runtime layer."""
    out = cue_share_scorer(with_cue_columns(texts(spark, sf_dir), LEXICONS, clean=True))
    return out if cues else out.drop(*[c for c in out.columns if c.startswith("_cue_")])


def scored_reviews(spark: SparkSession, sf_dir: str, diagnostic_review: bool = True) -> DataFrame:
    """Texts with model scores and all runtime columns."""
    return runtime_layer(
        scored_texts(spark, sf_dir, cues=True), LEXICONS, DEPARTMENT_THRESHOLDS, SENTIMENT_THRESHOLDS, diagnostic_review
    )


def scored_labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored reviews that have a true sentiment, with quality as the section.

    The pre-guardrail sentiment probabilities are kept as ``proba_raw_sentiment_*``.
    """
    labels = labelled_reviews(spark, sf_dir).select("id", F.col("sentiment").alias("true_sentiment"), "quality")
    # labels first: texts without one need no scores
    scored = cue_share_scorer(with_cue_columns(texts(spark, sf_dir).join(labels, "id"), LEXICONS, clean=True))
    scored = scored.withColumns({
        f"proba_raw_sentiment_{c}": col(f"proba_sentiment_{c}") for c in SENTIMENT_CLASSES
    })
    scored = runtime_layer(scored, LEXICONS, DEPARTMENT_THRESHOLDS, SENTIMENT_THRESHOLDS, True)
    # each language has its home department, which serves as the true one
    home = F.when(F.col("lang") == "en", "Reception").when(F.col("lang") == "de", "F&B").otherwise("Housekeeping")
    return (
        scored.withColumn("true_department", home)
        .withColumn("section", F.when(F.col("quality") == 1, "quality").otherwise("other"))
    )


def route_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """embeddings scored by class centroid: softmax of 20 times the dot product.

    The centroids are a few numbers per class and come in as a subquery value,
    so scoring is a projection over the scan.
    """
    e = table(spark, sf_dir, "embeddings").select("vec_id", F.col("label").cast("string").alias("truth"), "embedding")
    cells = e.select("truth", F.posexplode("embedding").alias("i", "x"))
    means = cells.groupBy("truth", "i").agg(F.avg(F.col("x").cast("double")).alias("m"))
    per_class = means.groupBy("truth").agg(F.array_sort(F.collect_list(F.struct("i", "m"))).alias("c"))
    model = per_class.agg(F.map_from_entries(F.collect_list(
        F.struct(F.col("truth"), F.transform("c", lambda s: s["m"]))
    ))).scalar()
    e = e.withColumn("_model", model)

    def dot(label: str) -> Column:
        pairs = F.zip_with(
            F.col("embedding"), F.try_element_at(F.col("_model"), F.lit(label)), lambda x, m: x.cast("double") * m
        )
        return F.aggregate(pairs, lit_d(0.0), lambda acc, v: acc + v)

    e = e.withColumns({f"_e{c}": F.exp(lit_d(20.0) * dot(c)) for c in ROUTE_CLASSES})
    e = e.withColumn("_sum", total([F.col(f"_e{c}") for c in ROUTE_CLASSES]))
    # nine places: sums in another order must not move a score across a conformal cut
    e = attach_scores(e, "route", {c: F.round(F.col(f"_e{c}") / F.col("_sum"), 9) for c in ROUTE_CLASSES})
    return e.drop("embedding", "_model", "_sum", *[f"_e{c}" for c in ROUTE_CLASSES])
