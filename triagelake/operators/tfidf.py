"""TF-IDF as relations: term counts, vocabulary, weights."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.base import col, lit_d
from ..functions.text import char_wb_ngrams, tokens, word_ngrams

MIN_WORD_LENGTH = 2


def terms_of(text: Column, analyzer: str = "word", ngrams: tuple[int, int] = (1, 2)) -> Column:
    """Term occurrences of a clean text: word n-grams over words of two or more
    characters, or character n-grams inside words."""
    words = tokens(text)
    if analyzer == "word":
        return word_ngrams(F.filter(words, lambda w: F.length(w) >= MIN_WORD_LENGTH), *ngrams)
    if analyzer == "char_wb":
        return char_wb_ngrams(words, *ngrams)
    raise ValueError(f"unknown analyzer {analyzer!r}")


def dealt(docs: DataFrame, keys: Sequence[str], rows: int = 2048) -> DataFrame:
    """Rows dealt out by key in pieces of about ``rows``, so that counts by key and term are made where the row lies.

    Texts travel once in place of their terms, and a piece's counts fit a task's memory; only what is counted by term
    alone is shuffled after it. Rows of one key stay together.
    """
    pieces = -(-docs.select(*[col(k) for k in keys]).count() // rows)
    return docs.repartition(max(1, pieces), *[col(k) for k in keys])


def term_counts(docs: DataFrame, keys: Sequence[str], terms: Column) -> DataFrame:
    """(keys..., term, tf). Occurrences of a row are added up inside its task first."""
    return docs.select(*[col(k) for k in keys], F.explode(terms).alias("term")).groupBy(
        *keys, "term"
    ).agg(F.count("*").alias("tf"))


def char_counts(docs: DataFrame, keys: Sequence[str], text: str = "text", ngrams: tuple[int, int] = (3, 5), hashed: bool = False) -> DataFrame:
    """(keys..., term, tf) for character n-grams inside words; ``hashed``: with the terms' 64-bit hashes in their place.

    The n-grams of a word do not depend on its surroundings, so words are
    counted first and only distinct words of a row are cut up. Both steps keep a
    partitioning by row key.
    """
    names = [col(k) for k in keys]
    words = docs.select(*names, F.explode(tokens(col(text))).alias("word")).groupBy(*keys, "word").agg(
        F.count("*").alias("n")
    )
    terms = char_wb_ngrams(F.array("word"), *ngrams)
    grams = words.select(*names, "n", F.explode(F.transform(terms, lambda t: F.xxhash64(t)) if hashed else terms).alias("term"))
    return grams.groupBy(*keys, "term").agg(F.sum("n").alias("tf"))


def vocabulary(
    counts: DataFrame, documents: Column, min_df: int = 1, max_df: float = 1.0, max_features: int | None = None,
    copies: Column | None = None,
) -> DataFrame:
    """(term, df, total_tf, idf) with smooth idf ``ln((1+n)/(1+df)) + 1``.

    ``documents`` is the number of documents (a scalar subquery), ``copies`` how
    many documents a counted row stands for. ``max_features`` keeps the most
    frequent terms, equal ones in alphabetical order.
    """
    weight = F.lit(1) if copies is None else copies
    stats = counts.groupBy("term").agg(
        F.sum(weight).cast("long").alias("df"), F.sum(F.col("tf") * weight).cast("long").alias("total_tf")
    )
    return kept_terms(stats, documents, min_df, max_df, max_features)


def kept_terms(stats: DataFrame, documents: Column, min_df: int = 1, max_df: float = 1.0, max_features: int | None = None) -> DataFrame:
    """The terms of a vocabulary, from their summed frequencies, with their idf."""
    if min_df > 1:
        stats = stats.filter(F.col("df") >= min_df)
    if max_df < 1.0:
        stats = stats.filter(F.col("df") <= documents.cast("double") * lit_d(max_df))
    if max_features is not None:
        stats = stats.orderBy(F.desc("total_tf"), F.asc("term")).limit(max_features)
    n = documents.cast("double")
    return stats.withColumn("idf", F.log((n + lit_d(1.0)) / (F.col("df") + lit_d(1.0))) + lit_d(1.0))


def tfidf_weights(counts: DataFrame, vocab: DataFrame, keys: Sequence[str], sublinear: bool = False, small_vocabulary: bool = False) -> DataFrame:
    """(keys..., term, weight) with rows of unit length.

    ``small_vocabulary`` says that ``max_features`` bounds the vocabulary, which
    may then be broadcast; otherwise Spark picks the join by measured size.
    """
    tf = F.col("tf").cast("double")
    tf = lit_d(1.0) + F.log(tf) if sublinear else tf
    table = vocab.select("term", "idf")
    raw = counts.join(F.broadcast(table) if small_vocabulary else table, "term").withColumn("_w", tf * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(Window.partitionBy(*[col(k) for k in keys])))
    return raw.select(*[col(k) for k in keys], "term", (F.col("_w") / norm).alias("weight"))
