"""Quality rules whose cut-offs follow the data of each language and source.

Every document is reduced to whole-number metrics. Their distributions are kept as mergeable quantile sketches: counts per
logarithmic bucket (buckets are exact below 64 and 1/32 wide above), so adding two sketches is adding counts, and partial
aggregation keeps a hot source from reaching one task as rows. A group's fences come from its own sketch; groups with few
documents use the merged sketch of their language, and then that of the whole corpus.

By default the fences are those of the SQL counterpart, which the fixed values of UPPER and LOWER can only loosen. With
`by_sketch` the sketches alone decide: a fence is an outer decile, beyond it FAR times its distance to the median, and a small
allowance, so that groups without spread keep clean documents. A group's fence stays between its language's decile and its
language's fence, so a source full of junk doesn't raise its own.

Defined cases: null or empty text has no words and fails the base rules; null language or source is a group of its own;
repeated rows are judged alike; an empty table gives an empty result; extra columns are ignored by `judged` and kept
unchanged by `kept_documents`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import kernels as K
from .shared import own_columns, written

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Metrics: name -> (expression over the counts, whole numbers).
METRICS = {
    "symbols": "n_symbols * 1000 div n_words",
    "dup_lines": "n_dup_lines * 1000 div n_lines",
    "repeats": "n_repeat_words * 1000 div n_words",
    "word_length": "word_chars * 100 div n_words",
}
#: A document is rejected above median + SPREAD * (upper quartile - median), but never below these values ...
UPPER = {"symbols": 300, "dup_lines": 300, "repeats": 300, "word_length": 1500}
#: ... and below median - SPREAD * (median - lower quartile), but never above these.
LOWER = {"word_length": 200}
SPREAD = 8
MIN_GROUP = 200
#: Fences by the sketches alone: the distance in spreads, and what is added where a group has no spread.
FAR = 3
ALLOWANCE = {"symbols": 20, "dup_lines": 50, "repeats": 50, "word_length": 50}


def _counts(batch: pa.RecordBatch, text: int) -> list[np.ndarray]:
    data, bounds = K.text_bytes(batch.column(text))
    starts, ends, before = K.word_bounds(data, bounds)
    n_words = np.diff(before)
    lead = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=lead[1:])
    word_chars = K.segment_sums(lead[ends] - lead[starts], before)
    symbol = np.zeros(256, bool)
    symbol[list(SYMBOLS.encode())] = True
    n_symbols = K.segment_sums(symbol[data], bounds)

    breaks = np.flatnonzero(data == 10)
    line_starts = np.sort(np.concatenate([bounds[:-1], breaks + 1]))
    line_ends = np.sort(np.concatenate([breaks, bounds[1:]]))
    with_word = np.searchsorted(starts, line_ends) > np.searchsorted(starts, line_starts)
    line_starts, line_ends = line_starts[with_word], line_ends[with_word]
    rows = np.searchsorted(bounds, line_starts, "right") - 1
    n_lines = np.bincount(rows, minlength=len(bounds) - 1)
    keys = np.unique(K.span_hashes(data, line_starts, line_ends) ^ K.mixed(rows + 1), return_index=True)[1]
    n_dup_lines = n_lines - np.bincount(rows[keys], minlength=len(bounds) - 1)

    triples = K.window_hashes(K.span_hashes(data, starts, ends), 3)
    word_rows = K.rows_of(before)
    repeated = np.zeros(len(starts), bool)
    if len(triples):
        inside = np.flatnonzero(word_rows[2:] == word_rows[: len(triples)])
        key = triples[inside] ^ K.mixed(word_rows[inside] + 1)
        order = np.argsort(key)
        same = np.flatnonzero(key[order][1:] == key[order][:-1])
        at = inside[np.concatenate([order[same], order[same + 1]])]
        for i in range(3):
            repeated[at + i] = True
    return [n_words, word_chars, n_symbols, n_dup_lines, K.segment_sums(repeated, before), n_lines]


def with_counts(df: DataFrame, text: str, name: str) -> DataFrame:
    """The same rows with a struct `name` of COUNTS. One pass over the scan, no shuffle."""
    counts = T.StructType([T.StructField(c, T.LongType()) for c in COUNTS])
    at = df.columns.index(text)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in K.slices(batches, at):
            values = [pa.array(x.astype(np.int64)) for x in _counts(batch, at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.StructArray.from_arrays(values, names=COUNTS)], names=[*batch.schema.names, name])

    return df.mapInArrow(scan, T.StructType([*df.schema.fields, T.StructField(name, counts)]))


def sketches(counted: DataFrame) -> DataFrame:
    """(lang, source, metric, bucket, n): one sketch for each language, source and metric."""
    long = counted.where("n_words > 0").select("lang", "source", F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.expr(e).alias("v")) for m, e in METRICS.items()])).alias("x")).select("lang", "source", "x.*")
    shift = F.greatest(F.length(F.bin("v")) - 6, F.lit(0))
    bucket = F.call_function("shiftleft", F.call_function("shiftright", F.col("v"), shift), shift)
    return long.groupBy("lang", "source", "metric", bucket.alias("bucket")).agg(F.count("*").alias("n"))


def quantiles(sketch: DataFrame, keys: list[str], **percents: int) -> DataFrame:
    """Merge the sketches down to `keys` and read them: keys, metric, size and the named percentiles."""
    merged = sketch.groupBy(*keys, "metric", "bucket").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*keys, "metric")
    running = merged.withColumns({"total": F.sum("n").over(group), "upto": F.sum("n").over(group.orderBy("bucket"))})
    at = lambda percent: F.min(F.when(F.col("upto") * 100 >= F.col("total") * percent, F.col("bucket")))
    return running.groupBy(*keys, "metric").agg(F.max("total").alias("size"), *[at(p).alias(name) for name, p in percents.items()])


def _pick(metric: str, x: Column) -> Column:
    return F.max(F.when(F.col("metric") == metric, x))


def fences(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """Merge the sketches down to `keys` and read their fences: keys, size, lo_<metric>, hi_<metric>."""
    quartiles = quantiles(sketch, keys, q25=25, q50=50, q75=75)
    hi, lo = F.expr(f"q50 + {SPREAD} * (q75 - q50)"), F.expr(f"q50 - {SPREAD} * (q50 - q25)")
    return quartiles.groupBy(*keys).agg(
        F.max("size").alias("size"),
        *[_pick(m, F.greatest(hi, F.lit(v))).alias(f"hi_{m}") for m, v in UPPER.items()],
        *[_pick(m, F.least(lo, F.lit(v))).alias(f"lo_{m}") for m, v in LOWER.items()],
    )


def sketch_fences(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """As fences, without fixed values; also near_<fence>, the decile with its allowance, which smaller groups don't go below."""
    deciles = quantiles(sketch, keys, q10=10, q50=50, q90=90)
    out = []
    for side, metrics, near, far in (("hi", UPPER, "q90 + {a}", "q90 + {a} + {f} * (q90 - q50)"), ("lo", LOWER, "q10 - {a}", "q10 - {a} - {f} * (q50 - q10)")):
        for m in metrics:
            out += [_pick(m, F.expr(e.format(a=ALLOWANCE[m], f=FAR))).alias(name) for name, e in ((f"{side}_{m}", far), (f"near_{side}_{m}", near))]
    return deciles.groupBy(*keys).agg(F.max("size").alias("size"), *out)


def limits(sketch: DataFrame, by_sketch: bool = False) -> DataFrame:
    """One row of fences for each language and source; small groups borrow from their language, then from all."""
    names = [*(f"hi_{m}" for m in UPPER), *(f"lo_{m}" for m in LOWER)]
    read, also = (sketch_fences, [f"near_{n}" for n in names]) if by_sketch else (fences, [])
    own, by_lang, overall = (read(sketch, keys).select(*keys, F.struct("size", *names, *also).alias(level)) for keys, level in ((["lang", "source"], "own"), (["lang"], "by_lang"), ([], "overall")))
    by_lang = by_lang.withColumnRenamed("lang", "lang_")
    joined = own.join(by_lang, F.col("lang").eqNullSafe(F.col("lang_"))).crossJoin(F.broadcast(overall))  # the last is a single row

    def of_own(name: str) -> Column:
        if not by_sketch:
            return F.col(f"own.{name}")
        inner, outer = (F.greatest, F.least) if name.startswith("hi_") else (F.least, F.greatest)
        return outer(F.col(f"by_lang.{name}"), inner(F.col(f"own.{name}"), F.col(f"by_lang.near_{name}")))

    chosen = lambda name: F.when(F.col("own.size") >= MIN_GROUP, of_own(name)).when(F.col("by_lang.size") >= MIN_GROUP, F.col(f"by_lang.{name}")).otherwise(F.col(f"overall.{name}"))
    return joined.select(F.col("lang").alias("lang_"), F.col("source").alias("source_"), *[chosen(n).alias(n) for n in names])


BASE_FAILED = f"n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words"


def with_verdict(counted: DataFrame, limit: DataFrame) -> DataFrame:
    """Join each row with its group's fences (a few rows a group; null-safe) and decide."""
    joined = counted.join(limit, counted["lang"].eqNullSafe(limit["lang_"]) & counted["source"].eqNullSafe(limit["source_"]), "left")
    inside = " AND ".join([*(f"{METRICS[m]} <= hi_{m}" for m in UPPER), *(f"{METRICS[m]} >= lo_{m}" for m in LOWER)])
    return joined.withColumn("base_failed", F.expr(BASE_FAILED)).withColumn("kept", F.expr(f"CASE WHEN base_failed THEN false ELSE {inside} END")).drop("lang_", "source_", *[f"hi_{m}" for m in UPPER], *[f"lo_{m}" for m in LOWER])


def judged(documents: DataFrame, by_sketch: bool = False) -> DataFrame:
    """documents (doc_id, text, lang, source) -> doc_id, the counts, base_failed, kept."""
    counted = with_counts(own_columns(documents, ["doc_id", "text", "lang", "source"]), "text", "c").select("doc_id", "lang", "source", "c.*")
    counted = written(counted, "quality-counts")  # narrow; read by the sketch and by the verdict
    result = with_verdict(counted, written(limits(sketches(counted), by_sketch), "quality-limits"))
    return result.select("doc_id", *COUNTS[:-1], "base_failed", "kept")


def kept_documents(documents: DataFrame, by_sketch: bool = False) -> DataFrame:
    """The documents that pass, with all their columns. Two passes over the texts; only counts are shuffled."""
    name = "counts"
    while name in documents.columns:
        name += "_"
    rows = with_counts(documents, "text", name)
    counted = rows.select("lang", "source", f"{name}.*")
    limit = written(limits(sketches(counted), by_sketch), "quality-limits")
    packed = rows.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"), F.col("lang"), F.col("source"), f"{name}.*")
    return with_verdict(packed, limit).where("kept").select("row.*")
