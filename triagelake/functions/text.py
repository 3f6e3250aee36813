"""Text clean-up and feature extraction as Catalyst expressions."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .base import col, text_array

# Characters that survive the clean-up (besides blanks).
KEPT_CHARACTERS = "abcdefghijklmnopqrstuvwxyz0123456789àèìòù"
# Spelled out and not as ranges: Java tests a class of single latin-1 characters
# with one bit lookup, several times faster than a union of ranges.
DROPPED_RUN = f"[^{KEPT_CHARACTERS}]+"

# Blanks as the Unicode standard lists them (what str.strip() removes).
BLANKS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 " + "".join(
    chr(c) for c in (*range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
)

# Blocks holding characters whose NFKC form matters to the clean-up: combining
# marks, and compatibility forms of latin letters and digits. Text without them
# gives the same result with or without NFKC (tests/test_text.py goes through
# every code point), so only rows with a hit are sent to Python.
NFKC_BLOCKS = (
    (0xAA, 0xAA), (0xB2, 0xB3), (0xB9, 0xBA), (0xBC, 0xBE),
    (0x132, 0x133), (0x13F, 0x140), (0x149, 0x149), (0x17F, 0x17F),
    (0x1C4, 0x1CC), (0x1F1, 0x1F3), (0x2B0, 0x2B8), (0x2E0, 0x2E4),
    (0x300, 0x36F), (0x1AB0, 0x1AFF), (0x1D2C, 0x1D6A), (0x1D78, 0x1D78),
    (0x1D9B, 0x1DFF), (0x1E9A, 0x1E9B), (0x2070, 0x209F), (0x20A8, 0x20A8), (0x20D0, 0x20FF),
    (0x2100, 0x218F), (0x2460, 0x24FF), (0x2C7C, 0x2C7D), (0x3250, 0x325F),
    (0x32B1, 0x32CF), (0x3358, 0x33FF), (0xA7F2, 0xA7F9), (0xFB00, 0xFB06),
    (0xFE20, 0xFE2F), (0xFF00, 0xFFEF), (0x1D400, 0x1D7FF), (0x1F100, 0x1F1FF),
    (0x10780, 0x107BF), (0x1FBF0, 0x1FBFF),
)
NFKC_PATTERN = "[" + "".join(f"\\x{{{lo:x}}}-\\x{{{hi:x}}}" for lo, hi in NFKC_BLOCKS) + "]"


def _nfkc(c: Column) -> Column:
    # defined inside, so that it travels to executors by value
    def fold(values: pd.Series) -> pd.Series:
        return values.map(lambda v: None if v is None else unicodedata.normalize("NFKC", v))

    return F.pandas_udf(fold, StringType())(c)


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(BLANKS))


def match_text(c: Column) -> Column:
    """Lower-case, keep letters/digits, single spaces; null becomes ''.

    Blanks and dropped characters both end up as separators, so one pattern
    covers a whole run of them.
    """
    runs = F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), DROPPED_RUN, " ")
    return F.trim(runs)


def clean_text(c: Column, nfkc: bool = True) -> Column:
    """Model text: :func:`match_text` with an NFKC step after lower-casing.

    Spark has no NFKC built-in. The Arrow UDF gets only the texts holding a
    character the step can change and null for all others.
    """
    if not nfkc:
        return match_text(c)
    low = F.lower(F.coalesce(c, F.lit("")))
    # two cheap tests let most text skip the long pattern
    suspect = low.rlike("[^\\x00-\\xff]") | low.rlike("[ª²³¹º¼½¾]")
    folded = F.coalesce(_nfkc(F.when(suspect & low.rlike(NFKC_PATTERN), low)), low)
    # no second lower(): upper-case letters NFKC brings in are dropped like any other sign
    return F.trim(F.regexp_replace(folded, DROPPED_RUN, " "))


def merge_title_body(title: Column, body: Column, body_weight: int = 2) -> Column:
    """Title once, body ``body_weight`` times, blank parts left out."""
    t = F.nullif(strip(F.coalesce(title, F.lit(""))), F.lit(""))
    b = F.nullif(strip(F.coalesce(body, F.lit(""))), F.lit(""))
    return F.concat_ws(" ", t, *[b] * max(1, int(body_weight)))


def prepare_text(
    df: DataFrame,
    title: str = "title",
    body: str = "body",
    out: str = "text",
    body_weight: int = 2,
    nfkc: bool = True,
    null_as: str = "",
) -> DataFrame:
    """Add the model text column. ``null_as='nan'`` spells missing cells out.

    Cleaning the merged text equals merging the cleaned parts, since the parts
    meet at a blank; this way the body is cleaned once and not once per copy.
    """
    def part(name: str) -> Column:
        c = col(name).cast("string") if name in df.columns else F.lit("")
        return clean_text(F.coalesce(c, F.lit(null_as)), nfkc)

    df = df.withColumns({"_title": part(title), "_body": part(body)})
    t, b = F.nullif("_title", F.lit("")), F.nullif("_body", F.lit(""))
    return df.withColumn(out, F.concat_ws(" ", t, *[b] * max(1, int(body_weight)))).drop("_title", "_body")


def tokens(text: Column) -> Column:
    """Words of an already clean text; '' gives an empty array."""
    return F.when(text == "", text_array([])).otherwise(F.split(text, " "))


def safe_text(c: Column) -> Column:
    """One-line text, never blank."""
    one_line = strip(F.replace(F.coalesce(c, F.lit("")), F.lit("\n"), F.lit(" ")))
    return F.when(one_line == "", F.lit("vuoto")).otherwise(one_line)


def _joined_windows(words: Column, n: int) -> Column:
    # zip the words with themselves shifted by 1, 2, ...: the array is evaluated n
    # times in all, where a lambda looking into it would do so once per word
    out = words
    for shift in range(1, n):
        rest = F.slice(words, F.lit(shift + 1), F.lit(10**9))
        out = F.zip_with(out, rest, lambda a, b: F.concat(a, F.lit(" "), b))
    return F.array_compact(out)


def word_ngrams(words: Column, low: int = 1, high: int = 2) -> Column:
    """Contiguous word n-grams for n = low..high, joined by a space, n by n."""
    parts = []
    for n in range(low, high + 1):
        parts.append(words if n == 1 else _joined_windows(words, n))
    return F.concat(*parts) if len(parts) > 1 else parts[0]


def char_wb_ngrams(words: Column, low: int, high: int) -> Column:
    """Character n-grams inside blank-padded words.

    A padded word shorter than n gives itself once and no longer n-grams.
    """
    def of_word(w: Column) -> Column:
        padded = F.concat(F.lit(" "), w, F.lit(" "))
        size = F.length(padded)

        def of_size(n: Column) -> Column:
            last = F.greatest(size - n + F.lit(1), F.lit(1))
            return F.transform(F.sequence(F.lit(1), last), lambda i: F.substring(padded, i, n))

        top = F.greatest(F.lit(low), F.least(F.lit(high), size))
        return F.flatten(F.transform(F.sequence(F.lit(low), top), of_size))

    return F.flatten(F.transform(words, of_word))
