"""License scan by a positional index of rare words, in DataFrame operations alone.

Templates are word sequences with a mandatory key phrase. Each is posted under one licence word of its phrase, the one with
the highest IDF over all documents. Every posted word of a document is looked up, and each posting proposes where its template
would begin. All proposals are verified: the mandatory phrase must stand at its position, and the share of the template's words
in place is the score. As a phrase can't stand anywhere without its posted word, no place is missed.

Templates, phrases and vocabulary are parameters of fixed size, so they travel as literals in the plan; every step after the
IDF counts is local to the row, and nothing is shuffled but those counts.

Defined cases: null or empty text has no words, no places and empty labels; repeated rows are judged alike; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import ascii_lower, own_columns, written

LOWERED_WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
#: Phrases and their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
#: Fixed values: (label, template, mandatory key phrase, a part of the template).
TEMPLATES = [
    ("mit", "released under the mit license", "mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", "hereby granted free of charge"),
    ("apache", "licensed under the apache license version 2 0", "apache license"),
    ("gpl", "licensed under the gnu general public license version 3", "general public license"),
    ("lgpl", "licensed under the gnu lesser general public license", "lesser general public license"),
    ("agpl", "licensed under the gnu affero general public license", "affero general public license"),
    ("mpl", "subject to the terms of the mozilla public license", "mozilla public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution and use in source and binary forms"),
    ("bsd", "released under the bsd license", "bsd license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose", "distribute this software for any purpose"),
    ("unlicense", "free and unencumbered software released into the public domain", "unencumbered software"),
    ("cc-by", "licensed under cc by 4 0", "cc by 4"),
    ("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by-nd", "licensed under cc by nd 4 0", "cc by nd"),
]
#: Words of the templates that are too common to be looked up.
COMMON = "a and any are by for forms in into is of or the this to use with without 0 2 3 4 copy person source".split()
#: Every mandatory or base phrase holds one of these; other documents hold no template.
GATES = ["license", "licence", "hereby", "redistribution", "unencumbered", "distribute", "cc by", "cc-by"]
#: The same for words with other characters between them.
GATE_PATTERN = "cc[^a-z0-9]+by"
#: Share of a template's words that must stand in place.
LEAST = 0.5


def _array(values: list) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _words(phrase: str) -> list[str]:
    return phrase.split()


VOCABULARY = sorted({w for _, t, _ in TEMPLATES for w in _words(t)} - set(COMMON))


def rarest_words(idf: dict[str, float]) -> dict[str, list[tuple[int, int]]]:
    """word -> (template, position of the word in it): for each template the rarest licence word of its mandatory phrase."""
    out: dict[str, list[tuple[int, int]]] = {}
    for k, (_, template, phrase) in enumerate(TEMPLATES):
        words, wanted = _words(template), _words(phrase)
        at = _phrase_at(words, wanted)
        i = min((i for i, w in enumerate(wanted) if w in VOCABULARY), key=lambda i: (-idf[wanted[i]], wanted[i], i))
        out.setdefault(wanted[i], []).append((k, at + i))
    return out


def _phrase_at(words: list[str], phrase: list[str]) -> int:
    return next(i for i in range(len(words)) if words[i : i + len(phrase)] == phrase)


def _templates() -> Column:
    return F.array(*[F.struct(F.lit(label).alias("label"), _array(_words(t)).alias("words"), _array(_words(p)).alias("phrase"), F.lit(_phrase_at(_words(t), _words(p))).alias("at")) for label, t, p in TEMPLATES])


def gated(text: Column) -> Column:
    """Whether a document may hold a template. lower() only widens the gate."""
    lowered = F.lower(text)
    gate = lowered.contains(GATES[0])
    for g in GATES[1:]:
        gate = gate | lowered.contains(g)
    return gate | lowered.rlike(GATE_PATTERN)


def idf_of(rows: DataFrame, total: int) -> dict[str, float]:
    """IDF of each licence word over all documents; at most one entry for each word of the vocabulary."""
    seen = rows.select(F.explode("licence_words").alias("word")).groupBy("word").agg(F.count("*").alias("df"))
    found = {r["word"]: r["df"] for r in seen.collect()}
    return {w: (total + 1) / (found.get(w, 0) + 1) for w in VOCABULARY}


def places_of(words: Column) -> Column:
    """Array of (word position, label) of the base phrases, in order of position."""
    last = {tuple(_words(p)): label for p, label in BASE.items()}
    starts = F.filter(F.transform(words, lambda w, i: F.when(w == "license", i)), lambda i: i.isNotNull())

    def labelled(i: Column) -> Column:
        out = F.lit(None).cast("struct<start:int,label:string>")
        for phrase, label in last.items():
            n = len(phrase)
            fits = i >= n - 1
            for j, w in enumerate(phrase[:-1]):
                fits = fits & (F.get(words, i - (n - 1 - j)) == w)
            out = F.when(fits, F.struct((i - (n - 1)).alias("start"), F.lit(label).alias("label"))).otherwise(out)
        return out

    return F.filter(F.transform(starts, labelled), lambda x: x.isNotNull())


def matches_of(words: Column, idf: dict[str, float]) -> Column:
    """Array of (label, score) of the verified templates."""
    posted = rarest_words(idf)
    placed = F.transform(words, lambda w, i: F.struct(w.alias("w"), i.alias("i")))
    hits = F.filter(placed, lambda x: x["w"].isin(*posted))
    places = lambda posts: F.array(*[F.struct(F.lit(k).alias("k"), F.lit(i).alias("i")) for k, i in posts])
    postings, templates = F.create_map(*[x for word, posts in posted.items() for x in (F.lit(word), places(posts))]), _templates()
    begins = F.flatten(F.transform(hits, lambda h: F.transform(F.element_at(postings, h["w"]), lambda p: F.struct(p["k"].alias("k"), (h["i"] - p["i"]).alias("begin")))))

    def verified(v: Column) -> Column:
        t = F.get(templates, v["k"])
        place = v["begin"] + t["at"]
        phrase = (place >= 0) & (F.slice(words, F.greatest(place, F.lit(0)) + 1, F.size(t["phrase"])) == t["phrase"])
        in_place = F.size(F.filter(F.transform(t["words"], lambda w, i: (v["begin"] + i >= 0) & (F.get(words, F.greatest(v["begin"] + i, F.lit(0))) == w)), lambda same: same))
        return F.when(phrase, F.struct(t["label"].alias("label"), (in_place / F.size(t["words"])).alias("score")))

    return F.filter(F.transform(F.array_distinct(begins), verified), lambda x: x.isNotNull() & (x["score"] >= LEAST))


def scanned(documents: DataFrame) -> DataFrame:
    """documents (doc_id, text) -> doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    texts = own_columns(documents, ["doc_id", "text"]).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    cut = texts.select("doc_id", gated(F.col("text")).alias("gate"), F.regexp_extract_all(ascii_lower(F.col("text")), F.lit(LOWERED_WORD), F.lit(0)).alias("all_words"))
    # word arrays of the gated documents alone; the rest keep their licence words, which the IDF counts over all documents
    base = cut.select(
        "doc_id", F.size("all_words").cast("long").alias("n_words"), F.when(F.col("gate"), F.col("all_words")).alias("words"),
        F.array_intersect(_array(VOCABULARY), "all_words").alias("licence_words"),
    )
    rows = written(base, "license-words")
    idf = idf_of(rows, rows.count())
    none = F.array().cast("array<struct<start:int,label:string>>")
    nothing = F.array().cast("array<struct<label:string,score:double>>")
    found = rows.select(
        "doc_id", "n_words",
        F.when(F.col("words").isNotNull(), places_of(F.col("words"))).otherwise(none).alias("places"),
        F.when(F.col("words").isNotNull(), matches_of(F.col("words"), idf)).otherwise(nothing).alias("matches"),
    )
    labels = lambda *arrays: F.array_join(F.array_sort(F.array_distinct(F.concat(*arrays))), ",")
    return found.select(
        "doc_id", "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min("places")["start"].cast("long").alias("first_word"),
        F.array_max("places")["start"].cast("long").alias("last_word"),
        labels(F.col("places.label")).alias("base_labels"),
        labels(F.col("places.label"), F.col("matches.label")).alias("labels"),
        F.coalesce(F.array_max("matches.score"), F.lit(0.0)).alias("score"),
    )
