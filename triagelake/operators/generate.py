"""Synthetic labelled reviews and text noise, one row at a time.

Every choice is a seeded hash draw of the row id, so a row comes out the same
whatever the partitioning. Sentence pools are data: the short defaults below
can be replaced by a corpus of one's own.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.base import col, hash_hex, lit_d, text_array, uniform
from ..sources.materialise import materialise
from .ranking import hex_bucket, row_ranks

DEPARTMENTS = ("Housekeeping", "Reception", "F&B")
SENTIMENTS = ("pos", "neg")

# --- Fixed values: profile probabilities, part probabilities, typos ----------
PROFILES = {
    "train": {
        "ambiguity": 0.24,
        "mixed": 0.35,
        "noise": 0.00,
        "neutral_title": 0.52,
        "title_hint": 0.22,
        "colloquial": 0.48,
        "story": 0.40,
        "context": 0.34,
        "dep_flip": 0.03,
        "sent_flip": 0.06,
    },
    "ambiguous": {
        "ambiguity": 0.62,
        "mixed": 0.70,
        "noise": 0.03,
        "neutral_title": 0.70,
        "title_hint": 0.16,
        "colloquial": 0.58,
        "story": 0.48,
        "context": 0.44,
        "dep_flip": 0.10,
        "sent_flip": 0.13,
    },
    "colloquial": {
        "ambiguity": 0.32,
        "mixed": 0.28,
        "noise": 0.04,
        "neutral_title": 0.78,
        "title_hint": 0.10,
        "colloquial": 0.88,
        "story": 0.76,
        "context": 0.68,
        "dep_flip": 0.00,
        "sent_flip": 0.00,
    },
    "noisy": {
        "ambiguity": 0.46,
        "mixed": 0.55,
        "noise": 0.18,
        "neutral_title": 0.62,
        "title_hint": 0.18,
        "colloquial": 0.54,
        "story": 0.44,
        "context": 0.38,
        "dep_flip": 0.10,
        "sent_flip": 0.18,
    },
}
OPENING_SHARE = 0.78
CLOSING_SHARE = 0.62
NOISE_LEVEL = 0.13
SEVERE_SHARE = 0.80
PHRASE_TYPOS = (("check in", "checkin"), ("check out", "checkout"), ("aria condizionata", "aria condizionta"))
WORD_TYPOS = {
    "servizio": "servizo", "camera": "camra", "colazione": "colazzione", "prenotazione": "prenotazone",
    "personale": "personle", "fattura": "fatura", "pulizia": "puliza", "ristorante": "ristornte",
    "asciugamani": "asciugamni", "problemi": "problemii",
}
TRAILING_SIGNS = ".,;:!?"
SECTION_SEEDS = (  # (section, profile, seed offset)
    ("reviews_in_distribution.csv", "train", 101),
    ("reviews_ambiguous.csv", "ambiguous", 202),
    ("reviews_noisy.csv", "noisy", 303),
    ("reviews_safety_critical.csv", None, 404),
    ("reviews_colloquial.csv", "colloquial", 505),
)
# -----------------------------------------------------------------------------


@dataclass(frozen=True)
class Corpus:
    """Sentence pools. Keys are sentiment, department, or 'department/sentiment'."""

    topics: Mapping[str, Sequence[str]] = field(default_factory=lambda: {
        "Housekeeping": ("camera", "bagno", "lenzuola", "letto", "pulizia", "aria condizionata"),
        "Reception": ("check in", "check out", "prenotazione", "fattura", "parcheggio", "attesa"),
        "F&B": ("colazione", "cena", "ristorante", "buffet", "cameriere", "menu"),
    })
    openings: Sequence[str] = ("Soggiorno di due notti.", "Scrivo appena rientrato.", "Viaggio in famiglia.")
    sentences: Mapping[str, Sequence[str]] = field(default_factory=lambda: {
        "pos": ("Giudizio finale buono.", "Ci tornerei subito.", "Tutto ottimo, personale gentile."),
        "neg": ("Giudizio finale deludente.", "Troppi problemi.", "Servizio pessimo per il prezzo."),
    })
    department: Mapping[str, Sequence[str]] = field(default_factory=lambda: {
        "pos": ("Bene {a} e anche {b}.", "Nulla da ridire su {a} e {b}."),
        "neg": ("Male {a} e pure {b}.", "Da rivedere {a} insieme a {b}."),
    })
    contexts: Mapping[str, Sequence[str]] = field(default_factory=lambda: {
        "pos": ("Eravamo in quattro e nessuno si è lamentato.", "In una settimana di pioggia ci ha salvato le giornate."),
        "neg": ("Eravamo in quattro e ci siamo innervositi tutti.", "In una settimana di pioggia non c'era altro da fare."),
    })
    mixed: Mapping[str, Sequence[str]] = field(default_factory=lambda: {
        "pos": ("Un paio di cose però andrebbero sistemate.",),
        "neg": ("La buona volontà di chi lavora lì si vedeva.",),
    })
    cross: Sequence[str] = ("Si è aggiunto anche il tema di {a} e {b}.", "Segnalo pure {a} e {b}.")
    closings: Mapping[str, Sequence[str]] = field(default_factory=lambda: {
        "pos": ("Consigliato.", "Per noi promosso."), "neg": ("Non lo consiglio.", "Spero migliorino."),
    })
    titles: Mapping[str, Sequence[str]] = field(default_factory=lambda: {
        "pos": ("Soggiorno riuscito", "Esperienza positiva"), "neg": ("Esperienza da dimenticare", "Molti problemi"),
        "neutral": ("Due righe sul soggiorno", "Il mio parere"),
    })
    hints: Mapping[str, str] = field(default_factory=lambda: {
        "Housekeeping": "sulla camera", "Reception": "alla reception", "F&B": "al ristorante",
    })
    severe: Mapping[str, Sequence[str]] = field(default_factory=lambda: {
        "Housekeeping": ("Muffa in bagno e cimici da letto, odore nauseante.", "Acari nel materasso, camera insalubre."),
        "Reception": ("Segnalati scarafaggi alla reception, nessun intervento.", "Puzzava di muffa e al desk nessuna risposta."),
        "F&B": ("Scarafaggi in cucina durante la cena.", "Blatte vicino al buffet, igiene pessima."),
    })
    negated: Mapping[str, Sequence[str]] = field(default_factory=lambda: {
        "Housekeeping": ("Camera pulita, nessuna muffa e letto comodo.",),
        "Reception": ("Reception gentile, nessun problema segnalato.",),
        "F&B": ("Cucina pulita e colazione ottima, nessun odore.",),
    })


def choose(pool: Sequence[str], draw: Column) -> Column:
    """Entry of a fixed pool picked by a draw in [0, 1)."""
    return F.get(text_array(pool), F.floor(draw * lit_d(len(pool))).cast("int"))


def choose_by(key: Column, pools: Mapping[str, Sequence[str]], draw: Column) -> Column:
    out = None
    for k, pool in pools.items():
        out = F.when(key == k, choose(pool, draw)) if out is None else out.when(key == k, choose(pool, draw))
    return out


def other_of(value: Column, values: Sequence[str], draw: Column) -> Column:
    """A different member of ``values``, evenly."""
    return choose_by(value, {v: [w for w in values if w != v] for v in values}, draw)


def balanced_plan(ids: DataFrame, seed: int, buckets: int, key: str = "id", out: str = "bucket") -> DataFrame:
    """Deal rows out evenly over ``buckets`` in hash order: sizes differ by one at most."""
    hashed = ids.withColumn("_h", hash_hex(col(key), f"{seed}-plan"))
    ranked = row_ranks(hashed, [], hex_bucket(F.col("_h"), 0), [F.col("_h"), col(key)], "_rank")
    return ranked.withColumn(out, F.pmod(F.col("_rank"), F.lit(buckets)).cast("int")).drop("_h", "_rank")


def label_noise(df: DataFrame, seed: int, profile: str = "train", key: str = "id") -> DataFrame:
    """Flip department and sentiment labels at the rates of a profile."""
    rates = PROFILES[profile]
    draw = lambda salt: uniform(col(key), f"{seed}-{salt}")
    flipped = F.when(col("sentiment") == "pos", "neg").otherwise("pos")
    return df.withColumns({
        "department": F.when(
            draw("dep") < rates["dep_flip"], other_of(col("department"), DEPARTMENTS, draw("dep_to"))
        ).otherwise(col("department")),
        "sentiment": F.when(draw("sent") < rates["sent_flip"], flipped).otherwise(col("sentiment")),
    })


def typo_noise(
    df: DataFrame, seed: int, text: str = "body", key: str = "id", level: float = NOISE_LEVEL,
    phrases: Sequence[tuple[str, str]] = PHRASE_TYPOS, words: Mapping[str, str] = WORD_TYPOS,
) -> DataFrame:
    """Misspell known phrases and words and drop a comma, each with chance ``level``.

    A phrase is misspelt at its first occurrence. Words are compared without
    surrounding punctuation and case; one trailing sign is kept.
    """
    draw = lambda salt: uniform(col(key), f"{seed}-{salt}")
    for i, (right, wrong) in enumerate(phrases):
        # one projection per phrase: nested in a single expression, the text would be repeated over and over
        c = col(text)
        at = F.instr(c, F.lit(right))
        swapped = F.concat(F.substring(c, F.lit(1), at - 1), F.lit(wrong), F.substring(c, at + len(right), F.length(c)))
        df = df.withColumn(text, F.when((at > 0) & (draw(f"phrase{i}") < level), swapped).otherwise(c))
    df = df.withColumn("_words", F.filter(F.split(col(text), r"\s+"), lambda w: w != ""))
    table = F.create_map(*[F.lit(x) for pair in words.items() for x in pair])

    def one(w: Column, i: Column) -> Column:
        base = F.lower(F.btrim(w, F.lit(TRAILING_SIGNS)))
        last = F.right(w, F.lit(1))
        kept = F.when(F.contains(F.lit(TRAILING_SIGNS), last), last).otherwise(F.lit(""))
        gate = uniform(F.concat_ws(":", col(key).cast("string"), i.cast("string")), f"{seed}-word") < level
        return F.when(base.isin(*words), F.when(gate, F.concat(F.try_element_at(table, base), kept)).otherwise(w)).otherwise(w)

    df = df.withColumn("_joined", F.array_join(F.transform("_words", one), " "))
    joined = F.col("_joined")
    comma = F.instr(joined, ",")
    without = F.concat(F.substring(joined, F.lit(1), comma - 1), F.substring(joined, comma + 1, F.length(joined)))
    return df.withColumn(
        text, F.when((comma > 0) & (draw("comma") < level), without).otherwise(joined)
    ).drop("_words", "_joined")


def synthetic_reviews(ids: DataFrame, seed: int, profile: str = "train", key: str = "id", corpus: Corpus | None = None) -> DataFrame:
    """(id, title, body, department, sentiment) for every id: balanced over the six
    label pairs, text from the clean labels, then label noise and typos."""
    corpus = corpus or Corpus()
    p = PROFILES[profile]
    draw = lambda salt: uniform(col("id"), f"{seed}-{salt}")
    plan = balanced_plan(ids.select(col(key).alias("id")), seed, len(DEPARTMENTS) * len(SENTIMENTS))
    rows = plan.select(
        "id",
        F.get(text_array(DEPARTMENTS), (F.col("bucket") / 2).cast("int")).alias("department"),
        F.get(text_array(SENTIMENTS), F.pmod(F.col("bucket"), F.lit(2))).alias("sentiment"),
    )
    dep, sent = col("department"), col("sentiment")
    some = lambda salt, share, value: F.when(draw(salt) < share, value)

    def filled(template: Column, department: Column, salt: str) -> Column:
        first = choose_by(department, corpus.topics, draw(f"{salt}_a"))
        rest = {d: list(t[1:]) + [t[0]] for d, t in corpus.topics.items()}  # neighbour in the list: never the same topic
        second = choose_by(department, rest, draw(f"{salt}_a"))
        return F.replace(F.replace(template, F.lit("{a}"), first), F.lit("{b}"), second)

    rows = rows.withColumn("_other", other_of(dep, DEPARTMENTS, draw("other")))
    neutral = draw("neutral") < p["neutral_title"]
    title = F.when(neutral, choose(corpus.titles["neutral"], draw("title"))).otherwise(
        choose_by(sent, {s: corpus.titles[s] for s in SENTIMENTS}, draw("title"))
    )
    hint = choose_by(dep, {d: [h] for d, h in corpus.hints.items()}, draw("title"))
    rows = rows.withColumns({
        "title": F.concat_ws(" - ", title, some("hint", p["title_hint"], hint)),
        "body": F.concat_ws(
            " ",
            some("open", OPENING_SHARE, choose(corpus.openings, draw("opening"))),
            filled(choose_by(sent, corpus.department, draw("department")), dep, "topic"),
            some("context", p["context"], choose_by(sent, corpus.contexts, draw("context_text"))),
            choose_by(sent, corpus.sentences, draw("sentence")),
            some("mixed", p["mixed"], choose_by(sent, corpus.mixed, draw("mixed_text"))),
            some("cross", p["ambiguity"], filled(choose(corpus.cross, draw("cross_text")), F.col("_other"), "cross_topic")),
            some("close", CLOSING_SHARE, choose_by(sent, corpus.closings, draw("closing"))),
        ),
    }).drop("_other")
    if p["noise"] > 0:
        # rows without noise go through as null, which costs the noise step nothing
        gated = rows.withColumns({"_plain": col("body"), "body": F.when(draw("noise") < p["noise"], col("body"))})
        rows = typo_noise(gated, seed).withColumn("body", F.coalesce("body", "_plain")).drop("_plain")
    # a generated set is made once and read often; written out, later filters on its
    # text do not pull the whole generation into their conditions
    return label_noise(materialise(rows), seed, profile).select("id", "title", "body", "department", "sentiment")


def safety_reviews(ids: DataFrame, seed: int, key: str = "id", corpus: Corpus | None = None) -> DataFrame:
    """Safety-critical set: hazards called negative, negated hazards called positive."""
    corpus = corpus or Corpus()
    draw = lambda salt: uniform(col("id"), f"{seed}-{salt}")
    plan = balanced_plan(ids.select(col(key).alias("id")), seed, len(DEPARTMENTS))
    rows = plan.select("id", F.get(text_array(DEPARTMENTS), F.col("bucket")).alias("department"))
    severe = draw("severe") < SEVERE_SHARE
    dep = col("department")
    body = F.when(severe, choose_by(dep, corpus.severe, draw("body"))).otherwise(choose_by(dep, corpus.negated, draw("body")))
    label = F.when(severe, F.lit("neg")).otherwise(F.lit("pos"))
    title = F.concat(F.when(severe, F.lit("Segnalazione igiene")).otherwise(F.lit("Verifica igiene")), F.lit(" - "), dep)
    return rows.select("id", title.alias("title"), body.alias("body"), "department", label.alias("sentiment"))


def benchmark_family(ids: DataFrame, seed: int = 42, key: str = "id", corpus: Corpus | None = None) -> DataFrame:
    """All benchmark sections as one table with a ``section`` column, each under its own seed."""
    out = None
    for section, profile, offset in SECTION_SEEDS:
        part = (
            safety_reviews(ids, seed + offset, key, corpus) if profile is None
            else synthetic_reviews(ids, seed + offset, profile, key, corpus)
        ).withColumn("section", F.lit(section))
        out = part if out is None else out.unionByName(part)
    return out
