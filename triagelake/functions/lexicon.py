"""Cue lexicons and the expressions that score texts with them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.materialise import materialise
from .base import keep_only, text_array, total
from .text import match_text, tokens

# --- Fixed values: default Italian hospitality lexicons ---------------------
NEGATIVE_CUES = (
    "sporco", "sporca", "sporchi", "sporcizia", "orrendo", "orrenda", "orrendi", "orrende",
    "orribile", "orribili", "terribile", "terribili", "inaccettabile", "vergognoso", "vergognosa",
    "puzzolente", "puzza", "puzzava", "muffa", "insalubre", "nauseante", "scarafaggi",
    "scarafaggio", "blatte", "cimici", "acari", "morso", "morsi", "infestazione", "infestata",
    "infestato", "disgustoso", "disgustosa", "schifo", "deludente", "pessimo", "pessima",
    "problema", "problemi", "intoppi", "guasto", "guasti", "rotto", "rotta",
)
NEGATIVE_PHRASES = (
    "odore forte", "bagno sporco", "camera sporca", "servizio pessimo", "attesa lunga",
    "scarafaggi in cucina", "cimici da letto", "peli sul camice", "odore nauseante",
    "igiene pessima", "peli delle ascelle",
)
POSITIVE_CUES = (
    "ottimo", "ottima", "ottimi", "ottime", "spettacolo", "top", "promosso", "promossa",
    "contento", "contenta", "contenti", "contente", "gentile", "gentili", "buono", "buona",
    "buoni", "buone", "pulito", "pulita", "puliti", "pulite", "comodo", "comoda", "comodi",
    "comode", "consigliato", "consigliata", "torneremo", "tornerei",
)
POSITIVE_PHRASES = (
    "si mangia bene", "molto pulito", "davvero pulito", "staff gentile", "staff gentilissimo",
    "posto spettacolo", "ci siamo trovati bene", "rimasta contenta", "rimasto contento",
    "colazione ottima", "camera pulita",
)
HAZARD_CUES = (
    "scarafaggi", "scarafaggio", "blatte", "cimici", "acari", "muffa", "insalubre",
    "infestazione", "puzzolente", "puzzava", "nauseante", "morso", "morsi",
)
HAZARD_PHRASES = (
    "scarafaggi in cucina", "cimici da letto", "acari che ci hanno morso", "peli sul camice",
    "peli delle ascelle", "odore nauseante", "igiene pessima",
)
NEGATORS = ("non", "nessun", "nessuna", "nessuno", "senza", "mai", "niente")
DEPARTMENT_CUES = {
    "Housekeeping": (
        "camera", "stanza", "bagno", "doccia", "lenzuola", "asciugamani", "materasso", "acari",
        "cimici", "muffa", "pulizia", "riordino", "aria condizionata", "letto", "cuscini",
        "polvere", "odore", "peli", "wc", "bidet", "scarafaggi",
    ),
    "Reception": (
        "check in", "check out", "prenotazione", "fattura", "pagamento", "reception",
        "accoglienza", "attesa", "documenti", "desk", "coda", "garage", "navetta", "chiave",
        "chiavi", "parcheggio", "camera pronta", "late check out",
    ),
    "F&B": (
        "colazione", "buffet", "ristorante", "cucina", "menu", "piatti", "cuoco", "bar",
        "bevande", "glutine", "lattosio", "allergia", "allergeni", "cena", "pranzo", "mangia",
        "mangiato", "cameriere", "tavolo", "torta", "compleanno", "cornetti", "cappuccino",
        "aperitivo", "conto",
    ),
}
# Sentinel tokens: (token, cues, whole words only)
SENTINELS = (
    ("__HAS_NEGATION__", (
        "non", "mai", "nessun", "nessuna", "scarso", "scarsa", "pessimo", "deludente", "orrendo",
        "schifo", "male", "freddi", "freddo"), True),
    ("__HAS_POSITIVE_CUE__", (
        "ottimo", "ottima", "spettacolo", "top", "promosso", "promossa", "contento", "contenta",
        "gentile", "gentili", "buonissimo", "buonissima", "consiglio", "torneremo",
        "tornerei"), True),
    ("__HAS_CONTRAST__", ("ma", "pero", "però", "detto questo", "tuttavia", "comunque"), False),
    ("__HAS_INTENSIFIER__", ("molto", "troppo", "davvero", "estremamente", "super"), True),
    ("__HAS_COMPLAINT_CUE__", (
        "problema", "criticita", "criticità", "intoppi", "attesa", "muffa", "allergie", "rumore",
        "scarafaggi", "freddi", "coda", "polvere"), False),
    ("__HAS_FOOD_CONTEXT__", (
        "mangia", "mangiato", "colazione", "cena", "pranzo", "ristorante", "cameriere", "torta",
        "compleanno", "buffet", "cornetti", "cappuccino"), False),
)
# ----------------------------------------------------------------------------


@dataclass(frozen=True)
class CueSet:
    """Single-word cues and multi-word phrases of one polarity."""

    cues: tuple[str, ...]
    phrases: tuple[str, ...] = ()


@dataclass(frozen=True)
class Lexicons:
    """Everything the guardrail and the routing need; pass your own for other data."""

    negative: CueSet = CueSet(NEGATIVE_CUES, NEGATIVE_PHRASES)
    hazard: CueSet = CueSet(HAZARD_CUES, HAZARD_PHRASES)
    positive: CueSet = CueSet(POSITIVE_CUES, POSITIVE_PHRASES)
    negators: tuple[str, ...] = NEGATORS
    departments: Mapping[str, tuple[str, ...]] = field(default_factory=lambda: dict(DEPARTMENT_CUES))

    def polarity(self) -> dict[str, CueSet]:
        return {"negative": self.negative, "hazard": self.hazard, "positive": self.positive}


def negated(words: Column, i: Column, negators: Sequence[str], window: int = 2) -> Column:
    """True when one of the ``window`` words before position ``i`` is a negator."""
    before = [F.coalesce(F.get(words, i - F.lit(k)).isin(*negators), F.lit(False)) for k in range(1, window + 1)]
    out = before[0]
    for b in before[1:]:
        out = out | b
    return out


def live_cues(words: Column, cues: Sequence[str], negators: Sequence[str]) -> Column:
    """Cue occurrences that are not negated, in text order.

    The cue test comes first, so the look-back runs for cue words only.
    """
    if not cues or not negators:
        return keep_only(words, cues)
    return F.filter(words, lambda w, i: w.isin(*cues) & ~negated(words, i, negators))


def phrases_found(text: Column, phrases: Sequence[str]) -> Column:
    """Phrases contained in the text, alphabetical."""
    if not phrases:
        return text_array([])
    found = [F.when(F.contains(text, F.lit(p)), F.lit(p)) for p in sorted(set(phrases))]
    return F.array_compact(F.array(*found))


def with_cue_columns(
    df: DataFrame, lex: Lexicons, text: str = "text", prefix: str = "_cue_", departments: bool = True,
    clean: bool = False,
) -> DataFrame:
    """Add the matched cues and phrases of every lexicon.

    One walk over the words finds the live cues of all polarities together and
    one more the department cues; the per-lexicon columns then look only at the
    handful of hits. Columns added: ``<prefix><polarity>`` and
    ``<prefix><polarity>_ph`` for negative/hazard/positive, and one
    ``<prefix>dep_<name>`` array per department. ``clean`` says that the text
    column comes from the clean-up already, which leaves such text as it is.
    """
    t = F.col(text) if clean else match_text(F.col(text))
    df = df.withColumn(f"{prefix}text", t)
    t = F.col(f"{prefix}text")
    df = df.withColumn(f"{prefix}words", tokens(t))
    words = F.col(f"{prefix}words")

    polarity = lex.polarity()
    every_cue = sorted({c for s in polarity.values() for c in s.cues})
    singles = {d: [c for c in dict.fromkeys(cs) if " " not in c] for d, cs in lex.departments.items()}
    multi = {d: sorted({c for c in cs if " " in c}) for d, cs in lex.departments.items()}
    every_dep = sorted({c for cs in singles.values() for c in cs})

    hits = {f"{prefix}live": live_cues(words, every_cue, lex.negators)}
    if departments:
        hits[f"{prefix}dep"] = (
            F.array_distinct(keep_only(words, every_dep))
        )
    df = df.withColumns(hits)

    live, dep = F.col(f"{prefix}live"), F.col(f"{prefix}dep")
    out: dict[str, Column] = {}
    for name, cue_set in polarity.items():
        out[f"{prefix}{name}"] = keep_only(live, cue_set.cues)
        out[f"{prefix}{name}_ph"] = phrases_found(t, cue_set.phrases)
    if departments:
        for name in lex.departments:
            both = F.concat(keep_only(dep, singles[name]), phrases_found(t, multi[name]))
            out[f"{prefix}dep_{name}"] = F.array_sort(both)
    return df.withColumns(out).drop(f"{prefix}words", f"{prefix}live", *([f"{prefix}dep"] if departments else []))


def polarity_score(name: str, prefix: str = "_cue_") -> Column:
    """Two points per phrase, one per live cue occurrence."""
    return F.size(F.col(f"{prefix}{name}_ph")) * F.lit(2) + F.size(F.col(f"{prefix}{name}"))


def department_score(name: str, prefix: str = "_cue_") -> Column:
    """Two points per phrase, one per cue word present (occurrences do not add up)."""
    found = F.col(f"`{prefix}dep_{name}`")
    extra = F.size(F.filter(found, lambda c: F.contains(c, F.lit(" "))))
    return F.size(found) + extra


def drop_cue_columns(df: DataFrame, prefix: str = "_cue_") -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith(prefix)])


def lexicon_scores(df: DataFrame, lex: Lexicons | None = None, text: str = "text", clean: bool = False) -> DataFrame:
    """negative_score, hazard_score, positive_score."""
    lex = lex or Lexicons()
    out = with_cue_columns(df, lex, text, departments=False, clean=clean)
    out = out.withColumns({f"{n}_score": polarity_score(n) for n in lex.polarity()})
    return drop_cue_columns(out)


def department_profile(df: DataFrame, lex: Lexicons | None = None, text: str = "text", clean: bool = False) -> DataFrame:
    """``cue_score_<dep>`` and ``cue_match_<dep>`` for every department."""
    lex = lex or Lexicons()
    out = with_cue_columns(df, lex, text, clean=clean)
    cols: dict[str, Column] = {}
    for d in lex.departments:
        cols[f"cue_score_{d}"] = department_score(d)
        cols[f"cue_match_{d}"] = F.col(f"`_cue_dep_{d}`")
    return drop_cue_columns(out.withColumns(cols))


def lexicon_table(spark: SparkSession, lex: Lexicons | None = None) -> DataFrame:
    """The polarity lexicons as rows (lexicon, cue, is_phrase, weight)."""
    lex = lex or Lexicons()
    rows = []
    for name, s in lex.polarity().items():
        rows += [(name, c, False, 1) for c in sorted(set(s.cues))]
        rows += [(name, p, True, 2) for p in sorted(set(s.phrases))]
    return spark.createDataFrame(rows, "lexicon string, cue string, is_phrase boolean, weight int")


#: Letters on each side of a phrase's first blank that its places are looked up by.
SEAM = 3


def _seam(left: Column, right: Column, a: Column | int, b: Column | int) -> Column:
    return F.concat(F.right(left, F.lit(a) if isinstance(a, int) else a), F.lit(" "), F.left(right, F.lit(b) if isinstance(b, int) else b))


def phrases_by_join(docs: DataFrame, phrases: DataFrame, key: str, text: str) -> DataFrame:
    """(key, lexicon, cue, weight): the phrases contained in each clean text, overlapping ones and those inside words too.

    A phrase holds a blank, and where it occurs the letters around its first blank do. These few letters are the join key: each text
    gives its different seams, in the (at most SEAM * SEAM) shapes that the phrases have; only texts with a phrase's seam are searched
    for the phrase.
    """
    head, rest = F.substring_index("cue", " ", 1), F.get(F.split("cue", " "), 1)
    a, b = F.least(F.length(head), F.lit(SEAM)), F.least(F.length(rest), F.lit(SEAM))
    seamed = phrases.select("lexicon", "cue", "weight", _seam(head, rest, a, b).alias("seam"), a.alias("a"), b.alias("b"))
    words = tokens(F.col(text))
    # as strings: different structs are searched for by comparing all with all
    pairs = F.array_distinct(F.array_compact(F.zip_with(words, F.slice(words, 2, 10**9), lambda l, r: F.concat(l, F.lit(" "), r))))
    # rows and not arrays, whose lambdas are not compiled
    asked = docs.select(key, F.explode(pairs).alias("p")).crossJoin(F.broadcast(seamed.select("a", "b").distinct()))
    asked = asked.select(key, _seam(F.substring_index("p", " ", 1), F.substring_index("p", " ", -1), F.col("a"), F.col("b")).alias("seam"))
    near = asked.join(seamed.drop("a", "b"), "seam").select(key, "lexicon", "cue", "weight").distinct()
    return near.join(docs, key).filter(F.contains(F.col(text), F.col("cue"))).select(key, "lexicon", "cue", "weight")


#: Texts of a piece, about, in which a text's words are counted.
DEALT_ROWS = 2048


def lexicon_scores_by_join(
    df: DataFrame, table: DataFrame, negators: Sequence[str], key: str = "id", text: str = "text"
) -> DataFrame:
    """Scores against a lexicon kept as a table (long form: key, lexicon, score); texts without a hit score 0.

    For lexicons too big to be literals. The words of a row are counted before
    the join, so a frequent word reaches it once per row and not once per
    occurrence; whether the lexicon is broadcast is left to its measured size.
    The key is unique and not null.

    Cleaned texts are dealt out by key once; words and seams are counted, and phrases searched for, where a text lies.
    """
    words = F.col("_words")
    negator_list = list(negators)

    def tagged(w: Column, i: Column) -> Column:
        flag = negated(words, i, negator_list) if negator_list else F.lit(False)
        return F.struct(w.alias("cue"), flag.alias("neg"))

    table = materialise(table)  # a table that is not a file has no measured size
    pieces = max(df.sparkSession.sparkContext.defaultParallelism, -(-df.select(key).count() // DEALT_ROWS))
    docs = df.select(F.col(key), match_text(F.col(text)).alias("_text")).repartition(pieces, key)
    live = (
        docs.select(F.col(key), tokens(F.col("_text")).alias("_words"))
        .select(F.col(key), F.explode(F.transform(words, tagged)).alias("w"))
        .filter(~F.col("w.neg"))
        .groupBy(key, F.col("w.cue").alias("cue"))
        .agg(F.count("*").alias("n"))
    )
    cues = table.filter(~F.col("is_phrase")).select("lexicon", "cue", "weight")
    hits = live.join(cues, "cue").select(key, "lexicon", (F.col("n") * F.col("weight")).alias("score"))
    found = phrases_by_join(docs, table.filter("is_phrase"), key, "_text").select(key, "lexicon", F.col("weight").cast("long").alias("score"))
    names = table.agg(F.array_sort(F.collect_set("lexicon"))).scalar()  # a few labels
    zeros = df.select(F.col(key), F.explode(names).alias("lexicon"), F.lit(0).cast("long").alias("score"))
    return hits.unionByName(found).unionByName(zeros).groupBy(key, "lexicon").agg(F.sum("score").alias("score"))


def unmatched_words(df: DataFrame, table: DataFrame, text: str = "text") -> DataFrame:
    """Words of the corpus no lexicon knows, with their counts (counted before the anti join)."""
    counts = (
        df.select(F.explode(tokens(match_text(F.col(text)))).alias("cue"))
        .groupBy("cue").agg(F.count("*").alias("n"))
    )
    return counts.join(table.filter(~F.col("is_phrase")).select("cue"), "cue", "left_anti")


def sentinel_text(c: Column) -> Column:
    """Text plus sentinel tokens for polarity, contrast, complaint and food context.

    Negation, positive and intensifier cues match blank-separated words; the
    other three match any substring.
    """
    base = F.coalesce(c, F.lit(""))
    low = F.lower(base)
    padded = F.concat(F.lit(" "), low, F.lit(" "))
    marks = []
    for token, cues, whole in SENTINELS:
        tests = [
            F.contains(padded, F.lit(f" {k} ")) if whole else F.contains(low, F.lit(k)) for k in cues
        ]
        cond = tests[0]
        for t in tests[1:]:
            cond = cond | t
        marks.append(F.when(cond, F.lit(token)))
    return F.concat_ws(" ", base, *marks)
