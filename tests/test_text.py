import random
import re
import sys
import unicodedata

from triagelake.functions.lexicon import CueSet, Lexicons, lexicon_scores, lexicon_scores_by_join, lexicon_table, sentinel_text
from triagelake.functions.text import NFKC_BLOCKS, char_wb_ngrams, prepare_text, tokens, word_ngrams
from triagelake.operators.tfidf import char_counts, term_counts, terms_of
from triagelake.plans.driver_tables import texts
from triagelake.registry.queries import QUERIES
from pyspark.sql import functions as F


def clean(s, nfkc=True):
    s = s.strip().lower()
    if nfkc:
        s = unicodedata.normalize("NFKC", s)
    return re.sub("[^a-z0-9àèìòù]+", " ", s).strip()


def test_nfkc_guard_covers_every_code_point():
    guarded = lambda c: any(a <= c <= b for a, b in NFKC_BLOCKS)
    bad = []
    for code in range(sys.maxunicode + 1):
        ch = chr(code)
        if 0xD800 <= code <= 0xDFFF or any(guarded(ord(x)) for x in ch.lower()):
            continue
        text = f"a{ch}x n{ch}"
        if not unicodedata.is_normalized("NFKC", text) and clean(text) != clean(text, False):
            bad.append(hex(code))
    assert bad == []


def test_prepare_text_edges(spark):
    rows = [
        (1, "Title", "Body text"), (2, None, "x"), (3, " ", None), (4, "!!!", "?"), (5, "Càffè", "ﬁne ① Ⅷ ½"),
        (6, "Perché\nsì", " a b c"), (7, "ｆｕｌｌ", "áb q́"), (8, "", "İstanbul ª²"),
    ]
    df = spark.createDataFrame(rows, "id long, title string, body string")
    got = {r["id"]: r["text"] for r in prepare_text(df).collect()}
    for i, t, b in rows:
        t, b = (t or "").strip(), (b or "").strip()
        want = clean(" ".join(([t] if t else []) + ([b, b] if b else [])))
        assert got[i] == want, i
    spelled = {r["id"]: r["text"] for r in prepare_text(df, null_as="nan").collect()}
    assert spelled[2] == "nan x x" and spelled[3] == "nan nan"


def test_negation_window_and_counts(spark):
    lex = Lexicons(CueSet(("bad",), ("very bad",)), CueSet(("mold",)), CueSet(("good",)), ("not",), {})
    texts = ["bad", "not bad", "not so bad", "not so very bad", "bad bad good", "", "mold not mold", "... ! ?"]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    got = {r["id"]: (r["negative_score"], r["hazard_score"], r["positive_score"]) for r in lexicon_scores(df, lex).collect()}
    assert got == {
        0: (1, 0, 0), 1: (0, 0, 0), 2: (0, 0, 0), 3: (3, 0, 0), 4: (2, 0, 1), 5: (0, 0, 0), 6: (0, 1, 0), 7: (0, 0, 0),
    }


def test_ngrams(spark):
    def char_reference(text, lo, hi):
        out = []
        for w in text.split():
            p = f" {w} "
            for n in range(lo, hi + 1):
                out += [p[i:i + n] for i in range(max(1, len(p) - n + 1))]
                if len(p) <= n:
                    break
        return out

    texts = ["a bc def ghij klmnop", "x", "", "one two"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("w", tokens(F.col("t")))
    for lo, hi in ((3, 5), (4, 6)):
        got = [sorted(r[0]) for r in df.select(char_wb_ngrams(F.col("w"), lo, hi)).collect()]
        assert got == [sorted(char_reference(t, lo, hi)) for t in texts]
    pairs = [r[0] for r in df.select(word_ngrams(F.col("w"), 1, 2)).collect()]
    assert pairs[3] == ["one", "two", "one two"] and pairs[1] == ["x"] and pairs[2] == []


def test_sentinels(spark):
    df = spark.createDataFrame([("camera non pulita",), ("tutto ottimo",), ("",)], "t string")
    got = [r[0] for r in df.select(sentinel_text(F.col("t"))).collect()]
    assert got == ["camera non pulita __HAS_NEGATION__", "tutto ottimo __HAS_POSITIVE_CUE__", ""] or "__HAS_CONTRAST__" not in got[1]
    assert "__HAS_NEGATION__" in got[0]


def test_lexicon_join_equals_literals(spark):
    """Phrases inside words, overlapping phrases, several words, negated cues; texts without a hit score 0."""
    lex = Lexicons(
        negative=CueSet(("bad", "cold"), ("a b", "b a", "the cold room", "old roo", "abc abcd")),
        hazard=CueSet(("mould",), ("d r", "the cold")), positive=CueSet(("good",), ()), negators=("not",), departments={},
    )
    r = random.Random(4)
    vocabulary = "a b ab ba abc abcd the cold room rooms bold not bad good mould d r".split()
    texts = [" ".join(r.choices(vocabulary, k=r.randint(0, 12))) for _ in range(300)] + ["", None, "zzz", "Abc, ABCD!"]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string").repartition(3)
    got = {(x["id"], x["lexicon"]): x["score"] for x in lexicon_scores_by_join(df, lexicon_table(spark, lex), lex.negators).collect()}
    want = lexicon_scores(df, lex).collect()
    assert len(got) == 3 * len(texts)
    for x in want:
        for name in ("negative", "hazard", "positive"):
            assert got[x["id"], name] == x[f"{name}_score"], (texts[x["id"]], name)
    assert any(got[i, "hazard"] > 2 for i in range(len(texts)))


def many_files(spark, folder):
    """Documents in more files than cores, which are not dealt out by id on reading; an id twice, and null ids."""
    rows = [(None if i % 7 == 0 else i % 50, f"line {i % 3}\nred tea red cup {i % 5}", "en", "web", 20) for i in range(60)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(20).write.parquet(f"{folder}/documents.parquet")
    return str(folder)


def term_shuffles(df):
    """Shuffles by document and term: they send every term of every document."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"hashpartitioning\(id#\d+L?, (?:term|word)#", plan)


def test_char_ngrams_sends_texts_and_not_their_terms(spark, tmp_path):
    found = QUERIES["char_ngrams"](spark, many_files(spark, tmp_path))
    assert term_shuffles(found) == []
    d = texts(spark, str(tmp_path)).select("id", "text")
    plain = char_counts(d, ["id"]).groupBy("term").agg(F.sum("tf").alias("total_tf"), F.count("*").alias("df"))
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, plain.collect()))


def test_tfidf_vocabulary_sends_texts_and_not_their_terms(spark, tmp_path):
    found = QUERIES["tfidf_vocabulary"](spark, many_files(spark, tmp_path)).drop("idf")
    assert term_shuffles(found) == []
    d = texts(spark, str(tmp_path)).select("id", "text")
    plain = term_counts(d, ["id"], terms_of(F.col("text"))).groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("total_tf"))
    assert sorted(map(tuple, found.select("term", "df", "total_tf").collect())) == sorted(map(tuple, plain.collect()))


def test_words_meet_a_small_lexicon_where_the_text_lies(spark):
    """Neither words nor seams are sent by term, and a text's different pairs are compared as strings, not as structs."""
    texts = [(1, "not good and bad bad"), (2, "very good good food"), (3, ""), (4, None), (5, "oo dfo good")]
    df = spark.createDataFrame(texts, "id long, text string")
    table = spark.createDataFrame([("p", "good", False, 1), ("n", "bad", False, 1), ("p", "od fo", True, 2), ("p", "good good", True, 2), ("n", "d ba", True, 2)], "lexicon string, cue string, is_phrase boolean, weight int")
    out = lexicon_scores_by_join(df, table, ["not"])
    assert {(r["id"], r["lexicon"]): r["score"] for r in out.collect()} == {
        (1, "p"): 0, (1, "n"): 4, (2, "p"): 6, (2, "n"): 0, (3, "p"): 0, (3, "n"): 0, (4, "p"): 0, (4, "n"): 0, (5, "p"): 1, (5, "n"): 0,
    }
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(cue" not in plan and "hashpartitioning(seam" not in plan and "arrays_zip" not in plan
