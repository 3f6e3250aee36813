"""Lexical guardrail over sentiment probabilities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.base import argmax_label, col, lit_d, prefixed_classes, row_max, total
from ..functions.lexicon import Lexicons, drop_cue_columns, polarity_score, with_cue_columns

# Target probability by score, lowest score first; the last one
# also covers every higher score.
HAZARD_TARGETS = ((1, 0.78), (2, 0.90), (3, 0.95))
NEGATIVE_TARGETS = ((2, 0.68), (3, 0.82))
POSITIVE_TARGETS = ((3, 0.74), (4, 0.86))
HAZARD_FLAG_SCORE = 2


def _target(score: Column, table: tuple[tuple[int, float], ...]) -> Column:
    out = F.lit(None).cast("double")
    for low, value in table:
        out = F.when(score >= low, lit_d(value)).otherwise(out)
    return out


def _tagged(words: Column, tag: str) -> Column:
    return F.transform(words, lambda w: F.concat(F.lit(tag), w))


def guardrail_reason(prefix: str = "_cue_") -> Column:
    """First three hazard, negative and positive reasons; five in all."""
    parts = []
    for name, phrase_tag, cue_tag in (
        ("hazard", "hazard_bigram:", "hazard_cue:"),
        ("negative", "bigram:", "cue:"),
        ("positive", "pos_bigram:", "pos_cue:"),
    ):
        phrases = _tagged(F.col(f"{prefix}{name}_ph"), phrase_tag)
        cues = _tagged(F.col(f"{prefix}{name}"), cue_tag)
        parts.append(F.slice(F.concat(phrases, cues), 1, 3))
    return F.concat_ws(";", F.slice(F.concat(*parts), 1, 5))


def apply_guardrail(
    df: DataFrame,
    lex: Lexicons | None = None,
    text: str = "text",
    prediction: str = "pred_sentiment",
    prefix: str = "proba_sentiment_",
    confidence: str = "sentiment_confidence",
    keep_cues: bool = False,
) -> DataFrame:
    """Override sentiment probabilities that contradict the words of the text.

    Only the first matching rule counts: hazard words against a positive call,
    then negative words against it, then positive words against a negative call
    without any negative or hazard word. The wanted side is lifted to the
    target when it is below, the other gets the rest, and the row is normalised.
    Prediction and confidence are recomputed for every row.
    """
    if text not in df.columns or prediction not in df.columns:
        return df
    classes = prefixed_classes(df, prefix)
    if not classes:
        return df
    names = [f"{prefix}{c}" for c in classes]
    probs = [col(n) for n in names]
    if "neg" not in classes or "pos" not in classes:
        # other label sets pass through: nothing is judged, only the bookkeeping columns appear
        out = {confidence: row_max(probs)} if confidence in df.columns else {}
        return df.withColumns({**out, **_bookkeeping(F.lit(False), F.lit(0), F.lit(0), F.lit(""))})

    out = df if "_cue_text" in df.columns else with_cue_columns(df, lex or Lexicons(), text)
    out = out.withColumns({
        "_g_neg": polarity_score("negative"),
        "_g_haz": polarity_score("hazard"),
        "_g_pos": polarity_score("positive"),
    })
    neg, haz, pos = F.col("_g_neg"), F.col("_g_haz"), F.col("_g_pos")
    called_pos = F.coalesce(col(prediction) == "pos", F.lit(False))
    called_neg = F.coalesce(col(prediction) == "neg", F.lit(False))
    to_neg = (
        F.when(called_pos & (haz >= 1), _target(haz, HAZARD_TARGETS))
        .when(called_pos & (neg >= 2), _target(neg, NEGATIVE_TARGETS))
    )
    to_pos = F.when(
        called_neg & (haz == 0) & (neg == 0) & (pos >= 3), _target(pos, POSITIVE_TARGETS)
    )
    p_neg, p_pos = col(f"{prefix}neg"), col(f"{prefix}pos")
    # at most one of the two targets is set; it is kept only when it lifts its side
    out = out.withColumns({
        "_g_to_neg": F.when(p_neg < to_neg, to_neg),
        "_g_to_pos": F.when(p_pos < to_pos, to_pos),
    })
    up_neg, up_pos = F.col("_g_to_neg"), F.col("_g_to_pos")
    applied = up_neg.isNotNull() | up_pos.isNotNull()
    lifted = {c: col(f"{prefix}{c}").cast("double") for c in classes}

    def rest(target: Column) -> Column:
        return F.greatest(lit_d(0.0), lit_d(1.0) - target)

    lifted["neg"] = (
        F.when(up_neg.isNotNull(), up_neg).when(up_pos.isNotNull(), rest(up_pos)).otherwise(p_neg)
    )
    lifted["pos"] = (
        F.when(up_pos.isNotNull(), up_pos).when(up_neg.isNotNull(), rest(up_neg)).otherwise(p_pos)
    )
    row_sum = total([lifted[c] for c in classes])
    scale = F.when(applied & (row_sum > 0), row_sum).otherwise(lit_d(1.0))
    out = out.withColumns({
        **{f"{prefix}{c}": lifted[c] / scale for c in classes},
        **_bookkeeping(applied, neg, haz, guardrail_reason()),
    })
    # ties go to the first probability column
    fresh = {prediction: argmax_label(classes, probs)}
    if confidence in out.columns:
        fresh[confidence] = row_max(probs)
    out = out.withColumns(fresh).drop("_g_neg", "_g_haz", "_g_pos", "_g_to_neg", "_g_to_pos")
    return out if keep_cues else drop_cue_columns(out)


def _bookkeeping(applied: Column, neg: Column, haz: Column, reason: Column) -> dict[str, Column]:
    return {
        "sentiment_guardrail_applied": applied,
        "sentiment_guardrail_score": neg,
        "sentiment_hazard_score": haz,
        "sentiment_hazard_flag": haz >= HAZARD_FLAG_SCORE,
        "sentiment_guardrail_reason": reason,
    }
