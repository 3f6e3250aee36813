"""Departments a review touches besides the predicted one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.base import col, lit_d, prefixed_classes, text_array
from ..functions.lexicon import Lexicons, department_score, drop_cue_columns, with_cue_columns

# Fixed values
CUE_THRESHOLD = 2
PROBABILITY_THRESHOLD = 0.28


def impacted_departments(
    df: DataFrame,
    lex: Lexicons | None = None,
    text: str = "text",
    prediction: str = "pred_department",
    prefix: str = "proba_department_",
    cue_threshold: int = CUE_THRESHOLD,
    probability_threshold: float = PROBABILITY_THRESHOLD,
    as_text: bool = True,
    keep_cues: bool = False,
) -> DataFrame:
    """Ranked list of departments named by the model, by probability or by cues.

    Ranking per row: cue score, probability, name, all descending. It is a sort
    of one short array inside the row, so nothing is shuffled. Set
    ``as_text=False`` to keep arrays instead of ``|``/``;`` strings.
    """
    if text not in df.columns or prediction not in df.columns:
        return df
    lex = lex or Lexicons()
    out = df if "_cue_text" in df.columns else with_cue_columns(df, lex, text)
    classes = prefixed_classes(df, prefix)
    from_model = bool(classes)
    classes = classes or list(lex.departments)

    pred = F.coalesce(col(prediction), F.lit(""))
    entries = []
    for c in classes:
        known = c in lex.departments
        score = department_score(c) if known else F.lit(0)
        p = F.coalesce(col(f"{prefix}{c}").cast("double"), lit_d(0.0)) if from_model else lit_d(0.0)
        cues = col(f"_cue_dep_{c}") if known else text_array([])
        chosen = (pred == F.lit(c)) | (score >= F.lit(int(cue_threshold)))
        if from_model:
            chosen = chosen | (p >= lit_d(probability_threshold))
        entries.append(F.when(chosen, F.struct(
            score.alias("score"), p.alias("p"), F.lit(c).alias("name"), cues.alias("cues"),
        )))
    ranked = F.sort_array(F.array_compact(F.array(*entries)), asc=False)
    out = out.withColumn("_ranked", ranked)
    r = F.col("_ranked")
    names = (
        F.when(F.size(r) > 0, F.transform(r, lambda e: e["name"]))
        .when(pred != "", F.array(pred))
        .otherwise(text_array([]))
    )
    reasons = F.transform(
        F.slice(r, 1, 3),
        lambda e: F.when(
            e["score"] > 0,
            F.concat(
                e["name"], F.lit(":"), e["score"].cast("string"), F.lit("["),
                F.concat_ws(",", F.slice(e["cues"], 1, 3)), F.lit("]"),
            ),
        ).otherwise(F.concat(e["name"], F.lit(":model"))),
    )
    # a prediction outside the class list stands alone
    alone = F.concat(pred, F.lit(":model"))
    for d in lex.departments:
        if d not in classes:
            score = department_score(d)
            cues = F.concat_ws(",", F.slice(col(f"_cue_dep_{d}"), 1, 3))
            with_cues = F.concat(pred, F.lit(":"), score.cast("string"), F.lit("["), cues, F.lit("]"))
            alone = F.when((pred == F.lit(d)) & (score > 0), with_cues).otherwise(alone)
    reasons = F.when((F.size(r) == 0) & (pred != ""), F.array(alone)).otherwise(reasons)
    out = out.withColumns({"impacted_departments": names, "impacted_departments_reason": reasons})
    count = F.size("impacted_departments")
    out = out.withColumns({"impacted_departments_count": count, "cross_department_signal": count > 1})
    if as_text:
        out = out.withColumns({
            "impacted_departments": F.concat_ws("|", "impacted_departments"),
            "impacted_departments_reason": F.concat_ws(";", "impacted_departments_reason"),
        })
    out = out.drop("_ranked")
    return out if keep_cues else drop_cue_columns(out)
