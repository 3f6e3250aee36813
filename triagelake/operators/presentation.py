"""Reader-facing projection of a scored table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.base import col

# Labels, accepted spellings of true, column headings
PRIORITY_LABELS = {"LOW": "BASSA", "MEDIUM": "MEDIA", "HIGH": "ALTA", "URGENT": "URGENTE"}
TRUE_SPELLINGS = ("true", "1", "si", "sì", "yes")
YES, NO = "SÌ", "NO"
FLAG_COLUMNS = (
    "cross_department_signal", "sentiment_guardrail_applied", "sentiment_hazard_flag", "needs_review_diag",
)
LIST_COLUMNS = ("impacted_departments", "department_conformal_set")
HEADINGS = {
    "id": "ID",
    "title": "Titolo",
    "body": "Testo recensione",
    "text": "Testo completo",
    "pred_department": "Reparto previsto",
    "department_confidence": "Confidenza reparto",
    "pred_sentiment": "Sentiment previsto",
    "sentiment_confidence": "Confidenza sentiment",
    "priority": "Priorità",
    "risk_score": "Punteggio di rischio",
    "impacted_departments": "Reparti coinvolti",
    "impacted_departments_count": "Numero reparti coinvolti",
    "impacted_departments_reason": "Motivo reparti coinvolti",
    "cross_department_signal": "Segnale multi-reparto",
    "sentiment_guardrail_applied": "Correzione applicata",
    "sentiment_guardrail_score": "Punteggio segnali negativi",
    "sentiment_hazard_score": "Punteggio igienico-sanitario",
    "sentiment_hazard_flag": "Criticità igienico-sanitaria",
    "sentiment_guardrail_reason": "Motivo correzione",
    "needs_review_diag": "Controllo umano consigliato",
    "department_conformal_set": "Reparti plausibili APS",
    "department_conformal_size": "Numero reparti plausibili",
    "explain_dep_top_tokens": "Parole influenti reparto",
    "explain_sent_top_tokens": "Parole influenti sentiment",
    "department": "Reparto",
    "volume": "Volume",
    "window_hours": "Finestra ore",
    "capacity_tickets": "Capacità ticket",
    "backlog_estimated": "Backlog stimato",
    "sla_target_hours": "Target SLA ore",
    "estimated_avg_response_hours": "Risposta media stimata ore",
    "estimated_sla_hit_rate": "Rispetto SLA stimato",
}
PREFIX_HEADINGS = {
    "proba_department_": "Probabilità reparto ",
    "proba_sentiment_": "Probabilità sentiment ",
}


def yes_no(c: Column) -> Column:
    """Flag of any type as SÌ/NO: null is no, text counts as true in its usual spellings."""
    return F.when(F.lower(F.trim(c.cast("string"))).isin(*TRUE_SPELLINGS), F.lit(YES)).otherwise(F.lit(NO))


def _number_flag(df: DataFrame, name: str) -> Column:
    kind = dict(df.dtypes)[name]
    if kind in ("string", "boolean"):
        return yes_no(col(name))
    # for numbers any value but zero is true
    return F.when(F.coalesce(col(name).cast("double"), F.lit(0.0)) != 0, F.lit(YES)).otherwise(F.lit(NO))


def priority_label(c: Column) -> Column:
    out = None
    for k, v in PRIORITY_LABELS.items():
        out = F.when(c == k, F.lit(v)) if out is None else out.when(c == k, F.lit(v))
    return out.otherwise(c)


def heading(name: str) -> str:
    if name in HEADINGS:
        return HEADINGS[name]
    for prefix, label in PREFIX_HEADINGS.items():
        if name.startswith(prefix):
            return label + name[len(prefix):]
    return name


def presentation_view(df: DataFrame) -> DataFrame:
    """Translate priorities and flags, open up list separators, rename columns."""
    columns = []
    for name in df.columns:
        c = col(name)
        if name == "priority":
            c = priority_label(c)
        elif name in FLAG_COLUMNS:
            c = _number_flag(df, name)
        elif name in LIST_COLUMNS:
            c = F.replace(c.cast("string"), F.lit("|"), F.lit(", "))
        elif name == "impacted_departments_reason":
            c = F.replace(F.replace(c.cast("string"), F.lit(":model"), F.lit(":modello")), F.lit(";"), F.lit(" | "))
        columns.append(c.alias(heading(name)))
    return df.select(*columns)
