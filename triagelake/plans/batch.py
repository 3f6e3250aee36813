"""Batch prediction: reviews -> text -> scores -> runtime layer -> exports."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from ..functions.base import require_columns
from ..functions.lexicon import Lexicons, drop_cue_columns, with_cue_columns
from ..functions.text import prepare_text
from ..operators.guardrail import apply_guardrail
from ..operators.models import TextModel
from ..operators.risk import Thresholds, apply_operational_fields
from ..operators.rollups import sla_load
from ..operators.routing import impacted_departments
from ..sources.documents import write_sla_summary
from ..sources.reviews import write_predictions

# The explanation columns
EXPLANATIONS = ("explain_dep_top_tokens", "explain_sent_top_tokens")

# A scorer adds proba_<task>_<class>, pred_<task> and <task>_confidence for both tasks.
Scorer = Callable[[DataFrame], DataFrame]


def runtime_layer(
    scored: DataFrame,
    lex: Lexicons | None = None,
    department_thresholds: Thresholds | None = None,
    sentiment_thresholds: Thresholds | None = None,
    diagnostic_review: bool = False,
    guardrail: bool = True,
    text: str = "text",
    clean: bool = True,
) -> DataFrame:
    """Guardrail, routing, then review, risk and priority.

    The order matters: the guardrail changes the sentiment confidence the
    review flag looks at, and routing decides the multi-department bonus. The
    words are looked up once for both. Everything is row-local. ``clean`` says
    that ``text`` is the output of ``prepare_text``.
    """
    lex = lex or Lexicons()
    out = scored if "_cue_text" in scored.columns else with_cue_columns(scored, lex, text, clean=clean)
    if guardrail:
        out = apply_guardrail(out, lex, text, keep_cues=True)
    out = impacted_departments(out, lex, text, keep_cues=True)
    out = drop_cue_columns(out)
    return apply_operational_fields(out, department_thresholds, sentiment_thresholds, diagnostic_review)


def score_reviews(
    reviews: DataFrame,
    scorer: Scorer,
    lex: Lexicons | None = None,
    department_thresholds: Thresholds | None = None,
    sentiment_thresholds: Thresholds | None = None,
    diagnostic_review: bool = False,
    guardrail: bool = True,
    nfkc: bool = True,
) -> DataFrame:
    """Scored table with all runtime columns, as one projection over the scan."""
    require_columns(reviews, ["title", "body"], "reviews")
    return runtime_layer(
        scorer(prepare_text(reviews, nfkc=nfkc)), lex, department_thresholds, sentiment_thresholds,
        diagnostic_review, guardrail,
    )


def model_scorer(department: TextModel, sentiment: TextModel, explanations: int = 0) -> Scorer:
    """A scorer of both tasks from fitted models.

    ``explanations`` is the number of terms in the two explanation columns, which need both models to be linear and are left out
    otherwise. Explanations belong to the model's own predictions, before the guardrail.
    """
    def score(df: DataFrame) -> DataFrame:
        out = sentiment.transform(department.transform(df))
        if explanations and department.linear is not None and sentiment.linear is not None:
            out = department.explain(out, EXPLANATIONS[0], explanations)
            out = sentiment.explain(out, EXPLANATIONS[1], explanations)
        return out

    return score


def predict_batch(scored: DataFrame, predictions_path: str, sla_path: str, fmt: str = "csv", diagnostic_review: bool = True, window_hours: float = 8) -> None:
    """Export predictions and the load summary.

    The scored rows are written once; the roll-up reads the written columns
    back when they are columnar, so models and text run a single time.
    """
    write_predictions(scored, predictions_path, fmt, diagnostic_review)
    if fmt in ("parquet", "orc"):
        source = scored.sparkSession.read.format(fmt).load(predictions_path)
    else:
        source = scored
    write_sla_summary(sla_load(source, window_hours), sla_path)
