"""Batch prediction on a stream: the runtime layer is row-local, so it runs unchanged."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..functions.lexicon import Lexicons
from ..operators.risk import Thresholds
from ..plans.batch import Scorer, score_reviews


def stream_scores(
    reviews: DataFrame, scorer: Scorer, path: str, checkpoint: str, lex: Lexicons | None = None,
    department_thresholds: Thresholds | None = None, sentiment_thresholds: Thresholds | None = None,
    diagnostic_review: bool = False, fmt: str = "parquet", available_now: bool = True,
) -> StreamingQuery:
    """Append scored rows of a streaming source to files, exactly once per checkpoint."""
    scored = score_reviews(reviews, scorer, lex, department_thresholds, sentiment_thresholds, diagnostic_review)
    writer = scored.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start(path)
