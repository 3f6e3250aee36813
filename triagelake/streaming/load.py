"""Department load in event-time windows, as a batch and as a stream with the same result.

A ticket counts when it arrived within the allowed delay of its event time; later ones are dropped by that rule, which looks
at the row alone. On a source in order of arrival the watermark, the largest event time seen less the delay, can then
never pass a row that the rule keeps: whatever came before has an event time of at most its own arrival, hence
of at most this row's arrival. So the stream's state drops closed windows and no row, and its result doesn't depend on how
the rows fall into batches.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.base import col
from ..operators.rollups import sla_load

EPOCH = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


def on_time(df: DataFrame, ts: str, arrived: Column, delay: str) -> DataFrame:
    """Rows that arrived within ``delay`` (an interval such as "60 minutes") of their event time; rows lacking either time go."""
    return df.filter(arrived <= col(ts) + F.expr(f"INTERVAL {delay}"))


def windowed_load(
    df: DataFrame, ts: str, window_hours: int, sla_hours: Mapping[str, float], capacity_per_hour: Mapping[str, float], departments: Sequence[str],
    department: str, urgent: Column, rounded: bool = True,
) -> DataFrame:
    """(window_start, department, volume, ...): the load roll-up of every window that has a row, in one aggregation.

    The frame may be a stream with a watermark on ``ts``: the window is the grouping key, so closed ones leave the state.
    """
    windows = df.withColumn("window", F.window(col(ts), f"{window_hours} hours"))
    load = sla_load(windows, window_hours, sla_hours, capacity_per_hour, departments, ["window"], department, urgent, rounded)
    return load.select(F.col("window.start").alias("window_start"), *[c for c in load.columns if c != "window"])


def stream_windowed_load(stream: DataFrame, ts: str, arrived: Column, delay: str, path: str, checkpoint: str, available_now: bool = True, **load) -> StreamingQuery:
    """Keep the windowed load of a stream under ``path``: each batch writes the windows it changed, once per batch number."""
    kept, wall = on_time(stream, ts, arrived, delay), dict(stream.dtypes)[ts] == "timestamp_ntz"
    if wall:  # a watermark needs instants: wall-clock times are taken as UTC, and given back as they were
        kept = kept.withColumn(ts, F.timestamp_micros(F.timestamp_diff("MICROSECOND", F.expr(EPOCH), col(ts))))
    loads = windowed_load(kept.withWatermark(ts, delay), ts, **load)
    start = F.timestamp_add("MICROSECOND", F.unix_micros("window_start"), F.expr(EPOCH)) if wall else F.col("window_start")

    def put(changed: DataFrame, batch: int) -> None:
        changed.withColumn("window_start", start).write.mode("overwrite").parquet(f"{path}/batch={batch}")

    writer = loads.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(put)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def read_windowed_load(spark: SparkSession, path: str) -> DataFrame:
    """The latest state of every window and department."""
    rows = spark.read.parquet(path)
    last = Window.partitionBy("window_start", "department").orderBy(F.desc("batch"))
    return rows.withColumn("_last", F.row_number().over(last)).filter("_last = 1").drop("_last", "batch")
