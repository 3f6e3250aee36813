"""Windowed load: batch and stream agree, late rows go by rule, closed windows leave the state."""

import datetime
import random

from pyspark.sql import functions as F

from triagelake.streaming.load import on_time, read_windowed_load, stream_windowed_load, windowed_load

START = datetime.datetime(2024, 3, 1)
SCHEMA = "id long, ts timestamp, arrived timestamp, kind string, urgent boolean"
LOAD = {"window_hours": 2, "sla_hours": {"a": 1.0}, "capacity_per_hour": {"a": 3.0, "b": 0.5}, "departments": ["a", "b", "c"], "department": "kind", "urgent": F.col}


def rows(n=400):
    r = random.Random(9)
    out = []
    for i in range(n):
        ts = START + datetime.timedelta(minutes=r.randrange(60 * 24))
        out.append((i, ts, ts + datetime.timedelta(minutes=r.choice([0, 5, 30, 60, 61, 300])), r.choice("aab"), r.random() < 0.3))
    out += [(n, None, START, "a", True), (n + 1, START, None, "a", True), (n + 2, START, START, None, None)]
    return sorted(out, key=lambda x: (x[2] or START, x[0]))


def expected(data):
    kept = [x for x in data if x[1] and x[2] and x[2] <= x[1] + datetime.timedelta(minutes=60)]
    windows = {x[1].replace(hour=x[1].hour // 2 * 2, minute=0) for x in kept}
    out = {}
    for w in windows:
        for kind in "abc":
            mine = [x for x in kept if x[3] == kind and w <= x[1] < w + datetime.timedelta(hours=2)]
            capacity = {"a": 6.0, "b": 1.0}.get(kind, 16.0)
            over = max(len(mine) / capacity - 1, 0.0)
            share = sum(x[4] for x in mine) / len(mine) if mine else 0.0
            out[w, kind] = (len(mine), max(len(mine) - int(capacity), 0), round(min(max(1 - 0.55 * over - 0.12 * share, 0), 1), 9))
    return out


def found(df):
    return {(x.window_start, x.department): (x.volume, x.backlog_estimated, round(x.estimated_sla_hit_rate, 9)) for x in df.collect()}


def test_batch_and_stream_agree(spark, tmp_path):
    data = rows()
    load = {**LOAD, "urgent": F.coalesce(F.col("urgent"), F.lit(False)), "rounded": False}
    table = spark.createDataFrame(data, SCHEMA)
    assert found(windowed_load(on_time(table, "ts", F.col("arrived"), "60 minutes"), "ts", **load)) == expected(data)
    source = str(tmp_path / "in")
    for i in range(0, len(data), 40):  # files in order of arrival
        spark.createDataFrame(data[i : i + 40], SCHEMA).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    query = stream_windowed_load(stream, "ts", F.col("arrived"), "60 minutes", out, checkpoint, **load)
    query.awaitTermination()
    assert found(read_windowed_load(spark, out)) == expected(data)
    progress = query.recentProgress
    assert sum(p["stateOperators"][0]["numRowsDroppedByWatermark"] for p in progress) == 0
    assert progress[-1]["stateOperators"][0]["numRowsTotal"] < len({w for w, _ in expected(data)})
    # a second run has nothing new to read and changes nothing
    stream_windowed_load(stream, "ts", F.col("arrived"), "60 minutes", out, checkpoint, **load).awaitTermination()
    assert found(read_windowed_load(spark, out)) == expected(data)


def test_no_rows(spark):
    load = {**LOAD, "urgent": F.col("urgent")}
    assert windowed_load(spark.createDataFrame([], SCHEMA), "ts", **load).collect() == []
