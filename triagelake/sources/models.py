"""Fitted models as versioned bundles.

A bundle is a folder of versions. A version holds the model's arrays as one table and, written last, a manifest with
everything else: classes, features, the number of array parts, and what belongs to the model, such as thresholds and the
conformal cut. A version without a manifest does not exist for readers, so an interrupted write is never read.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

from ..operators.linear import Head
from ..operators.models import TextModel

PART_BYTES = 1 << 24
SCHEMA = "name string, part int, kind string, shape array<long>, data binary"


def _parts(arrays: dict[str, np.ndarray]) -> Iterator[tuple]:
    for name, x in arrays.items():
        raw = memoryview(np.ascontiguousarray(x).tobytes())
        for part in range(max(1, -(-len(raw) // PART_BYTES))):
            yield name, part, str(x.dtype), list(x.shape), bytes(raw[part * PART_BYTES : (part + 1) * PART_BYTES])


def write_arrays(spark: SparkSession, arrays: dict[str, np.ndarray], path: str) -> int:
    """Write the arrays in bounded parts; the number of parts."""
    rows = list(_parts(arrays))
    columns = [pa.array(x, t) for x, t in zip(zip(*rows), (pa.string(), pa.int32(), pa.string(), pa.list_(pa.int64()), pa.binary()))]
    spark.createDataFrame(pa.table(columns, names=["name", "part", "kind", "shape", "data"]), SCHEMA).write.parquet(path)
    return len(rows)


def save_model(spark: SparkSession, model: TextModel, path: str) -> str:
    """Add a version of the model to the bundle; its name."""
    arrays, heads = {}, {}
    for name, head in model.heads.items():
        meta, own = head.parts()
        heads[name] = meta
        arrays |= {f"{name}/{k}": v for k, v in own.items()}
    if model.meta is not None:
        arrays |= {"meta/weights": model.meta[0], "meta/bias": model.meta[1]}
    version = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    parts = write_arrays(spark, arrays, f"{path}/{version}/arrays")
    manifest = {
        "task": model.task, "classes": model.classes, "heads": heads, "stacked": model.meta is not None, "text": model.text,
        "enriched": model.enriched, "extras": model.extras, "parts": parts, "version": version,
    }
    spark.createDataFrame([(json.dumps(manifest),)], "value string").coalesce(1).write.text(f"{path}/{version}/manifest")
    return version


def versions(spark: SparkSession, path: str) -> dict[str, dict]:
    """The manifests of all whole versions, oldest first."""
    try:
        rows = spark.read.option("wholetext", True).text(f"{path}/*/manifest").collect()
    except AnalysisException:  # no version has a manifest
        return {}
    found = [json.loads(r["value"]) for r in rows]
    return {m["version"]: m for m in sorted(found, key=lambda m: m["version"])}


def load_model(spark: SparkSession, path: str, version: str | None = None) -> TextModel:
    """A version of the bundle, by default the newest whole one."""
    known = versions(spark, path)
    if not known or (version and version not in known):
        raise FileNotFoundError(f"no whole version {version or ''} in {path}")
    manifest = known[version or list(known)[-1]]
    rows = spark.read.schema(SCHEMA).parquet(f"{path}/{manifest['version']}/arrays").orderBy("name", "part").collect()
    if len(rows) != manifest["parts"]:
        raise ValueError(f"{len(rows)} of {manifest['parts']} array parts in {path}/{manifest['version']}")
    raw: dict[str, list] = {}
    for r in rows:
        raw.setdefault(r["name"], []).append(r)
    arrays = {n: np.frombuffer(b"".join(bytes(r["data"]) for r in p), p[0]["kind"]).reshape(p[0]["shape"]) for n, p in raw.items()}
    heads = {
        name: Head.from_parts(meta, {k.split("/", 1)[1]: v for k, v in arrays.items() if k.startswith(f"{name}/")})
        for name, meta in manifest["heads"].items()
    }
    top = (arrays["meta/weights"], arrays["meta/bias"]) if manifest["stacked"] else None
    return TextModel(manifest["task"], manifest["classes"], heads, top, manifest["text"], manifest["enriched"], manifest["extras"])
