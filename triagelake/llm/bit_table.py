"""A set of 64-bit keys as a table of bits of fixed size, built by the executors.

It answers "surely not" or "maybe"; who uses it must be right for any answer "maybe", so a table that is too small for the
data costs time alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .kernels import mixed

CHUNK_BITS = 1 << 20


def _places(keys: np.ndarray, bits: int) -> np.ndarray:
    return (mixed(keys) & np.uint64(bits - 1)).astype(np.int64)


def bit_table(keys: DataFrame, bits: int) -> np.ndarray:
    """keys: one long column. bits: a power of two, CHUNK_BITS at least. bits / 8 bytes reach the driver."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.unique(_places(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64), bits))
            yield pa.RecordBatch.from_arrays([pa.array((at // CHUNK_BITS).astype(np.int32)), pa.array((at % CHUNK_BITS).astype(np.int32))], names=["chunk", "at"])

    def merge(rows: pa.Table) -> pa.Table:
        own = np.zeros(CHUNK_BITS, bool)
        own[rows.column("at").to_numpy()] = True
        return pa.table({"chunk": rows.column("chunk")[:1], "bits": pa.array([np.packbits(own, bitorder="little").tobytes()], pa.binary())})

    table = np.zeros(bits // 8, np.uint8)
    for r in keys.mapInArrow(scan, "chunk int, at int").groupBy("chunk").applyInArrow(merge, "chunk int, bits binary").collect():
        table[r["chunk"] * CHUNK_BITS // 8 : (r["chunk"] + 1) * CHUNK_BITS // 8] = np.frombuffer(r["bits"], np.uint8)
    return table


def maybe_in(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = _places(keys, len(table) * 8)
    return (table[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0
