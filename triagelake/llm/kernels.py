"""Vectorised text scans over Arrow columns, used inside tasks.

Words are runs of bytes other than U+0020 and U+0009 to U+000D. All separators are ASCII, so UTF-8 bytes can be scanned
without decoding. A word's hash is a polynomial over its bytes; work arrays cover pieces of about PIECE bytes cut between
words, so memory doesn't depend on a text's length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 1 << 20
BATCH_BYTES = 4 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


#: One random value for each byte.
_BYTES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_POWERS: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse modulo 2**64."""
    if len(_POWERS.get("up", ())) < n:
        m = max(n, PIECE + 4096)
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            x = np.full(m, base, np.uint64)
            x[0] = 1
            _POWERS[name] = np.multiply.accumulate(x)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def text_bytes(column: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column one after the other, and each row's bounds. Null counts as empty."""
    column = pc.fill_null(column.cast(pa.large_binary()) if pa.types.is_binary(column.type) else column.cast(pa.large_string()), b"" if pa.types.is_binary(column.type) else "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n, _ = len(column), None
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1] if n else np.zeros(1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[bounds[0] : bounds[-1]] if n and bounds[-1] > bounds[0] else np.zeros(0, np.uint8)
    return (_LOWER[data] if lower else data), bounds - bounds[0]


def slices(batches: Iterator[pa.RecordBatch], text: int = -1, most: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds about `most` bytes of text, or one longer text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            done = size[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(size, done + most, "right")))
            yield batch.slice(start, end - start)
            start = end


def word_bounds(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and for each row the number of words before it (one more entry than rows)."""
    space = _SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[bounds] = True
    before = np.empty(len(data), bool)
    after = np.empty(len(data), bool)
    if len(data):
        before[0] = after[-1] = True
        before[1:] = space[:-1]
        after[:-1] = space[1:]
        before |= edge[:-1]
        after |= edge[1:]
    starts = np.flatnonzero(~space & before)
    ends = np.flatnonzero(~space & after) + 1
    return starts, ends, np.searchsorted(starts, bounds)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of ordered, disjoint spans."""
    out = np.empty(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        low = starts[first]
        last = max(first + 1, int(np.searchsorted(ends, low + PIECE, "right")))
        high = ends[last - 1]
        up, down = powers(int(high - low))
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum(_BYTES[data[low:high]] * up, out=sums[1:])
        s, e = starts[first:last] - low, ends[first:last] - low
        # an empty span at the very end has no power of its own, nor a sum
        out[first:last] = mixed((sums[e] - sums[s]) * down[np.minimum(s, len(down) - 1)] + (e - s).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        first = last
    return out


def window_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of each n words in a row, across all rows; windows that span two rows are the caller's to drop."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    m = len(words) - n + 1
    total = np.zeros(m, np.uint64)
    for i in range(n):
        total *= np.uint64(_BASE)
        total += words[i : i + m]
    return mixed(total)


def rows_of(counts_before: np.ndarray) -> np.ndarray:
    """For each item its row, from the number of items before each row."""
    return np.repeat(np.arange(len(counts_before) - 1), np.diff(counts_before))


def segment_sums(values: np.ndarray, counts_before: np.ndarray) -> np.ndarray:
    """Sum of each row's items."""
    sums = np.zeros(len(values) + 1, np.int64 if values.dtype == bool else values.dtype)
    np.cumsum(values, out=sums[1:])
    return sums[counts_before[1:]] - sums[counts_before[:-1]]
