"""Best-fit packing planned on the histogram of lengths.

One scan turns every text into token ids, cuts longer ones into pieces, numbers the pieces of each length inside the scan
partition, and stores them. The histogram, at most WIDTH counts whatever the corpus, is planned by best-fit decreasing on counts: bins
with the same content are one group, and a length goes to the groups with the smallest sufficient room first; equal
lengths fill a bin until it has no room for one more, exactly as they would one by one. The plan says which ranks of
a length go where: (length, first rank, first sequence, pieces a sequence, offset).

A piece's rank within its length is its number in the scan partition plus the pieces of that length in earlier partitions, a prefix sum
over one row a partition and length; with it the piece takes its planned slot. No window runs over documents, so that a
length which most documents share is no task of its own.

The plan is bounded: a sequence holds at most 63 different lengths (1 + 2 + ... + 63 < 2048 < 1 + ... + 64), and a length
starts at most four groups, so it has at most 2048 * 4 * 63 rows, and far fewer in practice.

Defined cases: null text is empty, so its document is the end token alone; repeated rows and repeated or null doc_ids are
documents of their own; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import kernels as K
from .shared import new_path, own_columns

WIDTH = 2048
END = 0


def pieces_of(documents: DataFrame, make_encoder, width: int = WIDTH) -> DataFrame:  # noqa: ANN001
    """(doc_id, piece, start, length, ids, part, number): ids as little-endian unsigned 32-bit bytes, END included; only the
    first piece of a longer document may be shorter than `width`. `number` counts the pieces of a length in the partition."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, seen = None, TaskContext.get().partitionId(), np.zeros(width + 1, np.int64)
        for batch in K.slices(batches, 1):
            encoder = encoder or make_encoder()
            which, piece, starts, lengths, numbers, cut = [], [], [], [], [], []
            for i, text in enumerate(batch.column(1).fill_null("").to_pylist()):
                ids = np.array([*encoder.ids(text), END], "<u4")
                start = 0
                for number, end in enumerate(range((len(ids) - 1) % width + 1, len(ids) + 1, width)):
                    which.append(i)
                    piece.append(number)
                    starts.append(start)
                    lengths.append(end - start)
                    numbers.append(seen[end - start])
                    seen[end - start] += 1
                    cut.append(ids[start:end].tobytes())
                    start = end
            arrays = [batch.column(0).take(pa.array(which, pa.int64())), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (starts, lengths)), pa.array(cut, pa.binary()), pa.array([part] * len(which), pa.int64()), pa.array(numbers, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "piece", "start", "length", "ids", "part", "number"])

    return documents.mapInArrow(scan, f"doc_id {dict(documents.dtypes)['doc_id']}, piece int, start long, length long, ids binary, part long, number long")


def planned(counts: dict[int, int], width: int = WIDTH) -> np.ndarray:
    """Rows (length, first rank, first sequence, pieces a sequence, offset), ordered by length and rank."""
    rooms: dict[int, list[tuple[int, int]]] = {}  # room left -> groups of bins (first sequence, bins)
    out, sequences = [], 0
    for length in sorted(counts, reverse=True):
        rank, left, later = 0, counts[length], []
        for room in sorted(r for r in rooms if r >= length):
            if not left:
                break
            each = room // length
            groups, rooms[room] = rooms[room], []
            for first, bins in groups:
                full = min(bins, left // each)
                if full:
                    out.append((length, rank, first, each, width - room))
                    rank, left = rank + full * each, left - full * each
                    later.append((room - each * length, first, full))
                if full < bins and left:
                    out.append((length, rank, first + full, left, width - room))
                    later.append((room - left * length, first + full, 1))
                    rank, left, full = rank + left, 0, full + 1
                if full < bins:
                    rooms[room].append((first + full, bins - full))
        if left:
            each = width // length
            full = left // each
            if full:
                out.append((length, rank, sequences, each, 0))
                later.append((width - each * length, sequences, full))
                rank, left, sequences = rank + full * each, left - full * each, sequences + full
            if left:
                out.append((length, rank, sequences, left, 0))
                later.append((width - left * length, sequences, 1))
                sequences += 1
        for room, first, bins in later:
            rooms.setdefault(room, []).append((first, bins))
        rooms = {r: g for r, g in rooms.items() if r and g}
    return np.array(sorted(out), np.int64).reshape(-1, 5)


def slotted(rows: DataFrame, plan) -> DataFrame:  # noqa: ANN001
    """Rows with length and rank take their slot of the plan (a broadcast array): sequence_id and offset."""

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length_of, first, sequence, each, offset = plan.value.T
        keys = (length_of << 50) + first
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            at = np.searchsorted(keys, (length << 50) + rank, "right") - 1
            i = rank - first[at]
            yield batch.append_column("sequence_id", pa.array(sequence[at] + i // each[at])).append_column("offset", pa.array(offset[at] + i % each[at] * length))

    kinds = ", ".join(f"{n} {k}" for n, k in rows.dtypes)
    return rows.mapInArrow(take, f"{kinds}, sequence_id long, offset long")


def packed(documents: DataFrame, make_encoder, width: int = WIDTH) -> DataFrame:  # noqa: ANN001
    """documents (doc_id, text) -> doc_id, piece, start, length, ids, sequence_id, offset."""
    spark = documents.sparkSession
    cut = pieces_of(own_columns(documents, ["doc_id", "text"]), make_encoder, width)
    path = new_path(spark, "fit-ids")
    cut.write.option("compression", "zstd").parquet(path)
    rows = spark.read.schema(cut.schema).parquet(path)
    chunks = rows.groupBy("part", "length").agg(F.count("*").alias("n"))
    counts = {r["length"]: r["n"] for r in chunks.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # `width` rows at most
    plan = spark.sparkContext.broadcast(planned(counts, width))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each scan partition
    offsets = chunks.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    ranked = rows.join(offsets, ["part", "length"]).select("doc_id", "piece", "start", "length", "ids", (F.col("before") + F.col("number")).alias("rank"))
    return slotted(ranked, plan).drop("rank")
