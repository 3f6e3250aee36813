"""Packing by concatenate and cut.

First pass: every scan partition turns its texts into token ids, counts the tokens before each document inside the
partition, and stores ids and counts. The partitions' totals, one row each, get prefix sums, which give every document its
place in the whole concatenation. Second pass: windows of WIDTH tokens at multiples of WIDTH cut the documents; a document
that crosses a boundary gets a record for each side. Nothing but the totals is gathered, and no ids are shuffled while the
totals fit Spark's broadcast threshold.

The last sequence alone is short: it is padded to WIDTH, unless its length is a power of two.

Defined cases: null text is empty, so its document is the end token alone; repeated rows and repeated or null doc_ids are
documents of their own; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import kernels as K
from .shared import new_path, own_columns, written

WIDTH = 1024
END = 0
#: Text with a long stretch of white space goes to the slower tokenizer, whose pattern matching has no limit there.
LONG_SPACE = re.compile(r"\s{500}")


class Encoder:
    """Ids of the tokenizer file `json_path`. With the same vocabulary as ranks (`ranks_path`, `pattern`) texts are encoded
    several times faster, except those that hold a special token's string."""

    def __init__(self, json_path: str, ranks_path: str | None = None, pattern: str | None = None) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(json_path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.fast = None
        if ranks_path:
            import tiktoken

            with open(ranks_path, "rb") as lines:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> list[int]:
        if self.fast is None or any(s in text for s in self.special) or LONG_SPACE.search(text):
            return self.tokenizer.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


def tokenized(documents: DataFrame, make_encoder) -> DataFrame:
    """(doc_id, part, before, n, ids): ids as little-endian unsigned 32-bit bytes, END included."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, before, part = None, 0, TaskContext.get().partitionId()
        for batch in K.slices(batches, 1):
            encoder = encoder or make_encoder()
            ids = [np.array([*encoder.ids(t), END], "<u4") for t in batch.column(1).fill_null("").to_pylist()]
            counts = np.array([len(x) for x in ids])
            starts = before + np.cumsum(counts) - counts
            before += int(counts.sum())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.full(len(ids), part)), pa.array(starts), pa.array(counts), pa.array([x.tobytes() for x in ids], pa.binary())], names=["doc_id", "part", "before", "n", "ids"])

    return documents.mapInArrow(scan, f"doc_id {dict(documents.dtypes)['doc_id']}, part long, before long, n long, ids binary")


def pieces_of(rows: DataFrame) -> DataFrame:
    """(doc_id, place, ids) -> one row for each piece."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in K.slices(batches, 2):
            which, out = [], []
            for i, (place, ids) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2), strict=True)):
                data = memoryview(ids.as_buffer())
                n, start = len(data) // 4, 0
                while start < n:
                    length = min(n - start, WIDTH - (place + start) % WIDTH)
                    out.append((start, length, zlib.crc32(data[4 * start : 4 * (start + length)]), n, (place + start) // WIDTH, (place + start) % WIDTH))
                    which.append(i)
                    start += length
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(which, pa.int64())), *(pa.array(x, pa.int64()) for x in zip(*out, strict=True))], names=["doc_id", *NAMES])

    NAMES = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    return rows.mapInArrow(cut, f"doc_id {dict(rows.dtypes)['doc_id']}, " + ", ".join(f"{c} long" for c in NAMES))


def packed(documents: DataFrame, make_encoder) -> DataFrame:
    """documents (doc_id, text) -> doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    spark = documents.sparkSession
    stored = tokenized(own_columns(documents, ["doc_id", "text"]), make_encoder)
    path = new_path(spark, "pack-ids")
    stored.write.option("compression", "zstd").parquet(path)
    rows = spark.read.schema(stored.schema).parquet(path)
    totals = rows.groupBy("part").agg(F.sum("n").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each scan partition
    offsets = written(totals.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first")), "pack-offsets")
    return pieces_of(rows.join(offsets, "part").select("doc_id", (F.col("first") + F.col("before")).alias("place"), "ids"))
