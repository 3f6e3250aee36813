"""Ranked lexical search by dense blocked multiplication.

Items are worked off in rounds of at most ROUND_TERMS different (item, term) entries, or one longer item; a round's terms are
its vocabulary, which is all that the tasks are sent. One scan of the documents counts every term of every whole text and
stores, per document, its length and the occurrences of the vocabulary's terms. From the stored rows come the number of
documents, their terms and the document frequencies.

The scores are matrix products in float64. A block of items has a compact vocabulary of its own, cut into tiles of TILE terms;
a tile of documents holds their impacts at these terms. An impact is at most 10**6 < 2**20, item weights are cut into limbs of
LIMB = 20 bits, and a tile has 2**11 terms, so that a partial sum stays below 2**51 and float64 is exact, whatever the
items hold; limbs and tiles are added up in 64-bit integers. Of each tile of documents those at least as good as the k-th best score
stay, equal scores included, before they are ordered by score and doc_id and cut to k; so ties never depend on the tiles.
A task returns k rows an item at most; these are merged in two steps, first over a part of the tasks.

Terms are compared by two 64-bit hashes.

Defined cases: null texts and texts without a term have no terms and aren't counted as documents; repeated documents are
documents of their own; null doc_ids come last among equal scores; every item row is an item of its own, with its item_id
carried along; items without a known term, and empty tables, give no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import kernels as K
from .shared import own_columns, written

K_BEST = 20
ROUND_TERMS = 1 << 20
ITEM_BLOCK, DOCUMENT_TILE, TILE, LIMB = 256, 1024, 1 << 11, 20
#: Parts of the tasks whose best rows are merged first.
MERGES = 64
#: b and the share of the length in the saturation, in hundredths.
LENGTH_SHARE = 25

#: Separators become blanks, A-Z lower case; digits, letters and all bytes of other characters stay.
_FOLD = np.full(256, 0x20, np.uint8)
for _low, _high in ((0x30, 0x3A), (0x61, 0x7B), (0x80, 0x100)):
    _FOLD[_low:_high] = np.arange(_low, _high)
_FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)
_OTHER = ((np.arange(256) * 91 + 17) % 256).astype(np.uint8)
LAST = np.iinfo(np.int64).max


def terms_in(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Both hashes of every term of every text, and the number of terms before each text."""
    raw, bounds = K.text_bytes(column)
    data = _FOLD[raw]
    starts, ends, before = K.word_bounds(data, bounds)
    return K.span_hashes(data, starts, ends), K.span_hashes(_OTHER[data], starts, ends), before


def item_terms(items: DataFrame) -> DataFrame:
    """(item, item_id, round, a, b, q): the different terms of each item as hashes and their occurrences."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, held = TaskContext.get().partitionId(), 0, 0
        round_ = part << 32
        for batch in K.slices(batches, 1):
            a, b, before = terms_in(batch.column(1))
            out = []
            for i in range(batch.num_rows):
                own = np.stack([x[before[i] : before[i + 1]].view(np.int64) for x in (a, b)], axis=1)
                different, counts = np.unique(own, axis=0, return_counts=True)
                if held and held + len(different) > ROUND_TERMS:
                    round_, held = round_ + 1, 0
                held += len(different)
                out.append(((part << 32) + number, round_, different[:, 0], different[:, 1], counts))
                number += 1
            key, rounds, *lists = zip(*out, strict=True)
            arrays = [pa.array(key, pa.int64()), batch.column(0), pa.array(rounds, pa.int64()), *(pa.array(x, pa.list_(pa.int64())) for x in lists)]
            yield pa.RecordBatch.from_arrays(arrays, names=["item", "item_id", "round", "a", "b", "q"])

    return items.mapInArrow(scan, f"item long, item_id {dict(items.dtypes)['item_id']}, round long, a array<long>, b array<long>, q array<long>")


@dataclass
class Items:
    """The items of a round as entries (item, vocabulary place, occurrences) and the vocabulary, ordered by hash."""

    keys: np.ndarray
    row: np.ndarray
    place: np.ndarray
    often: np.ndarray
    first: np.ndarray
    second: np.ndarray
    #: Terms with the same first hash, at most.
    twins: int

    @classmethod
    def of(cls, rows: pa.Table) -> Items:
        flat = lambda name: rows.column(name).combine_chunks().flatten().to_numpy(zero_copy_only=False)
        a, b = flat("a").view(np.uint64), flat("b").view(np.uint64)
        order = np.lexsort((b, a))
        new = np.ones(len(a), bool)
        new[1:] = (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])
        place = np.empty(len(a), np.int64)
        place[order] = np.cumsum(new) - 1
        sizes = rows.column("a").combine_chunks().value_lengths().to_numpy(zero_copy_only=False)
        first, second = a[order][new], b[order][new]
        twins = int(np.unique(first, return_counts=True)[1].max(initial=0))
        return cls(rows.column("item").to_numpy(), np.repeat(np.arange(rows.num_rows), sizes), place, flat("q"), first, second, twins)

    def places(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The vocabulary place of each term, or -1."""
        found = np.full(len(a), -1, np.int64)
        at = np.searchsorted(self.first, a)
        for _ in range(self.twins):
            inside = np.minimum(at, len(self.first) - 1)
            same = (at < len(self.first)) & (self.first[inside] == a) & (self.second[inside] == b)
            found[same] = at[same]
            at = at + 1
        return found


def postings(documents: DataFrame, items) -> DataFrame:  # noqa: ANN001
    """(doc_id, n, term, tf): documents with a term, their length, and their occurrences of the vocabulary (a broadcast Items)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = items.value
        for batch in K.slices(batches, 1):
            a, b, before = terms_in(batch.column(1))
            place = known.places(a, b)
            seen = np.flatnonzero(place >= 0)
            size = max(1, len(known.first))
            cells, tf = np.unique(K.rows_of(before)[seen] * size + place[seen], return_counts=True)
            bounds = np.searchsorted(cells, np.arange(batch.num_rows + 1) * size)
            lists = [pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(x.astype(np.int32))) for x in (cells % size, tf)]
            n = np.diff(before)
            out = pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(n.astype(np.int64)), *lists], names=["doc_id", "n", "term", "tf"])
            yield out.filter(pa.array(n > 0))

    return documents.mapInArrow(scan, "doc_id long, n long, term array<int>, tf array<int>")


@dataclass
class Block:
    """Items `first` to `first + count`; their entries by compact place, and the vocabulary places of these."""

    first: int
    count: int
    terms: np.ndarray
    row: np.ndarray
    at: np.ndarray
    weight: np.ndarray


def blocks_of(items: Items, weight: np.ndarray) -> list[Block]:
    """weight: of each vocabulary term."""
    out = []
    for first in range(0, len(items.keys), ITEM_BLOCK):
        lo, hi = np.searchsorted(items.row, [first, first + ITEM_BLOCK])
        total = items.often[lo:hi] * weight[items.place[lo:hi]]
        use = np.flatnonzero(total > 0) + lo
        terms, at = np.unique(items.place[use], return_inverse=True)
        order = np.argsort(at, kind="stable")
        out.append(Block(first, min(ITEM_BLOCK, len(items.keys) - first), terms, items.row[use][order] - first, at[order], total[use - lo][order]))
    return out


def block_scores(block: Block, row: np.ndarray, term: np.ndarray, impact: np.ndarray, documents: int) -> np.ndarray:
    """(items, documents): exact scores of a tile of documents, whose entries are (row, term, impact)."""
    out = np.zeros((block.count, documents), np.int64)
    at = np.searchsorted(block.terms, term)
    inside = at < len(block.terms)
    inside[inside] = block.terms[at[inside]] == term[inside]
    row, at, impact = row[inside], at[inside], impact[inside]
    for low in range(0, len(block.terms), TILE):
        width = min(TILE, len(block.terms) - low)
        here = (at >= low) & (at < low + width)
        if not here.any():
            continue
        impacts = np.zeros((width, documents))
        impacts[at[here] - low, row[here]] = impact[here]
        a, z = np.searchsorted(block.at, [low, low + width])
        weight, shift = block.weight[a:z], 0
        while weight.any():
            limb = np.zeros((block.count, width))
            limb[block.row[a:z], block.at[a:z] - low] = weight & ((1 << LIMB) - 1)
            out += (limb @ impacts).astype(np.int64) << shift
            weight, shift = weight >> LIMB, shift + LIMB
    return out


def best_of(item: np.ndarray, score: np.ndarray, doc: np.ndarray, k: int) -> np.ndarray:
    """Places of each item's k best entries: highest score, then smallest doc."""
    order = np.lexsort((doc, -score, item))
    starts = np.searchsorted(item[order], item[order])
    return order[np.arange(len(order)) - starts < k]


def searched(rows: DataFrame, blocks, keys, counted: int, length: int, k: int) -> DataFrame:  # noqa: ANN001
    """postings -> (item, doc_id, score, task): the k best of each task's documents. blocks, keys: broadcast."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((3, 0), np.int64)
        least = np.ones(len(keys.value), np.int64)
        for batch in (b.slice(i, DOCUMENT_TILE) for b in batches for i in range(0, b.num_rows, DOCUMENT_TILE)):
            ids = batch.column(0).fill_null(LAST).to_numpy(zero_copy_only=False)
            n = batch.column(1).to_numpy()
            size = batch.column(2).value_lengths().to_numpy(zero_copy_only=False)
            term, tf = (batch.column(c).flatten().to_numpy().astype(np.int64) for c in (2, 3))
            row = np.repeat(np.arange(batch.num_rows), size)
            m = 100 - LENGTH_SHARE + (LENGTH_SHARE * n * counted) // length
            impact = (1_000_000_000 * tf) // (1000 * tf + 12 * m[row])
            found = [held]
            for block in blocks.value:
                scores = block_scores(block, row, term, impact, batch.num_rows)
                least_here = least[block.first : block.first + block.count]
                if batch.num_rows > k:
                    least_here = np.maximum(least_here, np.partition(scores, -k, axis=1)[:, -k])
                item, doc = np.nonzero(scores >= least_here[:, None])
                found.append(np.stack([item + block.first, scores[item, doc], ids[doc]]))
            held = np.concatenate(found, axis=1)
            held = held[:, best_of(*held, k)]
            full = np.bincount(held[0], minlength=len(least)) == k
            least[full] = held[1, np.searchsorted(held[0], np.flatnonzero(full), "right") - 1]
        if held.size:
            doc = pa.array(held[2], mask=held[2] == LAST)
            task = np.full(held.shape[1], TaskContext.get().partitionId())
            yield pa.RecordBatch.from_arrays([pa.array(keys.value[held[0]]), doc, pa.array(held[1]), pa.array(task)], names=["item", "doc_id", "score", "task"])

    return rows.mapInArrow(scan, "item long, doc_id long, score long, task long")


def rounds_of(stored: DataFrame) -> list[list[int]]:
    """The item scan's rounds, small ones put together up to ROUND_TERMS entries; a row for each is read."""
    sizes = stored.groupBy("round").agg(F.sum(F.size("a")).alias("n")).orderBy("round").collect()
    out, held = [], ROUND_TERMS + 1
    for round_, n in sizes:
        if held + n > ROUND_TERMS:
            out.append([])
            held = 0
        out[-1].append(round_)
        held += n
    return out


def ranked(items: DataFrame, documents: DataFrame, k: int = K_BEST) -> DataFrame:
    """items (item_id, text), documents (doc_id, text) -> item_id, rank, doc_id, score; doc_id is an integer."""
    spark = documents.sparkSession
    stored = written(item_terms(own_columns(items, ["item_id", "text"])), "rank-items")
    documents = own_columns(documents, ["doc_id", "text"])
    best = spark.createDataFrame([], "item long, doc_id long, score long, task long")
    for chosen in rounds_of(stored):
        held = Items.of(stored.where(F.col("round").isin(chosen)).select("item", "a", "b", "q").toArrow())
        if not len(held.first):
            continue
        rows = written(postings(documents, spark.sparkContext.broadcast(held)), "rank-postings")
        counted, length = rows.agg(F.count("*"), F.sum("n")).first()
        # a row for each term of the vocabulary at most
        df = rows.select(F.explode("term").alias("term")).groupBy("term").count().collect()
        weight = np.zeros(len(held.first), np.int64)
        for term, documents_with in df:
            weight[term] = math.floor(1000 * math.log((2 * counted + 2) / (2 * documents_with + 1)))
        blocks, keys = spark.sparkContext.broadcast(blocks_of(held, weight)), spark.sparkContext.broadcast(held.keys)
        best = best.unionByName(searched(rows, blocks, keys, counted, length, k))
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    part = F.pmod(F.xxhash64("task"), F.lit(MERGES))
    some = best.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("item", "part").orderBy(*order))).where(F.col("rank") <= k)
    final = some.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k)
    return final.join(stored.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
