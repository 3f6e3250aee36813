"""Nearest neighbours by inner product: a forest of random-projection trees and an exact reranking.

Every vector gets one more component that gives all the same length (queries get 0 there), so that the largest inner product
is the smallest angle. A tree splits at the median of the projections on the difference of two random vectors; it is fitted
on SAMPLE rows at most (those with the smallest hashes), and every row is then put into one leaf of each tree. A query looks
for its leaves through one priority queue over all trees, nearest margin first, and visits PROBES of them; that is a fixed
share of the leaves, so recall doesn't fall as it grows. Candidates are scored exactly in double precision.

Leaves are worked off in blocks of BLOCK rows and QUERY_BLOCK queries, so a leaf that holds a frequent vector many times is
spread over tasks; equal vectors are scored once.

Defined cases: vectors that are null, zero, of another length than the sample's most common, or with null or non-finite
components take no part, nor do rows with a null vec_id; rows with equal vec_id count as one, with its best score; with fewer
candidates than k all are returned; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import own_columns, written

K_NEAREST = 20
#: Levels of a tree at most; fewer where the sample has under LEAST_LEAF rows for each leaf.
TREES, DEPTH, PROBES, LEAST_LEAF = 4, 6, 96, 64
#: Rows that the trees are fitted on, at most; rows of a leaf's block; queries of a block.
SAMPLE, BLOCK, QUERY_BLOCK = 20_000, 4096, 2048
SEED = 7


class Forest:
    """Inner node i of a tree has children 2i + 1 and 2i + 2; leaves are numbered by their path."""

    def __init__(self, sample: np.ndarray, longest: float) -> None:
        self.longest = longest
        points = self.lifted(sample)
        rng = np.random.default_rng(SEED)
        self.depth = min(DEPTH, max(0, (len(sample) // LEAST_LEAF).bit_length() - 1))
        self.inner = inner = (1 << self.depth) - 1
        self.normals = np.zeros((TREES, inner, points.shape[1]))
        self.cuts = np.zeros((TREES, inner))
        for t in range(TREES):
            members = {0: np.arange(len(points))}
            for i in range(inner):
                own = members.pop(i)
                if len(own) > 1:
                    a, b = points[rng.choice(own, 2, replace=False)]
                    normal = a - b
                else:
                    normal = rng.standard_normal(points.shape[1])
                if not (length := np.linalg.norm(normal)):
                    normal = rng.standard_normal(points.shape[1])
                    length = np.linalg.norm(normal)
                self.normals[t, i] = normal / length
                at = points[own] @ self.normals[t, i]
                self.cuts[t, i] = np.median(at) if len(own) else 0.0
                members[2 * i + 1], members[2 * i + 2] = own[at <= self.cuts[t, i]], own[at > self.cuts[t, i]]

    def lifted(self, x: np.ndarray) -> np.ndarray:
        x = x / self.longest
        return np.hstack([x, np.sqrt(np.maximum(0, 1 - (x * x).sum(1)))[:, None]])

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row in each tree, numbered over all trees."""
        points, out = self.lifted(x), np.zeros((len(x), TREES), np.int64)
        for t in range(TREES):
            sides = points @ self.normals[t].T > self.cuts[t]
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                at = 2 * at + 1 + sides[np.arange(len(x)), at]
            out[:, t] = (t << self.depth) + at - self.inner
        return out

    def visited(self, queries: np.ndarray) -> list[list[int]]:
        """The PROBES leaves of each query, by one queue over all trees: the worst margin on the way to a node is its rank."""
        directed = queries / np.linalg.norm(queries, axis=1)[:, None]
        margins = np.einsum("qd,tid->qti", directed, self.normals[:, :, :-1]) - self.cuts
        inner, out = self.inner, []
        for m in margins:
            queue = [(0.0, t, 0) for t in range(TREES)]
            found: list[int] = []
            rows = [r.tolist() for r in m]
            while queue and len(found) < PROBES:
                worst, t, i = heapq.heappop(queue)
                while i < inner:
                    margin = rows[t][i]
                    near, far = (2 * i + 2, 2 * i + 1) if margin > 0 else (2 * i + 1, 2 * i + 2)
                    heapq.heappush(queue, (max(worst, abs(margin)), t, far))
                    i = near
                found.append((t << self.depth) + i - inner)
            out.append(found)
        return out


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)


def usable(rows: DataFrame) -> DataFrame:
    """(vec_id, v): rows whose vector takes part."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return rows.select("vec_id", F.col("embedding").cast("array<double>").alias("v")).where(F.col("vec_id").isNotNull() & F.forall("v", finite) & F.exists("v", lambda x: x != 0))


def nearest(embeddings: DataFrame, every: int = 20, k: int = K_NEAREST) -> DataFrame:
    """embeddings (vec_id, embedding) -> query_id, rank, vec_id, score. Queries: vec_id divisible by `every`."""
    spark = embeddings.sparkSession
    rows = usable(own_columns(embeddings, ["vec_id", "embedding"]))
    sample = [r["v"] for r in rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("v").collect()]
    sizes = [len(v) for v in sample]
    dims = max(sorted(set(sizes)), key=sizes.count) if sizes else 1
    rows = rows.where(F.size("v") == dims)
    longest = rows.agg(F.sqrt(F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)))).first()[0] or 1.0
    forest = spark.sparkContext.broadcast(Forest(np.array([v for v in sample if len(v) == dims] or [[1.0] * dims]), longest))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                leaves = forest.value.leaves(_matrix(batch.column(1), dims))
                which = pa.array(np.repeat(np.arange(batch.num_rows), TREES))
                yield pa.RecordBatch.from_arrays([pa.array(leaves.ravel()), batch.column(0).take(which), batch.column(1).take(which).cast(pa.list_(pa.float64()))], names=["leaf", "id", "v"])

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = forest.value.visited(_matrix(batch.column(1), dims))
                which = pa.array(np.repeat(np.arange(batch.num_rows), [len(x) for x in found]))
                yield pa.RecordBatch.from_arrays([pa.array([x for leaf in found for x in leaf]), batch.column(0).take(which), batch.column(1).take(which)], names=["leaf", "id", "v"])

    kind = "leaf long, id long, v array<double>"
    index = rows.select(F.col("vec_id").cast("long"), "v").mapInArrow(place, kind)
    queries = rows.where(F.col("vec_id") % every == 0).select(F.col("vec_id").cast("long"), "v").mapInArrow(route, kind)
    # TREES * 2**DEPTH rows at most
    count = lambda df, name, size: df.groupBy("leaf").agg(F.ceil(F.count("*") / size).alias(name))
    blocks = F.broadcast(written(count(index, "blocks", BLOCK).join(count(queries, "query_blocks", QUERY_BLOCK), "leaf"), "forest-blocks"))
    part = lambda n, salt: F.pmod(F.xxhash64(F.lit(salt), "id"), F.col(n)).alias(n)
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1)).alias(n)
    index = index.join(blocks, "leaf").select("leaf", "id", "v", part("blocks", 1), each("query_blocks"))
    queries = queries.join(blocks, "leaf").select("leaf", "id", "v", each("blocks"), part("query_blocks", 2))

    def score(asked: pa.Table, held: pa.Table) -> pa.Table:
        if not asked.num_rows or not held.num_rows:
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        q, x = _matrix(asked.column("v").combine_chunks(), dims), _matrix(held.column("v").combine_chunks(), dims)
        ids = held.column("id").to_numpy()
        order = np.argsort(ids, kind="stable")
        ids, x = ids[order], x[order]
        _, first, inverse = np.unique(x + 0.0, axis=0, return_index=True, return_inverse=True)
        vectors, by_vector = x[first], np.argsort(inverse, kind="stable")
        starts = np.searchsorted(inverse[by_vector], np.arange(len(first) + 1))
        out_q, out_v, out_s = [], [], []
        rough = q @ vectors.T
        slack = 1e-9 * np.linalg.norm(q, axis=1) * np.linalg.norm(vectors, axis=1).max()
        for i, query in enumerate(asked.column("id").to_pylist()):
            row = rough[i]
            cut = np.partition(row, -(k + 1))[-(k + 1)] if len(row) > k + 1 else row.min()
            near = np.flatnonzero(row >= cut - slack[i])
            exact = (q[i] * vectors[near]).sum(1)
            # of equal vectors the k + 1 smallest ids are enough for k ranks without the query itself
            members = [ids[by_vector[starts[n] : min(starts[n + 1], starts[n] + k + 1)]] for n in near]
            found, scores = np.concatenate(members), np.repeat(exact, [len(m) for m in members])
            found, scores = found[found != query], scores[np.concatenate(members) != query]
            best = np.lexsort((found, -scores))[:k]
            out_q.append(np.full(len(best), query))
            out_v.append(found[best])
            out_s.append(scores[best])
        return pa.table({"query_id": np.concatenate(out_q).astype(np.int64), "vec_id": np.concatenate(out_v).astype(np.int64), "score": np.concatenate(out_s)})

    keys = ["leaf", "blocks", "query_blocks"]
    candidates = queries.groupBy(*keys).cogroup(index.groupBy(*keys)).applyInArrow(score, "query_id long, vec_id long, score double")
    # k rows from each leaf a query has visited: PROBES * k at most
    different = candidates.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return different.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
