"""Hard-negative mining with exact integer scores from a residue number system.

Components become integers floor(scale * x). A score, the inner product of two integer vectors, is computed modulo several primes
under 1024: residues are centred, at most 511, so DEPTH = 64 products add up to less than 2**24 and a float32 matrix product
is exact; longer vectors are multiplied in stretches of DEPTH whose results are reduced before they are added. Chinese
remaindering (mixed radix digits) rebuilds the signed score. There are as many primes as the largest lengths of an anchor
and a row ask for: the scores' bound by Cauchy and Schwarz, doubled for the sign, stays under their product.

The table is a grid of anchor blocks and row blocks; a cell is one task's work and returns the best few rows of each anchor, so
neither scores nor pairs are stored. The first grid, which pairs blocks of the same label only, gives the positives; the
second takes, for each anchor and positive, the best rows of other labels inside the positive's window.

Defined cases: rows with a null vec_id, label or vector, a null or non-finite component, or a vector of another length than
most (on a tie the longest) take no part; equal rows count as one; rows that share a vec_id but differ are never each other's
positives or negatives, and of two scores for the same two ids the better counts; zero vectors take part; an empty table gives
an empty result; extra columns are ignored. Scores that could reach 2**55 are an error.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import own_columns, written

SCALE = 256
DEPTH, LARGEST = 64, 1024
POSITIVES, NEGATIVES = 5, 5
#: A negative's score lies between these hundredths of the positive's.
LOWEST, HIGHEST = 80, 100
#: Anchors and rows of a grid cell at most; fewer rows where that gives the cluster too few cells; anchors scored at a time.
ANCHOR_BLOCK, ROW_BLOCK, LEAST_BLOCK, STRIP = 16_384, 32_768, 4096, 64
NONE = np.iinfo(np.int64).min
#: Scores are smaller than this, so that hundredths of them stay inside 64 bits.
MOST = 2.0**55


def primes_for(bound: float) -> list[int]:
    """The largest primes under LARGEST whose product exceeds twice the bound (with room for its own rounding)."""
    if bound >= MOST:
        raise ValueError(f"scores up to {bound:.3g} are past {MOST:.3g}")
    out, product, n = [], 1, LARGEST
    while product <= 2 * math.ceil(bound * (1 + 1e-9)) + 2:
        n -= 1
        if all(n % d for d in range(2, math.isqrt(n) + 1)):
            out.append(n)
            product *= n
    return out


def residues(x: np.ndarray, p: int) -> np.ndarray:
    """Centred residues of whole numbers held as doubles; exact for every size."""
    r = np.fmod(x, p)
    r[r > p // 2] -= p
    r[r < -(p // 2)] += p
    return r.astype(np.float32)


def reduced(x: np.ndarray, p: int) -> np.ndarray:
    """x modulo p in place, from 0 to p - 1."""
    x -= x // p * p
    return x


def residue_product(a: np.ndarray, b: np.ndarray, p: int) -> np.ndarray:
    """a @ b.T modulo p, from 0 to p - 1."""
    out = np.zeros((len(a), len(b)), np.int32)
    for low in range(0, a.shape[1], DEPTH):
        out += (a[:, low : low + DEPTH] @ b[:, low : low + DEPTH].T).astype(np.int32)
        reduced(out, p)
    return out


def reconstructed(parts: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """The signed numbers with these residues, by mixed radix digits.

    Of the M = p1 ... pk numbers, those over (M - 1) / 2 stand for negative ones. All digits of (M - 1) / 2 are p // 2, so the highest
    digit that differs from it tells the sign; a negative number comes from its complement p - 1 - digit, so that no sum leaves 64 bits.
    """
    digits: list[np.ndarray] = []
    for p, part in zip(primes, parts, strict=True):
        rest, weight = part.copy(), 1
        for d, q in zip(digits, primes):
            rest -= d * np.int32(weight)
            reduced(rest, p)
            weight = weight * q % p
        rest *= np.int32(pow(weight, -1, p))
        digits.append(reduced(rest, p))
    negative, decided = np.zeros(parts[0].shape, bool), np.zeros(parts[0].shape, bool)
    for p, d in zip(reversed(primes), reversed(digits)):
        negative |= ~decided & (d > p // 2)
        decided |= d != p // 2
    total, weight = np.zeros(parts[0].shape, np.int64), 1
    for p, d in zip(primes, digits):
        total += np.where(negative, p - 1 - d, d).astype(np.int64) * weight
        weight *= p
    return np.where(negative, -total - 1, total)


def exact_scores(anchors: np.ndarray, rows: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """(anchors, rows): inner products; `rows` are residues, one matrix a prime."""
    return reconstructed([residue_product(residues(anchors, p), r, p) for p, r in zip(primes, rows, strict=True)], primes)


def _matrix(column: pa.ChunkedArray, dims: int, scale: int) -> np.ndarray:
    x = column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(scale * x).reshape(len(column), dims)


def _best(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """For each line the places of its k largest, equal ones by place; NONE takes no part."""
    least = np.partition(scores, -k, axis=1)[:, -k] if scores.shape[1] > k else np.full(len(scores), NONE)
    line, at = np.nonzero((scores >= least[:, None]) & (scores > NONE))
    order = np.lexsort((at, -scores[line, at], line))
    line, at = line[order], at[order]
    few = np.arange(len(line)) - np.searchsorted(line, line) < k
    return line[few], at[few]


def _best_by_id(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """As _best, but of rows with one vec_id only the best counts; they are neighbours, as rows are ordered by it."""
    new = np.ones(len(ids), bool)
    new[1:] = ids[1:] != ids[:-1]
    if not new.all():
        best = np.repeat(np.maximum.reduceat(scores, np.flatnonzero(new), axis=1), np.diff(np.append(np.flatnonzero(new), len(ids))), axis=1)
        first = np.zeros(scores.shape, bool)
        for line in range(len(scores)):
            hit = np.flatnonzero((scores[line] == best[line]) & (best[line] > NONE))
            first[line, hit[np.unique(ids[hit], return_index=True)[1]]] = True
        scores = np.where(first, scores, NONE)
    return _best(scores, k)


def usable(table: DataFrame, relabel=None) -> DataFrame:  # noqa: ANN001
    """(vec_id, label, v): rows that take part, equal ones once. relabel: a column of the labels to use."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = own_columns(table, ["vec_id", "label", "embedding"]).where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.forall("embedding", finite))
    label = F.col("label") if relabel is None else relabel
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"), F.col("embedding").alias("v")).distinct()


def _blocks(count: int, largest: int, least: int, cells: int) -> int:
    return max(math.ceil(count / largest), min(math.ceil(count / least), cells), 1)


def _block(n: Column | int, salt: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(salt), "vec_id"), F.lit(n) if isinstance(n, int) else n).cast("int")


def _each(n: Column) -> Column:
    return F.explode(F.sequence(F.lit(0), n - 1))


def grid(anchors: DataFrame, rows: DataFrame, kernel, schema: str, keys: list[str]) -> DataFrame:  # noqa: ANN001
    """Every anchor block meets every row block of its group in one call of the kernel."""
    rows = rows.select(*[F.col(c).alias(c) for c in rows.columns])  # both sides may come from one table
    return anchors.groupBy(*keys).cogroup(rows.groupBy(*keys)).applyInArrow(kernel, schema)


def hard_negatives(
    table: DataFrame, every: int = 100, relabel: Column | None = None, scale: int = SCALE, positives: int = POSITIVES, negatives: int = NEGATIVES,
    lowest: int = LOWEST, highest: int = HIGHEST,
) -> DataFrame:
    """table (vec_id, label, embedding) -> anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors: vec_id divisible by `every`. A negative's score is from lowest to highest hundredths of the positive's.
    """
    spark = table.sparkSession
    rows = written(usable(table, relabel).withColumn("size", F.size("v")), "negatives-rows")
    common = rows.groupBy("size").count().orderBy(F.desc("count"), F.desc("size")).first()  # a row for each length
    dims = common["size"] if common else 0
    rows = rows.where(F.col("size") == dims).select("vec_id", "label", "v")
    anchor = F.col("vec_id") % every == 0
    # no less than the length of the whole-number vector
    square = F.aggregate("v", F.lit(0.0), lambda t, x: t + F.pow(F.abs(x.cast("double")) * scale + 1, F.lit(2.0)))
    by_label = rows.groupBy("label").agg(F.count("*").alias("n"), F.count_if(anchor).alias("asked"), F.max(square).alias("far"), F.max(F.when(anchor, square)).alias("far_asked"))
    by_label = written(by_label, "negatives-labels")
    n, asked, far, far_asked = by_label.agg(F.sum("n"), F.sum("asked"), F.max("far"), F.max("far_asked")).first()
    primes = primes_for(math.sqrt((far or 0.0) * (far_asked or 0.0)))
    cells = 2 * spark.sparkContext.defaultParallelism

    def halves(asked_rows: pa.Table, held: pa.Table):  # noqa: ANN202
        """Both sides as matrices, rows by vec_id, and the rows' residues."""
        order = np.argsort(held.column("vec_id").to_numpy(), kind="stable")
        x = _matrix(held.column("v"), dims, scale)[order]
        ids, labels = held.column("vec_id").to_numpy()[order], held.column("label").to_numpy()[order]
        q = _matrix(asked_rows.column("v"), dims, scale)
        return q, ids, labels, [residues(x, p) for p in primes]

    def nearest(asked_rows: pa.Table, held: pa.Table) -> pa.Table:
        out = [np.zeros((3, 0), np.int64)]
        if asked_rows.num_rows and held.num_rows:
            q, ids, _, parts = halves(asked_rows, held)
            own = asked_rows.column("vec_id").to_numpy()
            for low in range(0, len(q), STRIP):
                scores = exact_scores(q[low : low + STRIP], parts, primes)
                scores[own[low : low + STRIP, None] == ids] = NONE
                line, at = _best_by_id(scores, ids, positives)
                out.append(np.stack([own[low + line], ids[at], scores[line, at]]))
        return pa.table(dict(zip(("anchor_id", "vec_id", "score"), np.concatenate(out, axis=1))))

    def below(asked_rows: pa.Table, held: pa.Table) -> pa.Table:
        out = [np.zeros((4, 0), np.int64)]
        if asked_rows.num_rows and held.num_rows:
            q, ids, labels, parts = halves(asked_rows, held)
            own, label = asked_rows.column("vec_id").to_numpy(), asked_rows.column("label").to_numpy()
            near = asked_rows.column("positive").combine_chunks()
            whose, limit = np.repeat(np.arange(len(q)), near.value_lengths().to_numpy(zero_copy_only=False)), near.flatten().field("score").to_numpy()
            which = near.flatten().field("vec_id").to_numpy()
            for low in range(0, len(q), STRIP):
                scores = exact_scores(q[low : low + STRIP], parts, primes)
                scores[(label[low : low + STRIP, None] == labels) | (own[low : low + STRIP, None] == ids)] = NONE
                a, z = np.searchsorted(whose, [low, low + STRIP])
                for at in range(a, z, STRIP):
                    mine = slice(at, min(at + STRIP, z))
                    lines, top = scores[whose[mine] - low], limit[mine, None]
                    # bounds in whole numbers: 100 * negative from lowest * positive to highest * positive
                    inside = (lines >= -((-lowest * top) // 100)) & (lines <= (highest * top) // 100) & (lines > NONE)
                    line, place = _best_by_id(np.where(inside, lines, NONE), ids, negatives)
                    out.append(np.stack([own[whose[mine]][line], which[mine][line], ids[place], lines[line, place]]))
        return pa.table(dict(zip(("anchor_id", "positive_id", "negative_id", "negative_score"), np.concatenate(out, axis=1))))

    # blocks of each label: its rows and anchors in cells of bounded size; a frequent label has more of them
    blocks = by_label.where("asked > 0").select(
        "label", F.greatest(F.ceil(F.col("n") / ROW_BLOCK), F.least(F.ceil(F.col("n") / LEAST_BLOCK), F.lit(cells))).cast("int").alias("row_blocks"),
        F.ceil(F.col("asked") / ANCHOR_BLOCK).cast("int").alias("anchor_blocks"),
    )
    held = rows.join(blocks, "label")
    left = held.where(anchor).select("vec_id", "v", "label", _block(F.col("anchor_blocks"), 1).alias("x"), _each(F.col("row_blocks")).alias("y"))
    right = held.select("vec_id", "v", "label", _each(F.col("anchor_blocks")).alias("x"), _block(F.col("row_blocks"), 2).alias("y"))
    found = grid(left, right, nearest, "anchor_id long, vec_id long, score long", ["label", "x", "y"])
    found = found.groupBy("anchor_id", "vec_id").agg(F.max("score").alias("score"))
    first = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "vec_id")
    best = found.withColumn("place", F.row_number().over(first)).where(F.col("place") <= positives)
    best = written(best.groupBy("anchor_id").agg(F.array_sort(F.collect_list(F.struct("place", "vec_id", "score"))).alias("positive")), "negatives-positives")

    x_blocks, y_blocks = _blocks(asked or 0, ANCHOR_BLOCK, ANCHOR_BLOCK, 1), _blocks(n or 0, ROW_BLOCK, LEAST_BLOCK, cells)
    asking = rows.where(anchor).join(best, F.col("vec_id") == F.col("anchor_id"))
    left = asking.select("vec_id", "v", "label", "positive", _block(x_blocks, 1).alias("x"), _each(F.lit(y_blocks)).alias("y"))
    right = rows.select("vec_id", "v", "label", _each(F.lit(x_blocks)).alias("x"), _block(y_blocks, 2).alias("y"))
    found = grid(left, right, below, "anchor_id long, positive_id long, negative_id long, negative_score long", ["x", "y"])
    keys = ["anchor_id", "positive_id"]
    found = found.groupBy(*keys, "negative_id").agg(F.max("negative_score").alias("negative_score"))
    chosen = Window.partitionBy(*keys).orderBy(F.desc("negative_score"), "negative_id")
    found = found.withColumn("rank", F.row_number().over(chosen)).where(F.col("rank") <= negatives)
    known = best.select("anchor_id", F.explode("positive").alias("p")).select("anchor_id", F.col("p.vec_id").alias("positive_id"), F.col("p.score").alias("positive_score"))
    return found.join(known, keys).select(*keys, "rank", "negative_id", "positive_score", "negative_score")
