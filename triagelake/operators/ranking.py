"""Exact ranks and order statistics for groups of any size.

A window over a whole group puts the group on one task. Here values are first
counted in ordered buckets, so that only one bucket has to be sorted: every
window below runs over at most ``BUCKETS`` counters or over the rows of a
single bucket.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.base import col, lit_d, same_keys
from ..sources.materialise import materialise

BUCKETS = 65536


def unit_bucket(value: Column, level: int) -> Column:
    """Ordered buckets for numbers in [0, 1]; each level splits a bucket 65 536 ways.

    Out-of-range values fall in the outermost buckets, which keeps the order.
    Scaling by a power of two is exact.
    """
    steps = float(BUCKETS) ** (level + 1)
    at = F.least(F.greatest(F.floor(value * lit_d(steps)), F.lit(0)), F.lit(int(steps) - 1))
    return F.pmod(at, F.lit(BUCKETS)).cast("int")


def hex_bucket(value: Column, level: int) -> Column:
    """Ordered buckets for lower-case hex strings: four digits per level."""
    return F.conv(F.substring(value, 4 * level + 1, 4), 16, 10).cast("int")


def order_statistics(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    ranks: Mapping[str, Callable[[Column], Column]] | DataFrame,
    bucket: Callable[[Column, int], Column] = unit_bucket,
    levels: int = 2,
) -> DataFrame:
    """Values at 0-based ranks of the sorted group: rows (keys..., name, group_rows, value).

    ``ranks`` maps a name to a function of the group's row count, or is a table
    (keys..., name, rank). Groups are label-like (classes, strata): there is one
    target row per group and name, which is what gets broadcast to find the
    rows of the bucket concerned. The keys and values are written out once and
    read once per level and once more; only counters are shuffled.
    """
    keys = list(keys)
    rows = materialise(df.select(*[col(k) for k in keys], col(value).alias("_v"))).filter(F.col("_v").isNotNull())
    group = keys
    if not keys:
        rows = rows.withColumn("_all", F.lit(0))
        group = ["_all"]
    for level in range(levels):
        rows = rows.withColumn(f"_b{level}", bucket(F.col("_v"), level))

    path: list[str] = []
    target: DataFrame | None = None
    for level in range(levels):
        step = f"_b{level}"
        if target is None:
            hist = rows.groupBy(*group, step).agg(F.count("*").alias("_n"))
            whole = Window.partitionBy(*group)
            hist = hist.withColumns({
                "_upto": F.sum("_n").over(whole.orderBy(step).rowsBetween(Window.unboundedPreceding, 0)),
                "group_rows": F.sum("_n").over(whole),
            })
            if isinstance(ranks, DataFrame):
                wanted = ranks.withColumnsRenamed({"name": "_name", "rank": "_rank"})
                hist = same_keys(hist, wanted, keys) if keys else hist.withColumn("_one", F.lit(0)).join(
                    F.broadcast(wanted.withColumn("_one", F.lit(0))), "_one").drop("_one")
            else:
                pairs = F.array(*[
                    F.struct(F.lit(name).alias("_name"), fn(F.col("group_rows")).cast("long").alias("_rank"))
                    for name, fn in ranks.items()
                ])
                hist = hist.select("*", F.inline(pairs))
        else:
            part = same_keys(rows, target, [*group, *path])
            hist = part.groupBy(*group, *path, "_name", "_rank", "group_rows", step).agg(F.count("*").alias("_n"))
            inside = Window.partitionBy(*group, *path, "_name").orderBy(step)
            hist = hist.withColumn("_upto", F.sum("_n").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
        before = F.col("_upto") - F.col("_n")
        path.append(step)
        target = hist.filter((F.col("_rank") >= before) & (F.col("_rank") < F.col("_upto"))).select(
            *group, *path, "_name", (F.col("_rank") - before).alias("_rank"), "group_rows"
        )

    part = same_keys(rows, target, [*group, *path])
    counts = part.groupBy(*group, *path, "_name", "_rank", "group_rows", "_v").agg(F.count("*").alias("_n"))
    inside = Window.partitionBy(*group, *path, "_name").orderBy("_v")
    upto = F.sum("_n").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    found = counts.withColumn("_upto", upto).filter(
        (F.col("_rank") >= F.col("_upto") - F.col("_n")) & (F.col("_rank") < F.col("_upto"))
    )
    # one row per group and name; written out so that readers do not repeat the search
    return materialise(found.select(
        *[col(k) for k in keys], F.col("_name").alias("name"), "group_rows", F.col("_v").alias("value")
    ))


def quantiles(df: DataFrame, keys: Sequence[str], value: str, q: float) -> DataFrame:
    """Exact linear-interpolation quantile per group: (keys..., group_rows, quantile)."""
    def position(n: Column) -> Column:
        return (n - F.lit(1)).cast("double") * lit_d(q)

    picked = order_statistics(df, keys, value, {
        "low": lambda n: F.floor(position(n)),
        "high": lambda n: F.ceil(position(n)),
    })
    low = F.max(F.when(F.col("name") == "low", F.col("value")))
    high = F.max(F.when(F.col("name") == "high", F.col("value")))
    n = F.max("group_rows")
    share = position(n) - F.floor(position(n))
    return picked.groupBy(*[col(k) for k in keys]).agg(
        n.alias("group_rows"), (low + (high - low) * share).alias("quantile")
    )


def row_ranks(
    df: DataFrame, keys: Sequence[str], bucket: Column, order: Sequence[Column], out: str = "rank"
) -> DataFrame:
    """0-based rank of every row in its group, as ``row_number() - 1`` would give it.

    ``bucket`` must not decrease along ``order``. Rows are numbered inside their
    (group, bucket) and shifted by the number of rows in earlier buckets. The
    offsets are counters, and the join runs on the partitioning the window
    needs anyway.
    """
    keys = list(keys)
    group = keys or ["_all"]
    rows = df.withColumn("_bucket", bucket)
    if not keys:
        rows = rows.withColumn("_all", F.lit(0))
    counts = rows.groupBy(*group, "_bucket").agg(F.count("*").alias("_n"))
    running = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    offsets = counts.select(*group, "_bucket", (F.sum("_n").over(running) - F.col("_n")).alias("_before"))
    # null keys are groups of their own, as in groupBy
    cond = rows["_bucket"].eqNullSafe(offsets["_bucket"])
    for k in group:
        cond = cond & rows[k].eqNullSafe(offsets[k])
    inside = Window.partitionBy(*[rows[k] for k in group], rows["_bucket"]).orderBy(*order)
    joined = rows.join(offsets, cond)
    kept = [rows[c] for c in df.columns]
    return joined.select(*kept, (offsets["_before"] + F.row_number().over(inside) - 1).alias(out))


CUTS = 256


def range_bucket(df: DataFrame, name: str) -> Column:
    """Ordered buckets for an integer column: between approximate quantiles, each stretch cut evenly.

    Outliers widen their own stretch alone.
    """
    x = col(name)
    # CUTS + 1 numbers; subqueries are not allowed inside lambdas, so they are read here
    values = df.agg(F.percentile_approx(x, [i / CUTS for i in range(CUTS + 1)])).first()[0]
    cuts = F.array(*[F.lit(v).cast("long") for v in sorted(set(values or []))]).cast("array<bigint>")
    at = F.size(F.filter(cuts, lambda c: c <= x))
    low, high = F.get(cuts, at - 1), F.get(cuts, at)
    share = F.floor((x - low).cast("double") / (high - low).cast("double") * lit_d(CUTS))
    inner = F.when((at > 0) & (high > low), F.least(F.greatest(share, F.lit(0)), F.lit(CUTS - 1))).otherwise(F.lit(0))
    return (at * CUTS + inner).cast("int")
