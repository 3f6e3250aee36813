"""Small column helpers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which null keys meet; the keys come from the left side."""
    other = {k: f"_right_{k}" for k in keys}
    renamed = right.withColumnsRenamed(other)
    cond = F.lit(True)
    for k, r in other.items():
        cond = cond & col(k).eqNullSafe(col(r))
    return left.join(renamed, cond, how).drop(*other.values())


def col(name: str) -> Column:
    """Column by its exact name; class names such as ``F&B`` need quoting."""
    return F.col("`" + name.replace("`", "``") + "`")


def lit_d(value: float) -> Column:
    return F.lit(float(value))


def clip(c: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(c, lit_d(low)), lit_d(high))


def text_array(values: Sequence[str]) -> Column:
    """Literal ``array<string>``, typed even when empty."""
    if not values:
        return F.array().cast("array<string>")
    return F.array(*[F.lit(v) for v in values])


def keep_only(words: Column, wanted: Sequence[str]) -> Column:
    """Elements of ``words`` that are in ``wanted``, in order."""
    if not wanted:
        return text_array([])
    return F.filter(words, lambda w: w.isin(*wanted))


def total(columns: Sequence[Column]) -> Column:
    out = columns[0]
    for c in columns[1:]:
        out = out + c
    return out


def require_columns(df: DataFrame, names: Sequence[str], what: str) -> None:
    """Fail while the plan is built when a table lacks needed columns."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"{what}: missing columns {missing}")


def prefixed_classes(df: DataFrame, prefix: str) -> list[str]:
    """Class names carried by the probability columns, in column order."""
    return [c[len(prefix):] for c in df.columns if c.startswith(prefix)]


def map_lookup(key: Column, table: Mapping[str, float] | Column, default: Column | float | None) -> Column:
    """Value of ``key`` in a class-keyed table, else ``default``.

    ``table`` is a dict (becomes a literal) or a ``map<string,double>`` column,
    e.g. the scalar subquery made by :func:`map_from_table`. Either way the
    lookup is row-local: no join, no shuffle.
    """
    if isinstance(table, Mapping):
        hit = F.lit(None).cast("double")
        branches = None
        for k, v in table.items():
            cond = key == F.lit(str(k))
            branches = F.when(cond, lit_d(v)) if branches is None else branches.when(cond, lit_d(v))
        hit = branches if branches is not None else hit
    else:
        # a null key is an error for map lookups, hence the empty-string stand-in
        hit = F.try_element_at(table, F.coalesce(key, F.lit("")))
    if default is None:
        return hit
    return F.coalesce(hit, lit_d(default) if isinstance(default, (int, float)) else default)


def map_from_table(table: DataFrame, key: str, value: str) -> Column:
    """Turn a small (class, value) table into one map column (scalar subquery).

    The table has one row per class, so the map stays as small as the label set.
    """
    return table.agg(
        F.map_from_entries(F.collect_list(F.struct(col(key), col(value).cast("double"))))
    ).scalar()


def argmax_label(classes: Sequence[str], probs: Sequence[Column]) -> Column:
    """First class (in the given order) whose value equals the row maximum."""
    if len(probs) == 1:
        return F.lit(classes[0])
    top = F.greatest(*probs)
    out = F.when(probs[0] == top, F.lit(classes[0]))
    for name, p in zip(classes[1:], probs[1:]):
        out = out.when(p == top, F.lit(name))
    return out


def row_max(probs: Sequence[Column]) -> Column:
    return probs[0] if len(probs) == 1 else F.greatest(*probs)


def hash_hex(key: Column, seed: int | str) -> Column:
    """Seeded md5 of a row key as 32 hex digits: a portable, repeatable shuffle key."""
    return F.md5(F.concat(key.cast("string"), F.lit(f"-{seed}")))


def uniform(key: Column, salt: int | str) -> Column:
    """Repeatable draw in [0, 1) from the first 32 bits of the seeded hash."""
    return F.conv(F.substring(hash_hex(key, salt), 1, 8), 16, 10).cast("double") / lit_d(2.0**32)
