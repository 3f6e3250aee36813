"""URL rules by host-suffix and path-prefix expressions, in DataFrame operations alone.

A rule is a host (with all its subdomains) and a path start. Every different host and path is expanded into the host
suffixes and path starts that a rule could have; expressions meet rules by equal short hash prefixes, full digests
confirm, and the longest rule wins (block before allow, then by code point, between rules of equal length).

Only suffixes with as many labels, and path starts with as many characters, as some rule has are made: an expression of
another shape equals no rule. Both lists are bounded by the longest rule, not by the number of rules.

Defined cases: a null url and one without :// have an empty host and path and fit no rule; repeated rows are judged alike;
an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import ascii_lower, own_columns, written

DEFAULT_VERDICT = "allow"
HASH_CHARS = 8
#: The rules of the query: (verdict, host, path).
RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    return spark.createDataFrame(rules, "verdict string, host string, path string")


def host_of(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def expressions(places: DataFrame, labels: list[int], lengths: list[int]) -> DataFrame:
    """(host, path) -> one row for each expression that a rule could have."""
    n_labels = F.size(F.split("host", "[.]"))
    suffixes = F.filter(F.array(*[F.struct(F.lit(n).alias("n"), F.substring_index("host", ".", -n).alias("s")) for n in labels]), lambda x: (x["n"] <= n_labels) & (x["s"] != ""))
    starts = F.filter(F.array(*[F.struct(F.lit(n).alias("n"), F.substring("path", 1, n).alias("s")) for n in lengths]), lambda x: F.length(x["s"]) == x["n"])
    every = F.flatten(F.transform(suffixes, lambda h: F.transform(starts, lambda p: F.concat(h["s"], p["s"]))))
    return places.select("host", "path", F.explode(every).alias("expression")).withColumn("digest", F.sha2("expression", 256))


def judged(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """pages (page_id, url) -> page_id, host, path, rule, verdict."""
    rows = own_columns(pages, ["page_id", "url"]).select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    table = written(rules.select("verdict", F.concat("host", "path").alias("rule"), F.size(F.split("host", "[.]")).alias("labels"), F.length("path").alias("chars")), "url-rules")
    labels, lengths = (sorted(r[0] for r in table.select(c).distinct().collect()) for c in ("labels", "chars"))
    hashed = table.withColumn("rule_digest", F.sha2("rule", 256)).select("verdict", "rule", "rule_digest", F.substring("rule_digest", 1, HASH_CHARS).alias("short"))
    met = (
        expressions(rows.select("host", "path").distinct(), labels, lengths)
        .withColumn("short", F.substring("digest", 1, HASH_CHARS))
        .join(hashed, "short")
        .where(F.col("digest") == F.col("rule_digest"))
    )
    first = F.struct((-F.length("rule")).alias("n"), F.when(F.col("verdict") == "block", 0).otherwise(1).alias("v"), "rule", "verdict")
    best = met.groupBy("host", "path").agg(F.min(first).alias("best"))
    return rows.join(best, ["host", "path"], "left").select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(DEFAULT_VERDICT)).alias("verdict"))
