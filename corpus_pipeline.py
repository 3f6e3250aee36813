"""The corpus pipeline: quality rules, near duplicates, repeated passages, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents. Part of the
optional subpackage triagelake.llm.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from triagelake.llm import adaptive_quality, group_join, packing, suffix_merge, weighted_mix
from triagelake.llm.queries import byte_bpe
from triagelake.llm.shared import table, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or their group's fences go; the sketches alone set the fences."""
    return adaptive_quality.kept_documents(docs, by_sketch=True)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return group_join.representatives(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes of repeated passages are cut out of the texts."""
    return suffix_merge.cut_documents(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are brought to their target weights; documents come once for each time they are taken."""
    return weighted_mix.mixed_documents(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of a fixed width."""
    return packing.packed(docs, byte_bpe)


STAGES = [("quality_rules", quality_rules), ("near_duplicates", near_duplicates), ("repeated_passages", repeated_passages), ("mixing", mixing), ("packing", packing_stage)]

#: Suffix sorting and tokenizing aren't SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
