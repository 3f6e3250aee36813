"""Registered queries: each applies one operator with production parameters to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import adaptive_quality, block_crf, group_join, histogram_packing, legacy_archive, lexical_rank, license_index, packing, residue_negatives, rp_forest, suffix_merge, url_rules, weighted_mix
from .shared import table


def op1_legacy_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return legacy_archive.archived(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_rp_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rp_forest.nearest(table(spark, sf_dir, "embeddings"))


def op3_group_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_join.linked(table(spark, sf_dir, "documents"))


def op4_block_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return block_crf.extracted(table(spark, sf_dir, "pages"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_index.scanned(table(spark, sf_dir, "documents"))


def op6_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judged(table(spark, sf_dir, "pages"), url_rules.rule_table(spark))


def op7_suffix_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_merge.deduplicated(table(spark, sf_dir, "documents"))


def op8_weighted_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weighted_mix.mix_of(table(spark, sf_dir, "documents"))


def byte_bpe() -> packing.Encoder:
    """The tokenizer of the packing query; the paths are those of the installed files."""
    import public_tokenizers

    return packing.Encoder(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), byte_bpe)


def op10_adaptive_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adaptive_quality.judged(table(spark, sf_dir, "documents"))


def op11_lexical_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_rank.ranked(table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents"))


def op12_residue_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return residue_negatives.hard_negatives(table(spark, sf_dir, "embeddings"), relabel=label)


def op13_histogram_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = histogram_packing.packed(table(spark, sf_dir, "documents"), byte_bpe)
    return pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


QUERIES = {f.__name__: f for f in (op1_legacy_archive, op2_rp_forest, op3_group_join, op4_block_crf, op5_license_scan, op6_url_rules, op7_suffix_merge, op8_weighted_mix, op9_packing, op10_adaptive_quality, op11_lexical_rank, op12_residue_negatives, op13_histogram_packing)}
