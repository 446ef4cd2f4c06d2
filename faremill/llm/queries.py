"""Registered queries of the operators, and their SQL where DuckDB can state them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from faremill.llm import decontaminate, html_extract, jaccard_join, katz, licences, merkle, nearest, packing, quality_rules, resampling, sharding, spelling, toxicity
from faremill.llm.common import read

Query = Callable[[SparkSession, str], DataFrame]


def _sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(read(spark, sf_dir, "documents"))


def _extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(read(spark, sf_dir, "pages"))


def _packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"))


def _jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join_documents(read(spark, sf_dir, "documents"))


def _decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def _resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def _licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(read(spark, sf_dir, "documents"))


def _katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.score(read(spark, sf_dir, "documents"))


def _quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.rule_report(read(spark, sf_dir, "documents"))


def _toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def _manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(read(spark, sf_dir, "documents"))


def _variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(read(spark, sf_dir, "documents"))


def _nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.nearest(read(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Query] = {
    "op1_host_paths": _extraction,
    "op2_gumbel_resampling": _resampling,
    "op3_katz_backoff": _katz,
    "op4_cutting_stock": _packing,
    "op5_simhash_windows": _decontamination,
    "op6_universe_partition": _jaccard,
    "op7_rule_cascade": _quality,
    "op8_licence_dice": _licences,
    "op9_boosted_toxicity": _toxicity,
    "op10_virtual_slots": _sharding,
    "op11_int8_tiles": _nearest,
    "op12_prefix_suffix_tiles": _variants,
    "op13_path_copying": _manifest,
}

ORACLE: dict[str, str] = {
    "op8_licence_dice": licences.scan_sql(),
    "op11_int8_tiles": nearest.nearest_sql(),
    "op12_prefix_suffix_tiles": spelling.variants_sql(),
    "op13_path_copying": merkle.manifest_sql(),
}
