"""The training-data operators' queries, op1 to op13 and the pipeline, over the tables of a folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from driftsweep.llm import (
    codes,
    decontaminate,
    divergence,
    language_id,
    licenses,
    mixing,
    pii,
    repeats,
    sharding,
    simhash,
    substrings,
    token_counts,
    topk,
)
from driftsweep.llm.common import table


def op1_bounded_ring_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents"))


def op2_edit_aware_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_edited(table(spark, sf_dir, "documents"))


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op5_license_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op6_boosted_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


def op7_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_plan(table(spark, sf_dir, "documents"))


def op8_prefix_free_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op10_threshold_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op11_dual_tree_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.compress(table(spark, sf_dir, "embeddings"))


def op12_fm_index_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeated(table(spark, sf_dir, "documents"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = (op1_bounded_ring_shards, op2_edit_aware_token_counts, op3_benchmark_decontamination, op4_simhash_near_dedup,
             op5_license_notices, op6_boosted_pii, op7_source_mix, op8_prefix_free_repeats, op9_language_id,
             op10_threshold_top_k, op11_dual_tree_codes, op12_fm_index_repeats,
             op13_source_divergence, pipeline)
    return {f.__name__: f for f in every}


def sql() -> dict[str, str]:
    """DuckDB SQL for the queries that SQL can express."""
    out = {"op3_benchmark_decontamination": decontaminate.SQL, "op5_license_notices": licenses.sql(), "op7_source_mix": mixing.SQL, "op10_threshold_top_k": topk.SQL,
           "op11_dual_tree_codes": codes.sql(), "op12_fm_index_repeats": substrings.SQL,
           "op13_source_divergence": divergence.SQL}
    if corpus_pipeline.ORACLE_SQL:
        out["pipeline"] = corpus_pipeline.ORACLE_SQL
    return out
