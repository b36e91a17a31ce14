"""Corpus pipeline: language ID, SimHash near-dedup, decontamination, source mix, shards.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read
again as the next stage's docs. All but the last return the columns of documents; the last returns
the shard manifest of every row that its predecessor kept. An empty table passes through all stages.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from driftsweep.llm import decontaminate, language_id, mixing, sharding, simhash
from driftsweep.llm.common import ready, table
from driftsweep.session import scratch_path


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the language classifier does not reject."""
    return language_id.accepted(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group (3-word shingles, 3 bits)."""
    return simhash.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed(docs)


def place_in_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every row of the mix."""
    return sharding.assign(docs)


STAGES = [("language_id", identify_language), ("simhash_near_dedup", drop_near_copies),
          ("decontamination", drop_contaminated), ("source_mix", mix_sources), ("sharding", place_in_shards)]

#: Rows of run() as DuckDB SQL: none, as SQL expresses neither the classifier nor MinHash and the ring.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each written to the shared folder and read again."""
    docs = table(ready(spark), sf_dir, "documents")
    base = scratch_path(spark, f"pipeline-{uuid.uuid4().hex[:8]}")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
    return docs
