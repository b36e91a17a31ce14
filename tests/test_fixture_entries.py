"""Fixture entries: few part files, whatever the number of shuffle partitions."""

import os

from pyspark.sql import functions as F

from driftsweep.sources import csv_inbox


def test_fixture_entries_have_a_part_file_a_core_at_most(spark, tmp_path):
    n, cores = 400, spark.sparkContext.defaultParallelism
    sf = str(tmp_path)
    i = spark.range(n)
    i.select(F.col("id").alias("c_custkey"), F.concat(F.lit("c"), "id").alias("c_name"), (F.col("id") % 2).alias("c_nationkey"),
             F.lit("s").alias("c_mktsegment")).write.parquet(f"{sf}/customer.parquet")
    i.select(F.col("id").alias("p_partkey"), F.lit("a b").alias("p_name")).write.parquet(f"{sf}/part.parquet")
    spark.range(2).select(F.col("id").alias("n_nationkey"), F.lit("N").alias("n_name")).write.parquet(f"{sf}/nation.parquet")
    ts = F.lit("2021-01-01 00:00:00").cast("timestamp")
    i.select(F.col("id").alias("user_id"), F.lit("view").alias("event_type"), ts.alias("ts")).write.parquet(f"{sf}/events.parquet")
    i.select(F.col("id").alias("o_custkey"), ts.alias("o_orderdate")).write.parquet(f"{sf}/orders.parquet")
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    for k, v in zip(before, (str(3 * cores), "false", "-1")):
        spark.conf.set(k, v)
    try:
        inbox = csv_inbox.write_fixture_inbox(spark, sf, f"{sf}/inbox")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    for entry in ("canon.csv", "spaced.csv", "upper_S1.csv", "combined.csv"):
        files = [f for f in os.listdir(f"{inbox}/{entry}") if f.startswith("part-")]
        assert 1 <= len(files) <= cores
        assert spark.read.option("header", "true").csv(f"{inbox}/{entry}").count() == n // 4
