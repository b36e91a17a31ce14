"""Ledger of sweep runs: what a run has finished, written after the work it speaks of.

``<out>/ledger`` holds one row for each finished phase of an attempt: ``silver`` (all its silver rows are written; from now
on its entries are handled and its rows are seen) and ``gold`` (the datasets it changed are rebuilt). A run
that stops before its ``silver`` record leaves status rows and perhaps silver files behind, but no entry
counts as handled and no reader sees its rows, so the next run takes its entries up again. A run that stops
before its ``gold`` record leaves datasets behind that the next run rebuilds.

``<out>/status`` and ``<out>/datasets`` say for each attempt which entries and datasets it covers; both are partitioned by
run_id, and a repeated run_id replaces its own rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LEDGER = "run_id string, attempt string, phase string, at timestamp, entries long, errors long, rows long"
STATUS = ("entry string, file_ordinal int, n_parts bigint, bytes bigint, modified timestamp, status string, reason string, "
          "n_rows bigint, attempt string, run_id string")
DATASETS = "file_name string, source string, n_rows bigint, attempt string, run_id string"


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table of the sweep (no rows before it is first written)."""
    return spark.read.schema(schema).parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)


def record(spark: SparkSession, out: str, run_id: str, attempt: str, phase: str, entries: int, errors: int, rows: int) -> None:
    """Add one row (one file, so it is there as a whole or not at all)."""
    row = spark.createDataFrame([(run_id, attempt, phase, None, entries, errors, rows)], LEDGER)
    row.withColumn("at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(f"{out}/ledger")


def replace_run(df: DataFrame, path: str) -> None:
    """Write a run's rows, in place of rows that the same run_id wrote earlier."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(path))


def finished(spark: SparkSession, out: str, phase: str) -> DataFrame:
    """(run_id, attempt) of the attempts that have finished a phase."""
    return read(spark, f"{out}/ledger", LEDGER).where(F.col("phase") == phase).select("run_id", "attempt").distinct()


def committed_runs(spark: SparkSession, out: str) -> DataFrame:
    """run_id of the runs whose silver rows count."""
    return finished(spark, out, "silver").select("run_id").distinct()


def handled(spark: SparkSession, out: str) -> DataFrame:
    """Status rows of the entries that some run has handled, in the state in which it read them."""
    return read(spark, f"{out}/status", STATUS).join(finished(spark, out, "silver"), ["run_id", "attempt"], "left_semi")


def changed_datasets(spark: SparkSession, out: str) -> DataFrame:
    """Datasets (file_name) of attempts with silver rows whose gold is not rebuilt yet."""
    open_ = finished(spark, out, "silver").join(finished(spark, out, "gold"), ["run_id", "attempt"], "left_anti")
    return (read(spark, f"{out}/datasets", DATASETS).join(open_, ["run_id", "attempt"], "left_semi")
            .select("file_name").distinct())


def totals(spark: SparkSession, out: str) -> int:
    """Silver rows of all runs: the last attempt's count of each run_id."""
    last = (read(spark, f"{out}/ledger", LEDGER).where("phase = 'silver'").groupBy("run_id")
            .agg(F.max_by("rows", "at").alias("rows")))
    return last.agg(F.sum("rows")).first()[0] or 0
