"""Silver and gold sinks (parquet; the format is a parameter).

* silver: fixed 35-column schema, rowid and file_name NOT NULL, partitioned by file_name,
  appended per run; with a ``run_id`` partitioned by (run_id, file_name), where writing the
  same run again replaces that run only and earlier deliveries stay: (run_id, rowid) is unique;
* gold: rebuilt from all of silver and overwritten, written compact (rebalance hint), or partitioned by
  sourcefile with only the changed datasets rebuilt (``write_gold_of``);
* ``compact`` rewrites the partitions that hold more files than they need;
* reads prune partitions: ``read_silver(..., dataset=...)`` shows PartitionFilters.

Silver is written scan-aligned by default: each task writes the rows it read (one file per
dataset it touched), so there is no shuffle before the write and a hot dataset stays
spread over many tasks. ``rebalance=True`` adds ``REBALANCE(file_name)`` (never
``repartition(file_name)``, which would funnel a hot dataset through one task) when fewer,
larger files are worth a full shuffle. Gold keeps the rebalance: compaction is the
original's own step after every rebuild.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftsweep.operators.harmonise import gold
from driftsweep.operators.joins import join_checked, stored
from driftsweep.schema import GOLD_SCHEMA, SILVER_ORDER, SILVER_SCHEMA

NOT_NULL = [f.name for f in SILVER_SCHEMA.fields if not f.nullable]


def _ddl_columns() -> str:
    return ",\n  ".join(f"{f.name} {f.dataType.simpleString().upper()}{'' if f.nullable else ' NOT NULL'}"
                        for f in SILVER_SCHEMA.fields)


def silver_ddl(table: str, location: str | None = None, fmt: str = "parquet") -> str:
    loc = f"\nLOCATION '{location}'" if location else ""
    return (f"CREATE TABLE IF NOT EXISTS {table} (\n  {_ddl_columns()})\n"
            f"USING {fmt}\nPARTITIONED BY (file_name){loc}")


def create_silver_table(spark: SparkSession, table: str, location: str | None = None, fmt: str = "parquet") -> None:
    """K1: create the silver table if absent."""
    spark.sql(silver_ddl(table, location, fmt))


def drop_table(spark: SparkSession, table: str) -> None:
    """K2: drop a table if present."""
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def typed_silver(df: DataFrame) -> DataFrame:
    """K3: the declared 35-column schema; a NULL in a NOT NULL column fails the write task
    inline (no extra pass over the data)."""
    cols = []
    for f in SILVER_SCHEMA.fields:
        c = F.col(f.name).cast(f.dataType)
        if not f.nullable:
            c = F.coalesce(c, F.raise_error(F.lit(f"NOT NULL constraint violated: {f.name}")).cast(f.dataType))
        cols.append(c.alias(f.name))
    return df.select(*cols)


def append_silver(df: DataFrame, path: str | None = None, table: str | None = None,
                  run_id: str | None = None, fmt: str = "parquet", rebalance: bool = False) -> None:
    """K4: append silver, partitioned by file_name; under ``run_id`` (path only) by (run_id, file_name)."""
    out = typed_silver(df)
    if rebalance:
        out = out.hint("rebalance", "file_name")
    if table is not None:
        # by position: the table's data columns, then its partition column (file_name last)
        out.write.format(fmt).insertInto(table)
    elif run_id is None:
        out.write.format(fmt).partitionBy("file_name").mode("append").save(path)
    else:
        (out.withColumn("run_id", F.lit(run_id)).write.format(fmt).partitionBy("run_id", "file_name")
         .mode("overwrite").option("partitionOverwriteMode", "dynamic").save(path))


def run_schema() -> T.StructType:
    """Schema of a silver table that is written per run."""
    return T.StructType([*SILVER_SCHEMA.fields, T.StructField("run_id", T.StringType())])


def read_silver(spark: SparkSession, path: str, dataset: str | None = None, fmt: str = "parquet",
                with_run: bool = False, runs: DataFrame | None = None) -> DataFrame:
    """K7: read silver back in its declared order; a dataset filter prunes partitions.

    ``with_run`` adds the run_id of a silver table written per run; ``runs`` (column run_id) keeps the rows of these
    runs only, such as ``ledger.committed_runs``.
    """
    by_run = with_run or runs is not None
    schema = run_schema() if by_run else SILVER_SCHEMA
    df = spark.read.format(fmt).schema(schema).load(path)
    if dataset is not None:
        df = df.where(F.col("file_name") == dataset)
    if runs is not None:
        df = join_checked(df, runs.select("run_id"), ["run_id"], "left_semi", salt_from=["rowid"])
    return df.select(*SILVER_ORDER, *(["run_id"] if with_run else []))


def write_gold(rows: DataFrame, path: str, fmt: str = "parquet") -> None:
    """K5 + K6: overwrite gold from silver, written compact (AQE-sized rebalanced files)."""
    rows.select(*[F.col(f.name).cast(f.dataType) for f in GOLD_SCHEMA.fields]) \
        .hint("rebalance").write.format(fmt).mode("overwrite").save(path)


def write_gold_of(spark: SparkSession, silver_path: str, gold_path: str, datasets: DataFrame, runs: DataFrame) -> int:
    """K5 for some datasets (column file_name): their partitions of a gold table partitioned by sourcefile are rebuilt
    from the silver rows of ``runs``, all other partitions and their files stay. Returns the rows written."""
    datasets = stored(datasets.select("file_name").distinct())
    if datasets.isEmpty():
        return 0
    silver = join_checked(read_silver(spark, silver_path, runs=runs), datasets, ["file_name"], "left_semi", at_rest=True, salt_from=["rowid"])
    seen = Observation("gold")
    rows = gold(silver).select(*[F.col(f.name).cast(f.dataType) for f in GOLD_SCHEMA.fields])
    (rows.observe(seen, F.count(F.lit(1)).alias("rows")).hint("rebalance", "sourcefile").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("sourcefile").parquet(gold_path))
    return seen.get["rows"]


def file_sizes(spark: SparkSession, path: str) -> DataFrame:
    """(folder, file, bytes) of a table's files, from the listing (no content is read)."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path)
             .select(F.col("_metadata.file_path").alias("file"), F.col("length").alias("bytes")))
    return files.select(F.regexp_extract("file", "(?s)^(.*)/[^/]*$", 1).alias("folder"), "file", "bytes")


def compact(spark: SparkSession, path: str, schema: T.StructType, partition_by: list[str],
            target_bytes: int = 128 << 20) -> DataFrame:
    """K6 for a partitioned table: partitions with more files than their bytes need are rewritten in bins of about
    ``target_bytes``; other partitions are left alone. Returns what was rewritten: (folder, files, bytes, bins).

    The partitions to rewrite are chosen from file sizes. Their rows are dealt to bins by a hash of the row, so a large
    partition is written by as many tasks as it has bins; they replace the old files when the job commits."""
    sizes = file_sizes(spark, path).groupBy("folder").agg(F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"))
    bins = F.greatest(F.lit(1), F.ceil(F.col("bytes") / target_bytes)).cast("int")
    chosen = stored(sizes.withColumn("bins", bins).where("files > bins"))
    if chosen.isEmpty():
        return chosen
    table = spark.read.schema(schema).parquet(path)   # the schema keeps partition values as written
    names = table.columns
    rows = table.withColumn("folder", F.regexp_extract(F.col("_metadata.file_path"), "(?s)^(.*)/[^/]*$", 1))
    rows = join_checked(rows, chosen.select("folder", "bins"), ["folder"], at_rest=True, salt_from=names[:4])
    rows = rows.withColumn("_bin", F.pmod(F.xxhash64(*names), F.col("bins")))
    (rows.repartition(F.col("folder"), F.col("_bin")).select(*names).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path))
    return chosen


def read_gold(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).schema(GOLD_SCHEMA).load(path)
