"""Dense 0-based row ids in a global order without a single-partition window.

Same idea as zipWithIndex, in DataFrame form:
  1. range-partition on the order key (a hot dataset is split across partitions),
     sort within partitions, tag each row with (partition id, monotonic id);
  2. write that to the shared scratch folder so the tags are fixed even if
     executors are lost and parts are recomputed;
  3. per-partition counts -> running offsets (one row per partition: a proven small table,
     safe to broadcast) -> rowid = offset + position inside the partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from driftsweep.operators.joins import join_checked, stored


def with_dense_index(df: DataFrame, order_cols: list[str], name: str = "rowid",
                     partitions: int | None = None) -> DataFrame:
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    tagged = stored(df.repartitionByRange(n, *order_cols)
                    .sortWithinPartitions(*order_cols)
                    .withColumn("_pid", F.spark_partition_id())
                    .withColumn("_mid", F.monotonically_increasing_id()))
    sizes = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)  # <= n rows
    offsets = sizes.withColumn("_off", F.coalesce(F.sum("_n").over(w), F.lit(0)))
    return (tagged.join(F.broadcast(offsets.select("_pid", "_off", "_first")), "_pid")
                  .withColumn(name, (F.col("_off") + F.col("_mid") - F.col("_first")).cast("long"))
                  .drop("_pid", "_mid", "_off", "_first"))


def running_totals(df: DataFrame, order_cols: list[str], totals: dict[str, str]) -> DataFrame:
    """Adds, for each (name, value column) of ``totals``, the value's sum over all earlier rows. The range-partitioned rows are
    stored with their partition's number: sums of the partitions (one small row each) plus a window
    inside each partition."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = stored(df.repartitionByRange(n, *order_cols).withColumn("_pid", F.spark_partition_id()))
    upto = Window.partitionBy("_pid").orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)  # <= n rows
    sizes = rows.groupBy("_pid").agg(*[F.sum(v).alias(f"_t_{k}") for k, v in totals.items()])
    sizes = sizes.select("_pid", *[F.coalesce(F.sum(f"_t_{k}").over(before), F.lit(0)).alias(f"_b_{k}") for k in totals])
    inside = rows.withColumns({k: F.coalesce(F.sum(v).over(upto), F.lit(0)) for k, v in totals.items()})
    return (inside.join(F.broadcast(sizes), "_pid").withColumns({k: F.col(k) + F.col(f"_b_{k}") for k in totals})
            .drop("_pid", *[f"_b_{k}" for k in totals]))


def with_dense_index_by_runs(df: DataFrame, order_cols: list[str], mid: str, name: str = "rowid") -> DataFrame:
    """Dense ids for rows whose ``order_cols`` runs (e.g. one file split each) hold consecutive ``mid``.

    The rows are written once to the shared folder first: run starts and ids are then read from the
    same stored values, however the scan that made them was packed into tasks. One small aggregate
    per run, a distributed running sum over the runs, a size-checked join. A run with gaps, or a
    row without a run, stops the query instead of losing or repeating ids.
    """
    staged = stored(df, sink="rowid")
    runs = staged.groupBy(*order_cols).agg(F.count(F.lit(1)).alias("_n"), F.min(mid).alias("_first"), F.max(mid).alias("_last"))
    gap = F.raise_error(F.lit("a run of rows has gaps; it cannot be numbered")).cast("long")
    runs = runs.withColumn("_n", F.when(F.col("_last") - F.col("_first") + 1 == F.col("_n"), F.col("_n")).otherwise(gap))
    offsets = running_totals(runs.drop("_last"), order_cols, {"_off": "_n"}).drop("_n")
    lost = F.raise_error(F.lit("a row belongs to no run")).cast("long")
    return (join_checked(staged, offsets, order_cols, "left", salt_from=[mid])
            .withColumn(name, F.coalesce(F.col("_off") + F.col(mid) - F.col("_first"), lost).cast("long"))
            .drop("_off", "_first"))
