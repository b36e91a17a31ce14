"""Helpers shared by the training-data operators: Arrow text buffers, checkpoints, connected components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftsweep.session import prepare

#: Text bytes that one numpy step works on; a longer single text is a step of its own.
SLICE_BYTES = 2 << 20
#: Bounds of one Arrow batch handed to a Python worker.
BATCH_ROWS, BATCH_BYTES = 2000, 16 << 20


def ready(spark: SparkSession) -> SparkSession:
    """Shared checkpoint folder, package on the executors, Arrow batches of bounded size."""
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    return df.checkpoint(eager=True)


def buffers(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string array and its row offsets (nulls are empty), without copying rows."""
    arr = arr.cast(pa.large_binary())
    if arr.null_count:
        arr = arr.fill_null(b"")
    _, off, data = arr.buffers()
    offsets = np.frombuffer(off, np.int64)[arr.offset:arr.offset + len(arr) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], col: str = "text",
           limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Whole rows in steps of at most ``limit`` text bytes (a longer text makes its own step)."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        data, offsets = buffers(batch.column(batch.schema.get_field_index(col)))
        start = 0
        while start < batch.num_rows:
            stop = int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1
            stop = max(start + 1, min(stop, batch.num_rows))
            yield (batch.slice(start, stop - start), data[offsets[start]:offsets[stop]],
                   offsets[start:stop + 1] - offsets[start])
            start = stop


def components(edges: DataFrame) -> DataFrame:
    """Connected components of (a long, b long): rows (node, root), one for each node with an edge.

    Contraction: every node points to the neighbour (or itself) that comes first in a fixed hash
    order, edges are rewritten to those, and the rounds end when no edge joins two nodes. All
    steps are grouped minima (combined before the shuffle) and equi-joins; hub nodes are split by
    adaptive skew joins. Each round is cut by a checkpoint. No edges: no rows.
    """
    e = cut(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    labels = None
    while e.take(1):
        both = e.union(e.select("b", "a"))
        rank = lambda c: F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("v"))
        best = both.groupBy("a").agg(F.min(rank("b")).alias("m"))
        rep = cut(best.select(F.col("a").alias("old"), F.least(rank("a"), F.col("m"))["v"].alias("new")))
        labels = cut(rep.select(F.col("old").alias("node"), F.col("new").alias("root")) if labels is None else
                     labels.join(rep, labels["root"] == rep["old"], "left")
                     .select("node", F.coalesce("new", "root").alias("root")))
        e = (e.join(rep.select(F.col("old").alias("a"), F.col("new").alias("x")), "a")
             .join(rep.select(F.col("old").alias("b"), F.col("new").alias("y")), "b")
             .filter("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
        e = cut(e)
    if labels is None:
        return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return labels


def ranked(rows: DataFrame, *order: Column) -> DataFrame:
    """Rows with ``rank`` (0, 1, ...) in the given order, without a window over all rows.

    The sorted rows are checkpointed, so each keeps its partition; ranks are the row's place in its
    partition plus the counts of the partitions before it (as many numbers as partitions).
    """
    from pyspark.sql import Window

    s = cut(rows.orderBy(*order)).withColumn("__at", F.monotonically_increasing_id())
    part = F.shiftright("__at", 33)
    sizes = s.groupBy(part.alias("__part")).agg(F.count("*").alias("__n"))
    before = sizes.select("__part", (F.sum("__n").over(Window.orderBy("__part")) - F.col("__n")).alias("__before"))
    return (s.withColumn("__part", part).join(F.broadcast(before), "__part")
            .withColumn("rank", F.col("__before") + F.col("__at") - F.shiftleft("__part", 33))
            .drop("__at", "__part", "__before"))
