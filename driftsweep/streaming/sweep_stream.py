"""T1/T2: incremental inbox sweep with Structured Streaming.

The stream is only a signal of which *entries* changed: the file source's checkpoint records the
files it has seen, and a micro-batch's distinct entry names start a batch sweep of those entries as
a whole, every file they hold by then. However a micro-batch cuts an entry's files, the last one
that touches it sweeps all of it, so gates, counts, mapping and row order are those of the batch
plan. An entry whose files are those that an earlier micro-batch has swept (``swept`` tells their number, size and
modification time) is not swept again, so an entry of many files is not swept once for each few of them. Workbooks and
CSV entries are swept alike. The names travel as a table, none on the driver.

With ``archive`` the entries of a micro-batch leave the inbox once all its tables are written (renames, see
``plans.run.archive_handled``), so a later run lists only what is new. A micro-batch that is replayed after that,
or that announces further files of an entry that has left, finds no entry and changes nothing.

Sinks under ``out_dir``: ``silver`` (the 33 targets, rowid and epoch; partitioned by dataset),
``gold`` (partitioned by dataset) and ``status`` (partitioned by epoch). A sweep replaces the
partitions of its datasets, so a replayed micro-batch changes nothing, and (epoch, rowid) is unique.
If two entries name the same dataset, the one later in discovery order wins, also across
micro-batches: ``owners`` records which entry each dataset's rows come from. ``owners`` and ``swept`` hold the changes of
each epoch and a snapshot every ``SNAPSHOT`` epochs, so that a micro-batch reads a bounded number of their partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftsweep.operators import harmonise
from driftsweep.operators.joins import stored
from driftsweep.plans import ledger
from driftsweep.plans.medallion import Sweep
from driftsweep.plans.run import move_handled
from driftsweep.schema import GOLD_ORDER, SILVER_ORDER
from driftsweep.sources import csv_inbox

OWNERS = "file_name string, type_rank int, owner string, epoch long"
STATUS = "entry string, file_ordinal int, n_parts bigint, bytes bigint, modified timestamp, status string, reason string, n_rows bigint"
SWEPT = "entry string, n_parts bigint, bytes bigint, modified timestamp, epoch long"
#: Epochs between two snapshots of ``owners`` and ``swept``.
SNAPSHOT = 10


def start_sweep_stream(spark: SparkSession, inbox: str, out_dir: str, checkpoint: str,
                       max_files_per_trigger: int | None = None, available_now: bool = True, archive: str | None = None):
    """Start the incremental sweep; returns the StreamingQuery.

    ``max_files_per_trigger`` only sets how many files may announce themselves in one micro-batch.
    """
    reader = spark.readStream.format("binaryFile").schema(
        "path string, modificationTime timestamp, length long, content binary").option("recursiveFileLookup", "true").option(
        "ignoreMissingFiles", "true")   # files of an entry that an earlier micro-batch has swept and archived
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    root = csv_inbox.qualified(spark, inbox)
    # only the path is selected: no file content is read here
    stream = reader.load(inbox).select(csv_inbox.entry_of(F.col("path"), root).alias("entry"))

    def process(batch: DataFrame, epoch: int) -> None:
        # an archived entry has left the inbox; one that is there again is a new delivery
        entries = batch.distinct() if archive is not None else changed(spark, inbox, out_dir, batch.distinct(), epoch)
        if not entries.isEmpty():
            sweep_entries(spark, inbox, out_dir, stored(entries), epoch, archive)
        elif epoch % SNAPSHOT == 0:
            _write(_at(_owners(spark, out_dir, epoch), epoch), f"{out_dir}/owners", "epoch")
            _write(_at(_swept(spark, out_dir, epoch), epoch), f"{out_dir}/swept", "epoch")

    writer = stream.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()


def _latest(spark: SparkSession, path: str, schema: str, key: str, values: list[str], epoch: int) -> DataFrame:
    """The latest row of each key before this micro-batch."""
    since = (epoch - 1) // SNAPSHOT * SNAPSHOT    # the last snapshot before the epoch
    rows = ledger.read(spark, path, schema).where((F.col("epoch") >= since) & (F.col("epoch") < epoch))
    return rows.groupBy(key).agg(F.max(F.struct("epoch", *values)).alias("o")).select(key, *[f"o.{v}" for v in values])


def _owners(spark: SparkSession, out_dir: str, epoch: int) -> DataFrame:
    """The latest owner of each dataset before this micro-batch."""
    return _latest(spark, f"{out_dir}/owners", OWNERS, "file_name", ["type_rank", "owner"], epoch)


def _swept(spark: SparkSession, out_dir: str, epoch: int) -> DataFrame:
    """The files that each entry had when it was last swept before this micro-batch."""
    return _latest(spark, f"{out_dir}/swept", SWEPT, "entry", ["n_parts", "bytes", "modified"], epoch)


def _at(df: DataFrame, epoch: int) -> DataFrame:
    return df.withColumn("epoch", F.lit(epoch).cast("long"))


def changed(spark: SparkSession, inbox: str, out_dir: str, entries: DataFrame, epoch: int) -> DataFrame:
    """The entries without those that an earlier micro-batch has swept with all the files they have now."""
    now = entries.join(csv_inbox.file_states(spark, inbox), "entry", "left")
    seen = _swept(spark, out_dir, epoch)
    return now.join(seen, ["entry", "n_parts", "bytes", "modified"], "left_anti").select("entry")


def sweep_entries(spark: SparkSession, inbox: str, out_dir: str, entries: DataFrame, epoch: int,
                  archive: str | None = None) -> None:
    """Sweep whole entries (column ``entry``) and replace their datasets, unless a later entry owns the dataset."""
    sw = Sweep.from_inbox(spark, inbox, entries)
    rank = sw.manifest.select(F.col("entry").alias("owner"), "type_rank")
    own = (sw.datasets.select("file_name", F.split_part("source", F.lit("!"), F.lit(1)).alias("owner"))
           .join(rank, "owner").select("file_name", "type_rank", "owner"))
    before = _owners(spark, out_dir, epoch)
    old = before.select("file_name", F.struct("type_rank", "owner").alias("_old"))
    own = own.join(old, "file_name", "left").where(
        F.col("_old").isNull() | (F.col("_old") <= F.struct("type_rank", "owner"))).drop("_old").transform(stored)
    kept = own if epoch % SNAPSHOT else own.unionByName(before.join(own, "file_name", "left_anti"))
    _write(_at(kept, epoch), f"{out_dir}/owners", "epoch")
    mine = own.select("file_name")
    silver = sw.silver.join(mine, "file_name", "left_semi").select(
        F.lit(epoch).cast("long").alias("epoch"), *SILVER_ORDER)
    _write(silver, f"{out_dir}/silver", "file_name")
    gold = harmonise.gold(_silver(spark, out_dir).where(F.col("epoch") == epoch))
    _write(gold, f"{out_dir}/gold", "sourcefile")
    status = sw.status.select(*[f.split()[0] for f in STATUS.split(", ")])
    _write(_at(status, epoch), f"{out_dir}/status", "epoch")
    # written last: from now on the entries count as swept. The state is that of the manifest, which precedes every read
    swept = sw.manifest.select("entry", "n_parts", "bytes", "modified")
    if epoch % SNAPSHOT == 0:
        swept = swept.unionByName(_swept(spark, out_dir, epoch).join(entries, "entry", "left_anti"))
    _write(_at(swept, epoch), f"{out_dir}/swept", "epoch")
    if archive is not None:
        handled = ledger.read(spark, f"{out_dir}/status", STATUS + ", epoch long").where(F.col("epoch") == epoch)
        move_handled(spark, inbox, handled.withColumn("run_id", F.concat(F.lit("epoch-"), F.col("epoch"))), archive)


def _silver(spark: SparkSession, out_dir: str) -> DataFrame:
    fields = [T.StructField("epoch", T.LongType()), T.StructField("rowid", T.LongType()),
              *[T.StructField(c, T.StringType()) for c in SILVER_ORDER[1:]]]
    return spark.read.schema(T.StructType(fields)).parquet(f"{out_dir}/silver")


def _write(df: DataFrame, path: str, by: str) -> None:
    """Replace the partitions of ``by`` that the rows belong to."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def run_available(spark: SparkSession, inbox: str, out_dir: str, checkpoint: str,
                  max_files_per_trigger: int | None = None, archive: str | None = None) -> None:
    """Process everything currently in the inbox, then stop."""
    q = start_sweep_stream(spark, inbox, out_dir, checkpoint, max_files_per_trigger, archive=archive)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def read_stream_silver(spark: SparkSession, out_dir: str) -> DataFrame:
    """Silver columns and the epoch that wrote them."""
    return _silver(spark, out_dir)


def read_stream_gold(spark: SparkSession, out_dir: str) -> DataFrame:
    schema = T.StructType([T.StructField(c, T.StringType()) for c in GOLD_ORDER])
    return spark.read.schema(schema).parquet(f"{out_dir}/gold").select(*GOLD_ORDER)
