"""One sweep run, end to end: inbox -> status, quarantine -> silver (append) -> gold (changed datasets).

    python -m driftsweep --inbox <folder> --out <folder> [--run-id 2024-01-02_030405] [--archive <folder>]

writes ``<out>/status`` (one row per inbox entry and run: good / error + reason), puts the files
of unreadable entries into ``<out>/quarantine`` in chunks, adds the run to ``<out>/silver`` (partitioned by
run_id and file_name; rows of earlier runs stay, a repeated run_id replaces its own rows), says so in
``<out>/ledger``, and rebuilds the partitions of ``<out>/gold`` whose datasets have changed. An entry that a
finished run recorded with the same size and modification time is not swept again. With ``--archive``
handled entries then leave the inbox for ``<archive>/success/<run_id>`` or ``<archive>/error/<run_id>``.

Every step may be the last one of a run: see ``plans.ledger`` for what the next run does about it.
"""

from __future__ import annotations

import argparse
import datetime as dt
import uuid
from functools import cached_property

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from driftsweep.operators.joins import stored
from driftsweep.plans import ledger
from driftsweep.plans.medallion import Sweep
from driftsweep.session import prepare
from driftsweep.sinks import tables
from driftsweep.sources import csv_inbox, raw_files


def new_entries(spark: SparkSession, inbox: str, out: str, run_id: str) -> DataFrame:
    """Manifest rows of the inbox entries that no other run has handled in their present state."""
    seen = ledger.handled(spark, out).where(F.col("run_id") != run_id).select("entry", "bytes", "modified").distinct()
    man = csv_inbox.manifest(spark, inbox).where("type_rank IS NOT NULL")
    same = [man[c].eqNullSafe(seen[c]) for c in ("entry", "bytes", "modified")]
    return man.join(seen, same[0] & same[1] & same[2], "left_anti").transform(stored)


class Run:
    """The steps of one run, in the order in which they must be taken."""

    def __init__(self, spark: SparkSession, inbox: str, out: str, run_id: str | None = None) -> None:
        self.spark, self.inbox, self.out = spark, inbox, out.rstrip("/")
        self.run_id = run_id or dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d_%H%M%S")
        self.attempt = uuid.uuid4().hex
        self.entries = self.errors = self.rows = 0

    @cached_property
    def sweep(self) -> Sweep:
        return Sweep.from_inbox(self.spark, self.inbox, new_entries(self.spark, self.inbox, self.out, self.run_id))

    def _mine(self, df: DataFrame) -> DataFrame:
        return df.withColumns({"attempt": F.lit(self.attempt), "run_id": F.lit(self.run_id)})

    def record_status(self) -> None:
        """What the run is going to cover: entries and datasets."""
        seen = Observation("status")
        status = self.sweep.status.drop("headers").observe(
            seen, F.count(F.lit(1)).alias("entries"), F.count_if(F.col("status") == "error").alias("errors"))
        ledger.replace_run(self._mine(status), f"{self.out}/status")
        self.entries, self.errors = seen.get["entries"], seen.get["errors"]
        resolved = self.sweep.mapping.select("file_name", "source")
        datasets = self.sweep.accepted.join(resolved, ["file_name", "source"], "left_semi").select("file_name", "source", "n_rows")
        ledger.replace_run(self._mine(datasets), f"{self.out}/datasets")

    def status(self) -> DataFrame:
        """The run's status rows, as written."""
        return ledger.read(self.spark, f"{self.out}/status", ledger.STATUS).where(
            (F.col("run_id") == self.run_id) & (F.col("attempt") == self.attempt))

    def quarantine(self) -> None:
        """The files of unreadable entries, byte for byte, in chunks (entry, reason, path, offset, content)."""
        bad = self.status().where("status = 'error' AND n_parts > 0").select("entry", "reason")
        chunks = raw_files.chunks(self.spark, self.inbox, bad)
        (chunks.withColumn("run_id", F.lit(self.run_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("run_id").parquet(f"{self.out}/quarantine"))

    def append_silver(self) -> None:
        seen = Observation("silver")
        silver = self.sweep.silver.observe(seen, F.count(F.lit(1)).alias("rows"))
        tables.append_silver(silver, f"{self.out}/silver", run_id=self.run_id)
        self.rows = seen.get["rows"]

    def commit(self) -> None:
        """From here on the run's entries are handled and its rows are seen."""
        ledger.record(self.spark, self.out, self.run_id, self.attempt, "silver", self.entries, self.errors, self.rows)

    def rebuild_gold(self) -> int:
        """Gold of the datasets that this run, or an earlier one that did not come so far, has changed."""
        open_ = ledger.finished(self.spark, self.out, "silver").join(
            ledger.finished(self.spark, self.out, "gold"), ["run_id", "attempt"], "left_anti").collect()   # unfinished runs: a few
        written = tables.write_gold_of(self.spark, f"{self.out}/silver", f"{self.out}/gold",
                                       ledger.changed_datasets(self.spark, self.out), ledger.committed_runs(self.spark, self.out))
        for r in open_:
            ledger.record(self.spark, self.out, r.run_id, r.attempt, "gold", 0, 0, written)
        return written


def move_handled(spark: SparkSession, inbox: str, handled: DataFrame, archive: str) -> int:
    """Move every entry of ``handled`` (entry, bytes, modified, status, run_id) that is still in the inbox in that state to
    ``archive/<success|error>/<run_id>/<entry>``; the number of entries moved. Renames only, so the archive has to be on
    the inbox's file system and outside the inbox. An entry that has changed since stays for the next run."""
    root, target = csv_inbox.qualified(spark, inbox), csv_inbox.qualified(spark, archive)
    if (target + "/").startswith(root + "/"):
        raise ValueError("the archive must not lie inside the inbox")
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = lambda *names: jvm.org.apache.hadoop.fs.Path("/".join(names))
    fs = path(root).getFileSystem(conf)
    if path(target).getFileSystem(conf).getUri().toString() != fs.getUri().toString():
        raise ValueError("the archive must be on the inbox's file system")
    man = csv_inbox.manifest(spark, inbox)
    done = handled.groupBy("entry", "bytes", "modified").agg(F.max(F.struct("run_id", "status")).alias("last"))
    same = [man[c].eqNullSafe(done[c]) for c in ("entry", "bytes", "modified")]
    moved = 0
    # one metadata call an entry, streamed: the driver holds one partition's names at a time
    for r in man.join(done, same[0] & same[1] & same[2]).select(man["entry"], "last").toLocalIterator():
        folder = f"{target}/{'success' if r.last.status == 'good' else 'error'}/{r.last.run_id}"
        fs.mkdirs(path(folder))
        to = path(folder, r.entry)
        if fs.exists(to):    # the same name was delivered again under this run
            to = path(folder, f"{r.entry}.{uuid.uuid4().hex[:8]}")
        if not fs.rename(path(root, r.entry), to):
            raise OSError(f"could not move {r.entry} to {to.toString()}")
        moved += 1
    return moved


def run_sweep(spark: SparkSession, inbox: str, out: str, run_id: str | None = None, archive: str | None = None) -> dict[str, int]:
    """Sweep the new entries of ``inbox`` once; returns the run's entries and errors, and the rows of all runs.

    The counts are taken while the tables are written (gold has a row for each silver row)."""
    run = Run(spark, inbox, out, run_id)
    run.record_status()
    run.quarantine()
    run.append_silver()
    run.commit()
    run.rebuild_gold()
    if archive is not None:
        move_handled(spark, inbox, ledger.handled(spark, run.out), archive)
    rows = ledger.totals(spark, run.out)
    return {"entries": run.entries, "errors": run.errors, "silver_rows": rows, "gold_rows": rows}


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="driftsweep", description=__doc__.splitlines()[0])
    ap.add_argument("--inbox", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--run-id", default=None)
    ap.add_argument("--archive", default=None, help="folder that handled entries are moved to")
    args = ap.parse_args(argv)
    spark = prepare(SparkSession.builder.appName("driftsweep").getOrCreate())
    print(run_sweep(spark, args.inbox, args.out, args.run_id, args.archive))


if __name__ == "__main__":
    main()
