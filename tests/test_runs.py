"""Runs end to end: the ledger, quarantine in chunks, archive, gold of changed datasets, compaction."""

import os

import pytest
from pyspark.sql import functions as F

from driftsweep.operators import harmonise
from driftsweep.plans import ledger
from driftsweep.plans.run import Run, run_sweep
from driftsweep.sinks import tables
from driftsweep.sources import raw_files


def put(folder, **files):
    folder.mkdir(exist_ok=True)
    for name, data in files.items():
        path = folder / (name + ".csv")
        path.write_bytes(data if isinstance(data, bytes) else data.encode())


def people(n, tag="N", start=0):
    return "FirstName,CID\n" + "".join(f"{tag}{i},C{i}\n" for i in range(start, start + n))


def silver(spark, out):
    return tables.read_silver(spark, f"{out}/silver", runs=ledger.committed_runs(spark, out))


STEPS = ["record_status", "quarantine", "append_silver", "commit", "rebuild_gold"]


def test_runs_that_stop_after_any_step_lose_and_repeat_nothing(spark, tmp_path, monkeypatch):
    inbox, out = tmp_path / "inbox", str(tmp_path / "out")
    put(inbox, a=people(3), bad='FirstName,CID\nx,"y\n')
    for n, stop in enumerate(STEPS):      # run r0 takes the first step only, r1 the first two, ...
        run = Run(spark, str(inbox), out, f"r{n}")
        for step in STEPS[:n + 1]:
            if step == "rebuild_gold":    # gold is written, but not recorded
                monkeypatch.setattr(ledger, "record", lambda *a: None)
            getattr(run, step)()
        monkeypatch.undo()
        if stop == "commit":              # all entries so far are handled; gold is not
            assert (run.entries, run.errors, run.rows) == (2, 1, 3)
            put(inbox, b=people(4, "M"))
    assert (run.entries, run.rows) == (1, 4)
    put(inbox, c=people(2, "K"))
    got = run_sweep(spark, str(inbox), out, "r9")
    assert got == {"entries": 1, "errors": 0, "silver_rows": 9, "gold_rows": 9}
    rows = silver(spark, out).collect()
    assert sorted((r.file_name, r.cid) for r in rows) == sorted(
        [("a", f"C{i}") for i in range(3)] + [("b", f"C{i}") for i in range(4)] + [("c", f"C{i}") for i in range(2)])
    gold = tables.read_gold(spark, f"{out}/gold")
    want = harmonise.gold(silver(spark, out))
    assert gold.count() == 9 and gold.exceptAll(want).isEmpty() and want.exceptAll(gold).isEmpty()


def test_only_changed_datasets_are_rebuilt(spark, tmp_path):
    inbox, out = tmp_path / "inbox", str(tmp_path / "out")
    put(inbox, a=people(3), b=people(4, "M"))
    run_sweep(spark, str(inbox), out, "r1")

    def files():
        return {os.path.relpath(os.path.join(d, f), f"{out}/gold") for d, _, fs in os.walk(f"{out}/gold") for f in fs if f.endswith(".parquet")}
    before = files()
    put(inbox, b=people(2, "Z", 10))
    run_sweep(spark, str(inbox), out, "r2")
    after = files()
    assert {f for f in before if f.startswith("sourcefile=a")} == {f for f in after if f.startswith("sourcefile=a")} != set()
    assert not {f for f in before if f.startswith("sourcefile=b")} & after
    gold, want = tables.read_gold(spark, f"{out}/gold"), harmonise.gold(silver(spark, out))
    assert gold.count() == 9 and gold.exceptAll(want).isEmpty() and want.exceptAll(gold).isEmpty()


def test_quarantine_holds_bad_files_beside_files_that_are_too_large(spark, tmp_path):
    inbox, out = tmp_path / "inbox", str(tmp_path / "out")
    odd = b'FirstName,CID\r\nAnn,"C1\r\n\xff\xfe\x00\n\n' + b"x" * 5000 + b"\nlast, no line end"
    put(inbox, good=people(400), odd=odd, over="FirstName,CID\nCy,C3,x\n")
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes",)}
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", "1000")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        got = run_sweep(spark, str(inbox), out, "r1")
        entries = spark.createDataFrame([("odd.csv", "why"), ("good.csv", None)], "entry string, reason string")
        small = raw_files.chunks(spark, str(inbox), entries, chunk_bytes=100).collect()
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")
        spark.conf.set("spark.sql.files.maxPartitionBytes", old["spark.sql.files.maxPartitionBytes"])
    assert got == {"entries": 3, "errors": 2, "silver_rows": 400, "gold_rows": 400}
    held = spark.read.parquet(f"{out}/quarantine").collect()
    whole = lambda rows, e: b"".join(bytes(r.content) for r in sorted(rows, key=lambda r: r.offset) if r.entry == e)
    assert whole(held, "odd.csv") == odd and whole(held, "over.csv") == b"FirstName,CID\nCy,C3,x\n"
    assert {r.entry for r in held} == {"odd.csv", "over.csv"}
    assert whole(small, "odd.csv") == odd and whole(small, "good.csv") == people(400).encode()
    for e in ("odd.csv", "good.csv"):
        at = 0
        for r in sorted((r for r in small if r.entry == e), key=lambda r: r.offset):
            assert r.offset == at
            at += len(r.content)
    assert len([r for r in small if r.entry == "good.csv"]) > 20


def test_archived_entries_leave_the_inbox(spark, tmp_path):
    inbox, out, archive = tmp_path / "inbox", str(tmp_path / "out"), tmp_path / "archive"
    put(inbox, a=people(3), bad="FirstName,CID\nCy,C3,x\n", empty="")
    (inbox / "notes.txt").write_text("not an entry")
    (inbox / "parts.csv").mkdir()
    (inbox / "parts.csv" / "part-0.csv").write_text(people(2))
    (inbox / "parts.csv" / "part-1.csv").write_text(people(2, "M"))
    run_sweep(spark, str(inbox), out, "r1", str(archive))
    assert sorted(os.listdir(inbox)) == ["notes.txt"]
    assert sorted(os.listdir(archive / "success" / "r1")) == ["a.csv", "parts.csv"]
    assert sorted(os.listdir(archive / "error" / "r1")) == ["bad.csv", "empty.csv"]
    put(inbox, a=people(2, "Z"))
    got = run_sweep(spark, str(inbox), out, "r2", str(archive))
    assert got["entries"] == 1 and got["silver_rows"] == 9
    with pytest.raises(ValueError, match="inside"):
        run_sweep(spark, str(inbox), out, "r3", str(inbox / "done"))


def test_a_handled_entry_that_changed_stays(spark, tmp_path):
    from driftsweep.plans.run import move_handled

    inbox, out = tmp_path / "inbox", str(tmp_path / "out")
    put(inbox, a=people(3), b=people(2))
    run_sweep(spark, str(inbox), out, "r1")
    put(inbox, a=people(9))
    assert move_handled(spark, str(inbox), ledger.handled(spark, out), str(tmp_path / "archive")) == 1
    assert os.listdir(inbox) == ["a.csv"]
    assert run_sweep(spark, str(inbox), out, "r2")["silver_rows"] == 14


def test_compaction_rewrites_only_crowded_partitions(spark, tmp_path):
    inbox, out = tmp_path / "inbox", str(tmp_path / "out")
    put(inbox, a=people(300), b=people(4, "M"))
    run_sweep(spark, str(inbox), out, "007")
    path = f"{out}/silver"
    for _ in range(3):     # many small files in a's partition
        more = tables.read_silver(spark, path, dataset="a", with_run=True).limit(50).checkpoint()
        more.write.mode("append").partitionBy("run_id", "file_name").parquet(path)
    before = tables.read_silver(spark, path, with_run=True).checkpoint()
    names = lambda: {r.file for r in tables.file_sizes(spark, path).collect()}
    old = names()
    done = tables.compact(spark, path, tables.run_schema(), ["run_id", "file_name"]).collect()
    assert [(os.path.basename(r.folder), r.files, r.bins) for r in done] == [("file_name=a", 4, 1)]
    new = names()
    assert len(new) == 2 and len(new & old) == 1 and "run_id=007" in min(new)
    after = tables.read_silver(spark, path, with_run=True)
    assert after.count() == before.count() == 454 and after.exceptAll(before).isEmpty()
    assert tables.compact(spark, path, tables.run_schema(), ["run_id", "file_name"]).isEmpty()


def test_many_entries_are_selected_without_names_on_the_driver(spark, tmp_path):
    from driftsweep.plans.run import new_entries
    from driftsweep.sources import csv_inbox

    inbox = tmp_path / "inbox"
    inbox.mkdir()
    for i in range(3000):
        (inbox / f"e{i:05d}.csv").write_text(people(1) if i % 3 else "")
    entries = new_entries(spark, str(inbox), str(tmp_path / "out"), "r1")
    assert entries.count() == 3000
    man = csv_inbox.manifest(spark, str(inbox)).agg(F.count_if(F.col("n_parts") == 0).alias("e"), F.max("file_ordinal").alias("m")).first()
    assert (man.e, man.m) == (1000, 3000)
