"""Plan-shape assertions, sinks, streaming and the driver contract."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

from data_paths import SF_SMALL
from driftsweep.plans.medallion import Sweep
from driftsweep.session import scratch_path
from driftsweep.sinks import tables


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_gold_plan_stays_in_jvm(spark):
    plan = _plan(Sweep.from_fixtures(spark, SF_SMALL).gold)
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan, bad
    assert "BroadcastHashJoin" in plan  # the resolver mapping is broadcast after its size check


def test_resolver_scores_without_join(spark):
    sw = Sweep.from_fixtures(spark, SF_SMALL)
    plan = _plan(sw.resolution["scores"])
    assert "Generate" in plan and "Join" not in plan.split("Generate")[0]


def test_partition_pruning(spark):
    path = scratch_path(spark, "silver_test")
    tables.append_silver(Sweep.from_fixtures(spark, SF_SMALL).silver, path)
    df = tables.read_silver(spark, path, dataset="canon")
    assert "PartitionFilters: [isnotnull(file_name" in _plan(df) or "PartitionFilters" in _plan(df)
    assert df.count() == df.where("file_name = 'canon'").count() > 0


def test_runs_are_kept_and_a_repeated_run_adds_nothing(spark):
    path = scratch_path(spark, "silver_runs")
    silver = Sweep.from_fixtures(spark, SF_SMALL).silver
    n = silver.count()
    for run in ("r1", "r2", "r2"):
        tables.append_silver(silver, path, run_id=run)
    back = tables.read_silver(spark, path, with_run=True)
    assert back.count() == 2 * n == back.select("run_id", "rowid").distinct().count()
    plain = scratch_path(spark, "silver_append")
    tables.append_silver(silver, plain)
    tables.append_silver(silver, plain)
    assert tables.read_silver(spark, plain).count() == 2 * n


def test_not_null_enforced(spark):
    from pyspark.sql import functions as F

    bad = Sweep.from_fixtures(spark, SF_SMALL).silver.withColumn("rowid", F.lit(None).cast("long"))
    with pytest.raises(Exception, match="NOT NULL"):
        tables.typed_silver(bad).collect()


def test_ddl_and_drop(spark):
    name = "t_silver_ddl"
    tables.drop_table(spark, name)
    tables.create_silver_table(spark, name, scratch_path(spark, "ddl"))
    cols = [f.name for f in spark.table(name).schema.fields]
    assert cols[0] == "rowid" and cols[-1] == "file_name" and len(cols) == 35
    tables.drop_table(spark, name)
    assert not spark.catalog.tableExists(name)


def test_stream_equals_batch_and_reruns_add_nothing(spark):
    from driftsweep.sources.csv_inbox import write_fixture_inbox
    from driftsweep.streaming.sweep_stream import read_stream_gold, run_available

    inbox, out, ck = (scratch_path(spark, n) for n in ("s_inbox", "s_out", "s_ck"))
    write_fixture_inbox(spark, SF_SMALL, inbox)
    run_available(spark, inbox, out, ck)
    got = read_stream_gold(spark, out)
    ref = Sweep.from_fixtures(spark, SF_SMALL).gold
    assert got.count() == ref.count() and got.exceptAll(ref).count() == 0 and ref.exceptAll(got).count() == 0
    run_available(spark, inbox, out, ck)
    assert read_stream_gold(spark, out).count() == ref.count()


def test_entry_contract(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[-1] == "sourcefile" and len(df.columns) == 22
    assert set(E.oracle_sql()) <= set(E.queries())


ORACLE_SUBSET = ["gold_harmonise", "resolver", "match_report", "silver_order", "csv_sweep", "probe_status",
                 "date_normalise_mixed", "indel_ratio"]


@pytest.mark.parametrize("name", ORACLE_SUBSET)
def test_oracle_small(spark, name):
    """Same comparison as the driver, at sf0.001 (where the all-blank rule applies)."""
    import __spark_entry__ as E
    from tools.oracle_check import TABLES, digest

    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    df = E.queries()[name](spark, SF_SMALL)
    rel = con.sql(E.oracle_sql()[name])
    s_rows, o_rows = [tuple(r) for r in df.collect()], rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert digest(df.columns, s_rows)[0] == digest(rel.columns, o_rows)[0]


def test_salted_join_matches_plain_join(spark):
    from pyspark.sql import functions as F

    from driftsweep.operators.joins import join_checked

    big = spark.range(0, 20000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))  # hot keys
    small = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "k long, name string")
    salted = join_checked(big, small, ["k"], max_rows=0, salt_from=["v"])      # forced fallback
    plain = big.join(small, "k")
    assert salted.count() == plain.count() == 20000
    assert salted.exceptAll(plain).count() == 0


def test_salted_fallback_gives_same_gold(spark):
    from driftsweep.operators.joins import CONF_KEY

    ref = Sweep.from_fixtures(spark, SF_SMALL).gold
    n = ref.count()
    spark.conf.set(CONF_KEY, "0")
    try:
        alt = Sweep.from_fixtures(spark, SF_SMALL)
        got = alt.gold
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert got.count() == n and got.exceptAll(ref).count() == 0 and ref.exceptAll(got).count() == 0
        rows = sorted(r.rowid for r in alt.silver.select("rowid").collect())
        assert rows == list(range(n))
    finally:
        spark.conf.unset(CONF_KEY)
    assert "_salt" in plan or "xxhash64" in plan


def test_stream_few_files_per_batch_equals_batch(spark, tmp_path):
    """Entries of several one-row parts, two files a micro-batch; a later entry keeps a shared dataset name."""
    from driftsweep.streaming.sweep_stream import read_stream_gold, read_stream_silver, start_sweep_stream

    inbox = tmp_path / "inbox"
    for name, n in (("parts.csv", 3), ("two.csv", 2)):
        (inbox / name).mkdir(parents=True)
        for k in range(n):
            (inbox / name / f"part-{k}.csv").write_text(f"FirstName,CID\nAnn{k},C{k}\n")
    (inbox / "twin.csv").write_text("FirstName,CID\nA,1\nB,2\n")
    (inbox / "twin.csv.csv").write_text("FirstName,CID\nC,3\nD,4\n")
    out, ck = (scratch_path(spark, n) for n in ("s1_out", "s1_ck"))
    q = start_sweep_stream(spark, str(inbox), out, ck, max_files_per_trigger=2)
    q.awaitTermination()
    assert q.exception() is None
    got, ref = read_stream_gold(spark, out), Sweep.from_csv_inbox(spark, str(inbox)).gold
    assert got.count() == ref.count() == 7 and got.exceptAll(ref).count() == 0
    assert {r.cid for r in got.where("sourcefile = 'twin'").collect()} == {"3", "4"}
    s = read_stream_silver(spark, out)
    assert s.select("epoch", "rowid").distinct().count() == 7 and s.select("epoch").distinct().count() >= 2


def test_fixture_silver_plan_has_no_shuffle(spark):
    plan = _plan(Sweep.from_fixtures(spark, SF_SMALL).silver)
    shuffles = [l for l in plan.splitlines() if "Exchange" in l and "BroadcastExchange" not in l]
    assert shuffles == [], shuffles
    assert "GetMapValue" not in plan and "element_at(mapping" not in plan   # flat mapping columns


def test_salted_join_is_not_broadcast(spark):
    """Small files may hold many rows; the salted side comes once per salt."""
    from driftsweep.operators.joins import salted_join

    big = spark.range(50).select((F.col("id") % 5).alias("k"), "id")
    small = spark.range(5).select(F.col("id").alias("k"), F.col("id").cast("string").alias("v"))
    out = salted_join(big, small, ["k"], "left", salt_from=["id"])
    assert "BroadcastHashJoin" not in _plan(out)
    assert sorted((r.id, r.v) for r in out.collect()) == [(i, str(i % 5)) for i in range(50)]


def test_rows_put_together_from_cells_are_not_broadcast(spark):
    from driftsweep.operators.records import cells_to_records
    from driftsweep.sources.xlsx_inbox import PARTS, sheet_rows

    cells = spark.createDataFrame([("a", 1, 0, "h"), ("a", 2, 0, "x"), ("a", 4, 0, "z")], "sheet string, row_no long, col int, value string")
    r = cells_to_records(cells, ["sheet"])
    assert "SortMergeJoin" in _plan(r)
    assert [(x.row_no, x.cells) for x in r.orderBy("row_no").collect()] == [(2, ["x"]), (3, [None]), (4, ["z"])]
    parts = spark.createDataFrame([
        ("b.xlsx", "xl/workbook.xml", 0, '<workbook><sheets><sheet name="S" r:id="r1"/></sheets></workbook>', None),
        ("b.xlsx", "xl/_rels/workbook.xml.rels", 0, '<Relationships><Relationship Id="r1" Target="worksheets/s.xml"/></Relationships>', None),
        ("b.xlsx", "xl/worksheets/s.xml", -1, None, None),
        ("b.xlsx", "xl/worksheets/s.xml", 0, '<row r="2"><c r="B2" t="str"><v>x</v></c></row>', None)], PARTS)
    rows = sheet_rows(parts)
    assert "SortMergeJoin" in _plan(rows)
    assert [(x.row_no, x.cells) for x in rows.orderBy("row_no").collect()] == [(1, []), (2, [None, "x"])]


def test_stream_sweeps_an_entry_once_for_its_files(spark, tmp_path):
    """An entry of eight files, two a micro-batch: one sweep; a file that comes later: another one."""
    from driftsweep.streaming import sweep_stream

    inbox, out, ck = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ck")
    entry = inbox / "a.csv"
    entry.mkdir(parents=True)
    for i in range(8):
        (entry / f"part-{i}.csv").write_text(f"FirstName,CID\nn{i},{i}\n")
    sweep_stream.run_available(spark, str(inbox), out, ck, max_files_per_trigger=2)
    epochs = lambda: {r.epoch for r in spark.read.parquet(f"{out}/status").select("epoch").distinct().collect()}
    cids = lambda: sorted(r.cid for r in sweep_stream.read_stream_silver(spark, out).collect())
    assert epochs() == {0} and cids() == [str(i) for i in range(8)]
    (entry / "part-8.csv").write_text("FirstName,CID\nn8,8\n")
    sweep_stream.run_available(spark, str(inbox), out, ck, max_files_per_trigger=2)
    assert epochs() == {0, 4} and cids() == [str(i) for i in range(9)]


def test_stream_keeps_what_it_knows_over_snapshots(spark, tmp_path, monkeypatch):
    """Micro-batches without a sweep still write the snapshots that later ones read."""
    from driftsweep.streaming import sweep_stream

    monkeypatch.setattr(sweep_stream, "SNAPSHOT", 2)
    inbox, out, ck = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ck")
    entry = inbox / "twin.csv.csv"
    entry.mkdir(parents=True)
    for i in range(6):
        (entry / f"part-{i}.csv").write_text(f"FirstName,CID\nn{i},{i}\n")
    sweep_stream.run_available(spark, str(inbox), out, ck, max_files_per_trigger=1)
    (inbox / "twin.csv").write_text("FirstName,CID\nother,99\nother,98\n")   # the same dataset, discovered earlier: it loses
    sweep_stream.run_available(spark, str(inbox), out, ck, max_files_per_trigger=1)
    assert sorted(r.cid for r in sweep_stream.read_stream_silver(spark, out).collect()) == [str(i) for i in range(6)]
    assert {r.epoch for r in spark.read.parquet(f"{out}/status").collect()} == {0, 6}
