"""Workbook decoding and the mixed CSV + workbook sweep."""

import datetime as dt
import os

import pytest

from driftsweep.plans.medallion import Sweep
from driftsweep.sources.xlsx_inbox import workbook_rows
from driftsweep.sources.xlsx_writer import workbook_bytes

CANON = ["EmailAddress", "FirstName", "LastName", "CID", "CreatedDate", "Sent", "Open"]


def _book():
    return workbook_bytes({
        "S1": [CANON,
               ["a@x", "Ann", "Lee", "C1", dt.datetime(2024, 1, 2, 3, 4, 5), 5, True],
               ["b@x", "Bob Ray", None, "C2", dt.date(2023, 12, 31), 2.5, False],
               [None, None, None, None, None, None, None],
               ["c@x", "N/A", "Roe", 17, "2024-02-03", 0, None]],
        "Empty": [],
        "Numbers": [[2024, "FirstName"], [1, "x"]],
    })


def test_decode_cells(spark, tmp_path):
    (tmp_path / "book.xlsx").write_bytes(_book())
    rows = sorted(map(tuple, workbook_rows(spark, str(tmp_path)).collect()), key=lambda r: (r[1], r[4]))
    s1 = [r for r in rows if r[2] == "S1"]
    assert [r[3] for r in s1] == [1, 2, 3, 4, 5]                    # a blank row stays a row
    assert [r[4] for r in s1] == [0, 1, 2, 3, 4]                    # dense sequence per sheet
    assert s1[3][5] == []
    assert s1[0][5] == CANON and s1[0][6] is True                    # header, all text
    assert s1[1][5] == ["a@x", "Ann", "Lee", "C1", "2024-01-02 03:04:05", "5", "True"]
    assert s1[2][5] == ["b@x", "Bob Ray", None, "C2", "2023-12-31 00:00:00", "2.5", "False"]
    assert s1[4][5] == ["c@x", "N/A", "Roe", "17", "2024-02-03", "0"]
    assert not [r for r in rows if r[2] == "Empty"]                  # no rows, no dataset
    nums = [r for r in rows if r[2] == "Numbers"]
    assert nums[0][6] is False                                       # numeric header cell
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "bad.xlsx").write_bytes(b"not a zip")
    assert [r.error for r in workbook_rows(spark, str(tmp_path / "bad")).collect()] == ["unreadable: BadZipFile"]


def test_numbers_and_dates_as_the_tabular_reader_renders_them(spark):
    from pyspark.sql import functions as F

    from driftsweep.sources.xlsx_inbox import with_number, with_serial

    texts = ["5", "-7", "2.5", "0.1", "1e3", "12345678.9", "-123456789.25", "1.5E-7", "0.00001", "0.0001", "100000000000000000000", "1e20", "3.0", "-0.5"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    want = {t: str(int(t)) if not any(c in t for c in ".eE") else (str(int(float(t))) if float(t).is_integer() else repr(float(t))) for t in texts}
    assert {r.t: r.n for r in with_number(df, "t", "n").collect()} == want
    base = dt.datetime(1899, 12, 30)
    serials = ["45000", "45000.5", "45000.123456789", "60", "61.999999999", "1"]
    days = spark.createDataFrame([(t,) for t in [*serials, "0.75"]], "t string").withColumn("own", F.lit(False))
    got = {r.t: r.d for r in with_serial(days, "t", "own", "d").collect()}
    for t in serials:
        x = float(t) + (1 if 0 < float(t) < 60 else 0)
        assert got[t] == str(base + dt.timedelta(days=int(x), milliseconds=round((x - int(x)) * 86_400_000)))
    assert got["0.75"] == "18:00:00"


@pytest.fixture(scope="module")
def sweep(spark, tmp_path_factory):
    inbox = tmp_path_factory.mktemp("mixed")
    files = {
        "book.xlsx": _book(),
        "a.csv.v2.xlsx": workbook_bytes({"S1": [["FirstName", "CID"], ["Zed", "C9"]]}),
        "bad.xlsx": b"not a zip",
        "old.xls": b"\xd0\xcf\x11\xe0 not decoded",
        "one_row.csv": b"FirstName,CID\nAnn,C1\n",
        "plain.csv": b"FirstName,CID\nAnn,C1\nBob,C2\n",
    }
    for name, data in files.items():
        with open(os.path.join(inbox, name), "wb") as f:
            f.write(data)
    return Sweep.from_inbox(spark, str(inbox))


def test_mixed_status(sweep):
    st = {r.entry: (r.status, r.reason) for r in sweep.status.collect()}
    assert st["book.xlsx"] == ("good", None) and st["plain.csv"] == ("good", None)
    assert st["bad.xlsx"][0] == "error" and st["old.xls"] == ("error", "unsupported_xls")
    order = {r.entry: r.file_ordinal for r in sweep.manifest.collect()}
    assert order["a.csv.v2.xlsx"] < order["book.xlsx"] < order["old.xls"] < order["one_row.csv"]


def test_sheet_fanout_and_gates(sweep):
    g = {r.file_name: (r.fmt, r.shape_ok, r.gate_ok) for r in sweep.gated.collect()}
    assert g["book_S1"] == ("xlsx", True, True)
    assert g["a.v2_S1"] == ("xlsx", True, True)       # one data row is enough for a sheet
    assert g["one_row"] == ("csv", False, True)       # but not for CSV
    assert g["book_Numbers"][2] is False               # non-text header fails the gate
    assert "book_Empty" not in g


def test_workbook_silver(sweep):
    rows = {r.emailaddress: r for r in sweep.silver_rows.where("file_name = 'book_S1'").collect()}
    assert rows["a@x"].createddate == "2024-01-02" and rows["a@x"].sent == "5" and rows["a@x"].open == "True"
    assert rows["b@x"].createddate == "2023-12-31" and rows["b@x"].lastname == ""
    assert rows["c@x"].firstname == "" and rows["c@x"].cid == "17"
    assert sweep.silver.where("file_name = 'a.v2_S1'").count() == 1


def test_empty_inbox_flows_through(spark, tmp_path):
    from driftsweep.schema import GOLD_ORDER, SILVER_ORDER

    sw = Sweep.from_inbox(spark, str(tmp_path))
    assert sw.gold.columns == GOLD_ORDER and sw.gold.count() == 0
    assert sw.silver.columns == SILVER_ORDER and sw.silver.count() == 0


def test_wide_and_long_workbook_is_read_whole(spark, tmp_path):
    from driftsweep.sources.xlsx_inbox import workbook_rows

    wide = ["FirstName", "CID", *[f"x{i}" for i in range(1500)]]
    (tmp_path / "big.xlsx").write_bytes(workbook_bytes({"S": [wide, *[[f"N{k}", f"C{k}", *["v"] * 1500] for k in range(300)]]}))
    rows = workbook_rows(spark, str(tmp_path)).collect()
    assert len(rows) == 301 and {len(r.cells) for r in rows} == {1502} and not any(r.error for r in rows)


def test_blank_rows_stay_rows(spark, tmp_path):
    blank = [None, None]
    (tmp_path / "gap.xlsx").write_bytes(workbook_bytes({"S": [["FirstName", "CID"], ["A", "1"], blank, blank, ["B", "2"]],
                                                        "T": [blank, ["C", "3"], ["D", "4"]]}))
    sw = Sweep.from_inbox(spark, str(tmp_path))
    assert [r.cid for r in sw.silver.where("file_name = 'gap_S'").orderBy("rowid").collect()] == ["1", "", "", "2"]
    assert {r.file_name: r.headers for r in sw.datasets.collect()}["gap_T"] == ["Unnamed: 0", "Unnamed: 1"]


def test_run_sweep_end_to_end(spark, tmp_path):
    from driftsweep.plans.run import run_sweep

    inbox = tmp_path / "inbox"
    inbox.mkdir()
    (inbox / "book.xlsx").write_bytes(_book())
    (inbox / "plain.csv").write_text("FirstName,CID\nAnn,C1\nBob,C2\n")
    (inbox / "empty.csv").write_text("")
    out = str(tmp_path / "out")
    first = run_sweep(spark, str(inbox), out, run_id="r1")
    assert first == {"entries": 3, "errors": 1, "silver_rows": 6, "gold_rows": 6}     # a blank sheet row is a row
    same = run_sweep(spark, str(inbox), out, run_id="r1")      # the same run again: its own rows only
    assert same == first
    again = run_sweep(spark, str(inbox), out, run_id="r2")     # nothing new in the inbox
    assert again == {"entries": 0, "errors": 0, "silver_rows": 6, "gold_rows": 6}
    (inbox / "plain.csv").write_text("FirstName,CID\nCy,C3\nDee,C4\nEve,C5\n")
    (inbox / "bad.csv").write_text("FirstName,CID\nCy,C3,x\n")
    third = run_sweep(spark, str(inbox), out, run_id="r3")     # a second delivery: both are kept
    assert third == {"entries": 2, "errors": 1, "silver_rows": 9, "gold_rows": 9}
    held = spark.read.parquet(f"{out}/quarantine").collect()
    assert [(r.entry, r.reason, bytes(r.content)) for r in held] == [("bad.csv", "overlong", b"FirstName,CID\nCy,C3,x\n")]
