"""Registered queries: one callable (spark, sf_dir) -> DataFrame per operator.

Each query reads the driver tables (or data Spark derives from them) in full.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftsweep.functions.dates import normalise_date, parse_date
from driftsweep.functions.similarity import char_masks, indel_ratio, lcs_fast, lcs_length, passes_threshold
from driftsweep.functions.text import (
    basename, clean_header, dataset_name, extension, na_to_null,
)
from driftsweep.functions.text import non_blank as is_non_blank
from driftsweep.operators import quality
from driftsweep.operators.rowid import with_dense_index
from driftsweep.plans.medallion import Sweep
from driftsweep.schema import DATE_TARGETS, INBOX_EXTENSIONS, NA_TOKENS, SILVER_ORDER, TARGETS
from driftsweep.sinks import tables
from driftsweep.session import app_id, scratch_path
from driftsweep.sources import csv_inbox, fixtures
from driftsweep.sources.fixtures import table
from driftsweep.streaming import sweep_stream

Query = Callable[[SparkSession, str], DataFrame]

# ---------------------------------------------------------------- medallion over the fixture inbox


def gold_harmonise(spark, sf):
    return Sweep.from_fixtures(spark, sf).gold


def silver_order(spark, sf):
    return Sweep.from_fixtures(spark, sf).silver


def silver_project(spark, sf):
    return Sweep.from_fixtures(spark, sf).projected.select("file_name", "src_row", *TARGETS)


def resolver(spark, sf):
    d = Sweep.from_fixtures(spark, sf).resolution["decisions"]
    return d.select("file_name", "target", "i_score", "i_count", "found", "score", "row_count", "resolved")


def match_report(spark, sf):
    r = Sweep.from_fixtures(spark, sf).resolution["report"]
    return r.select("file_name", "target", "alias_no", F.col("alias").alias("query"), "found", "score", "row_count")


def best_header(spark, sf):
    b = Sweep.from_fixtures(spark, sf).resolution["best"]
    return b.select("file_name", "target", "alias_no", "found", "found_pos", "score")


def non_blank_counts(spark, sf):
    return Sweep.from_fixtures(spark, sf).resolution["counts"].select("file_name", "header", "n_non_blank")


def date_normalise(spark, sf):
    return Sweep.from_fixtures(spark, sf).silver_rows.select("file_name", "src_row", *DATE_TARGETS)


def silver_date_rejects(spark, sf):
    """Reject report on swept data: non-blank date cells no accepted form parses (an orders export)."""
    from driftsweep.operators.harmonise import date_rejects

    m = _mixed_dates(spark, sf).select(F.col("o_orderkey").cast("string").alias("CID"), F.col("raw").alias("CreatedDate"))
    return date_rejects(Sweep.from_csv_inbox(spark, _written(spark, sf, "dates", {"dates.csv": m})).projected)


def split_name(spark, sf):
    return Sweep.from_fixtures(spark, sf).silver_rows.select("file_name", "src_row", "firstname", "lastname")


def fill_cid(spark, sf):
    return Sweep.from_fixtures(spark, sf).silver_rows.select(
        "file_name", "src_row", "cid", "var1", "var2", "var3", "var4")


def rowid(spark, sf):
    return Sweep.from_fixtures(spark, sf).silver.select("rowid", "file_name", "emailaddress")


def lineage(spark, sf):
    return (Sweep.from_fixtures(spark, sf).silver_rows.groupBy("file_name")
            .agg(F.count(F.lit(1)).alias("n_rows")))


def min_shape(spark, sf):
    g = Sweep.from_fixtures(spark, sf).gated
    return g.select("file_name", "fmt", "n_rows", F.size("headers").alias("n_cols"), "shape_ok")


def header_gate(spark, sf):
    return Sweep.from_fixtures(spark, sf).gated.select("file_name", "gate_ok", "accepted")


def sheet_shape(spark, sf):
    d = Sweep.from_fixtures(spark, sf).datasets
    # a workbook's row count includes its header row, a CSV's does not
    max_row = F.when(F.col("fmt") == "csv", F.col("n_rows")).otherwise(F.col("n_rows") + 1)
    return d.select("file_name", "fmt", F.col("n_rows"), F.size("headers").alias("n_cols"),
                    max_row.alias("max_row"))


def audit_datasets(spark, sf):
    return quality.audit_datasets(Sweep.from_fixtures(spark, sf).datasets)


def read_success_count(spark, sf):
    d = Sweep.from_fixtures(spark, sf).datasets
    return d.agg(F.count_distinct("source").alias("n_read"))


def preview(spark, sf):
    b = fixtures.fixture_bronze(spark, sf)
    return quality.preview(b, 10).select("file_name", "src_row", "preview_no")


def _named_cells(spark, sf, raw=False):
    """(file_name, header, value) for every cell of the fixture inbox."""
    b = fixtures.fixture_bronze(spark, sf, raw=raw)
    lay = fixtures.layouts_frame(spark)  # fixed: one row per fixture dataset
    x = b.select("file_name", F.posexplode("cells").alias("pos", "value"))
    h = lay.select("file_name", F.posexplode("headers").alias("pos", "header"))
    return x.join(F.broadcast(h), ["file_name", "pos"]).select("file_name", "header", "value")


def non_blank(spark, sf):
    v = F.col("value")
    return (_named_cells(spark, sf)
            .groupBy("file_name", "header")
            .agg(F.count_if(v.isNull()).alias("n_null"),
                 F.count_if(v.isin("", " ")).alias("n_blank"),
                 F.count_if(is_non_blank(v)).alias("n_non_blank")))


def na_tokens(spark, sf):
    v = F.col("value")
    return (_named_cells(spark, sf, raw=True)
            .groupBy("file_name", "header")
            .agg(F.count_if(v.isin(NA_TOKENS)).alias("n_na"),
                 F.count_if(na_to_null(v).isNull()).alias("n_null_after")))


# ---------------------------------------------------------------- scalar functions over table columns


def indel_ratio_q(spark, sf):
    x = table(spark, sf, "part").select("p_partkey", "p_name", "p_type")
    x = x.withColumn("lcs", lcs_length(F.col("p_name"), F.col("p_type")))
    return x.withColumn("score", indel_ratio(F.col("p_name"), F.col("p_type"), F.col("lcs")))


def score_threshold(spark, sf):
    """Every part type against a misspelt form of itself (no E) or against the part's name."""
    a = F.col("p_type")
    b = F.when(F.col("p_partkey") % 2 == 0, F.replace(a, F.lit("E"), F.lit(""))).otherwise(F.col("p_name"))
    x = table(spark, sf, "part").select("p_partkey", "p_type", b.alias("other"))
    # a column of its own: score and decision share it
    x = x.withColumn("lcs", lcs_fast(a, F.col("other"), char_masks(F.col("other"))))
    return x.select("p_partkey", "p_type", "other", indel_ratio(a, F.col("other"), F.col("lcs")).alias("score"),
                    passes_threshold(a, F.col("other"), F.col("lcs")).alias("passes"))


def clean_header_q(spark, sf):
    p = table(spark, sf, "part")
    return p.select("p_partkey", "p_type", clean_header(F.col("p_type")).alias("cleaned"))


def _mixed_dates(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    d = F.col("o_orderdate")
    form = (F.col("o_orderkey") % 8).cast("int")
    raw = (F.when(form == 0, F.date_format(d, "yyyy-MM-dd HH:mm:ss"))
            .when(form == 1, F.date_format(d, "yyyy-MM-dd"))
            .when(form == 2, F.date_format(d, "M/d/yyyy"))
            .when(form == 3, F.date_format(d, "MMM d, yyyy"))
            .when(form == 4, F.date_format(d, "yyyyMMdd"))
            .when(form == 5, F.date_format(d, "dd/MM/yyyy"))
            .when(form == 6, F.lit("abc"))
            .otherwise(F.lit("")))
    return o.select("o_orderkey", form.alias("form"), raw.alias("raw"))


def date_normalise_mixed(spark, sf):
    m = _mixed_dates(spark, sf)
    return m.select("o_orderkey", "raw", normalise_date(F.col("raw")).alias("normalised"))


def date_reject_report(spark, sf):
    m = _mixed_dates(spark, sf)
    v = F.col("raw")
    return (m.groupBy("form")
            .agg(F.count_if(is_non_blank(v)).alias("n_values"),
                 F.count_if(is_non_blank(v) & parse_date(v).isNull()).alias("n_rejects")))


# ---------------------------------------------------------------- inbox names synthesised from pages


def _inbox_names(spark, sf):
    p = table(spark, sf, "pages").select("page_id", "url")
    host = F.regexp_extract(F.col("url"), r"://([^/]+)", 1)
    ext = (F.when(F.col("page_id") % 6 == 0, ".csv").when(F.col("page_id") % 6 == 1, ".xlsx")
            .when(F.col("page_id") % 6 == 2, ".xls").when(F.col("page_id") % 6 == 3, ".CSV")
            .when(F.col("page_id") % 6 == 4, ".txt").otherwise(".csv.xlsx"))
    file = F.concat(F.lit("p"), F.col("page_id").cast("string"), F.lit("_"), host, ext)
    return p.select("page_id", "url", file.alias("file"))


def _allowed(file):
    return F.exists(F.array(*[F.lit(e) for e in INBOX_EXTENSIONS]), lambda e: file.endswith(e))


def inbox_filter(spark, sf):
    n = _inbox_names(spark, sf)
    return n.select("page_id", "file", _allowed(F.col("file")).alias("allowed"))


def dispatch_ext(spark, sf):
    n = _inbox_names(spark, sf)
    e = extension(F.col("file"))
    kind = F.when(e == ".xls", "xls").when(e == ".xlsx", "xlsx").when(e == ".csv", "csv").otherwise("other")
    return n.select("page_id", "file", e.alias("ext"), kind.alias("kind"))


def discover_order(spark, sf):
    n = _inbox_names(spark, sf)
    f = F.col("file")
    rank = F.when(f.endswith(".xlsx"), 0).when(f.endswith(".xls"), 1).when(f.endswith(".csv"), 2)
    ranked = n.select("page_id", "file", rank.alias("type_rank")).where(F.col("type_rank").isNotNull())
    out = with_dense_index(ranked, ["type_rank", "file"], "file_ordinal")
    return out.select("page_id", "file", (F.col("file_ordinal") + 1).alias("file_ordinal"))


def dataset_name_q(spark, sf):
    n = _inbox_names(spark, sf)
    e = extension(F.col("file"))
    sheet = F.when(e.isin(".xlsx", ".xls"), F.concat(F.lit("Sheet"), (F.col("page_id") % 3).cast("string")))
    return n.select("page_id", "file", sheet.alias("sheet"),
                    dataset_name(F.col("file"), sheet).alias("dataset_name"))


def basename_q(spark, sf):
    p = table(spark, sf, "pages")
    return p.select("page_id", basename(F.col("url")).alias("basename"))


def run_stamp(spark, sf):
    e = table(spark, sf, "events")
    return e.select("event_id", F.date_format("ts", "yyyy-MM-dd_HHmmss").alias("run_id"))


# ---------------------------------------------------------------- real CSV inbox written from the tables

_INBOXES: dict[tuple[str, str, bool], str] = {}


def fixture_inbox(spark: SparkSession, sf: str, adversarial: bool = False) -> str:
    """Write (once per session and scale) the fixture datasets as CSV entries, optionally
    with the adversarial entries, into the shared scratch folder."""
    key = (app_id(spark), sf, adversarial)
    if key not in _INBOXES:
        inbox = scratch_path(spark, "inbox")
        csv_inbox.write_fixture_inbox(spark, sf, inbox)
        if adversarial:
            csv_inbox.write_adversarial_entries(spark, sf, inbox)
        _INBOXES[key] = inbox
    return _INBOXES[key]


def _hot_inbox(spark, sf):
    key = (app_id(spark), sf, "hot")
    if key not in _INBOXES:
        inbox = scratch_path(spark, "hot_inbox")
        csv_inbox.write_fixture_inbox(spark, sf, inbox)
        csv_inbox.write_lineitem_entry(spark, sf, inbox)
        _INBOXES[key] = inbox
    return _INBOXES[key]


def hot_sweep(spark, sf):
    """Gold from an inbox whose lineitem export holds most of the rows (many part files)."""
    return Sweep.from_csv_inbox(spark, _hot_inbox(spark, sf)).gold


def hot_lineage(spark, sf):
    sw = Sweep.from_csv_inbox(spark, _hot_inbox(spark, sf))
    return sw.silver.groupBy("file_name").agg(F.count(F.lit(1)).alias("n_rows"), F.min("rowid").alias("first_rowid"),
                                              F.max("rowid").alias("last_rowid"))


def csv_sweep(spark, sf):
    return Sweep.from_csv_inbox(spark, fixture_inbox(spark, sf)).gold


def csv_silver(spark, sf):
    return Sweep.from_csv_inbox(spark, fixture_inbox(spark, sf)).silver_rows.select(
        "file_name", *TARGETS)


def probe_status(spark, sf):
    st = Sweep.from_csv_inbox(spark, fixture_inbox(spark, sf, True)).status
    return st.select("entry", "status", "reason", "n_rows")


def route_good(spark, sf):
    st = Sweep.from_csv_inbox(spark, fixture_inbox(spark, sf, True)).status
    return st.where("status = 'good'").select("entry", "file_ordinal")


def route_error(spark, sf):
    st = Sweep.from_csv_inbox(spark, fixture_inbox(spark, sf, True)).status
    return st.where("status = 'error'").select("entry", "reason")


def inbox_manifest(spark, sf):
    """Manifest of an inbox with one entry per nation that has suppliers, its name from the tables."""
    key = (app_id(spark), sf, "nations")
    if key not in _INBOXES:
        n = table(spark, sf, "nation")
        ext = F.element_at(F.array(*[F.lit(e) for e in (".csv", ".txt", ".csv.csv", ".xls")]), (F.col("n_nationkey") % 4 + 1).cast("int"))
        rows = table(spark, sf, "supplier").join(n, F.col("s_nationkey") == F.col("n_nationkey")).select(
            "s_name", F.concat("n_name", ext).alias("nation"))
        _INBOXES[key] = scratch_path(spark, "nation_inbox")
        rows.write.partitionBy("nation").option("header", "true").csv(_INBOXES[key])
    return csv_inbox.manifest(spark, _INBOXES[key]).select("entry", "allowed", "ext", "kind", "file_ordinal")


def _written(spark, sf, name, entries):
    """Write (once per session and scale) CSV entries into a fresh inbox of the shared scratch folder."""
    key = (app_id(spark), sf, name)
    if key not in _INBOXES:
        inbox = scratch_path(spark, f"{name}_inbox")
        for entry, df in entries.items():
            (df.write.option("header", "true").option("escape", '"').option("ignoreLeadingWhiteSpace", "false")
             .option("ignoreTrailingWhiteSpace", "false").csv(f"{inbox}/{entry}"))
        _INBOXES[key] = inbox
    return _INBOXES[key]


def csv_multiline(spark, sf):
    """Whole documents as cells with line breaks, quotes and commas, under a header with a line break."""
    d = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("CID"), F.col("text").alias("Var1"),
                                             F.col("lang").alias("State\nof origin"))
    sw = Sweep.from_csv_inbox(spark, _written(spark, sf, "texts", {"texts.csv": d}))
    return sw.silver_rows.select("cid", "var1", F.lit(sw.datasets.first()["headers"][2]).alias("third_header"))


def csv_wide(spark, sf):
    """An entry of 1,500 columns."""
    s = table(spark, sf, "supplier")
    wide = s.select(F.col("s_suppkey").cast("string").alias("CID"), F.col("s_name").alias("SubscriberKey"),
                    *[(F.col("s_suppkey") + i).cast("string").alias(f"x{i}") for i in range(1498)])
    sw = Sweep.from_csv_inbox(spark, _written(spark, sf, "wide", {"wide.csv": wide}))
    n = sw.datasets.select("file_name", F.size("headers").alias("n_cols"))
    return sw.silver_rows.join(n, "file_name").select("file_name", "cid", "subscriberkey", "n_cols")


def header_repair(spark, sf):
    """Header lists made of nation names: repeated names, blanks, a name that is another's repetition."""
    n = F.col("n_name")
    names = (F.when(F.col("n_nationkey") % 3 == 0, F.array(n, n, F.concat(n, F.lit(".1")), F.lit("")))
             .when(F.col("n_nationkey") % 3 == 1, F.array(F.concat(n, F.lit(".1")), n, n, n))
             .otherwise(F.array(F.lit(""), n, F.lit("Unnamed: 0"), n)))
    return table(spark, sf, "nation").select("n_name", F.array_join(csv_inbox.repair_headers(names), "|").alias("headers"))


def silver_two_runs(spark, sf):
    """Two deliveries under one dataset name: both runs' rows are kept, (run_id, rowid) is their key."""
    from driftsweep.plans.run import run_sweep

    key = (app_id(spark), sf, "two_runs")
    if key not in _INBOXES:
        c = table(spark, sf, "customer").orderBy("c_custkey").select(F.col("c_custkey").cast("string").alias("CID"), F.col("c_name").alias("SubscriberKey"))
        s = table(spark, sf, "supplier").orderBy("s_suppkey").select(F.col("s_suppkey").cast("string").alias("CID"), F.col("s_name").alias("SubscriberKey"))
        out = scratch_path(spark, "two_runs_out")
        for run, df in (("run-1", c), ("run-2", s), ("run-2", s)):
            run_sweep(spark, _written(spark, sf, run, {"weekly.csv": df}), out, run)
        _INBOXES[key] = out
    return tables.read_silver(spark, f"{_INBOXES[key]}/silver", with_run=True).select("run_id", "rowid", "file_name", "cid", "subscriberkey")


def gold_pii_absent(spark, sf):
    """Rows of gold, and rows in which any column still holds an e-mail address."""
    g = Sweep.from_fixtures(spark, sf).gold
    return g.groupBy("sourcefile").agg(F.count(F.lit(1)).alias("n_rows"),
                                       F.count_if(F.concat_ws("|", *g.columns).contains("@")).alias("n_with_email"))


def inbox_gates(spark, sf):
    g = Sweep.from_csv_inbox(spark, fixture_inbox(spark, sf, True)).gated
    return g.select("file_name", "n_rows", F.size("headers").alias("n_cols"), "shape_ok", "gate_ok", "accepted")


def last_write_wins(spark, sf):
    """Datasets after the name collision rule: one source per dataset name."""
    ds = Sweep.from_csv_inbox(spark, fixture_inbox(spark, sf, True)).datasets
    return ds.select("file_name", "source", "n_rows")


def csv_lineage(spark, sf):
    sw = Sweep.from_csv_inbox(spark, fixture_inbox(spark, sf, True))
    return sw.silver_rows.groupBy("file_name").agg(F.count(F.lit(1)).alias("n_rows"))


# ---------------------------------------------------------------- sinks (written to the shared scratch folder)


def _silver_written(spark, sf):
    key = (app_id(spark), sf, "silver")
    if key not in _INBOXES:
        path = scratch_path(spark, "silver")
        tables.append_silver(Sweep.from_fixtures(spark, sf).silver, path)
        _INBOXES[key] = path
    return _INBOXES[key]


def silver_typed(spark, sf):
    return tables.typed_silver(Sweep.from_fixtures(spark, sf).silver)


def silver_roundtrip(spark, sf):
    return tables.read_silver(spark, _silver_written(spark, sf))


def partition_read(spark, sf):
    return tables.read_silver(spark, _silver_written(spark, sf), dataset="canon")


def silver_table(spark, sf):
    """Create the silver table by DDL (external, in the scratch folder), append, read back."""
    name = "silver_" + app_id(spark).replace("-", "_").replace(".", "_")
    tables.drop_table(spark, name)
    tables.create_silver_table(spark, name, scratch_path(spark, "silver_tbl"))
    tables.append_silver(Sweep.from_fixtures(spark, sf).silver, table=name)
    return spark.table(name).select(*SILVER_ORDER)


def gold_compact(spark, sf):
    path = scratch_path(spark, "gold")
    tables.write_gold(Sweep.from_fixtures(spark, sf).gold, path)
    return tables.read_gold(spark, path)


# ---------------------------------------------------------------- runs: ledger, quarantine, changed datasets, compaction


def _keyed(df, key, name):
    return df.orderBy(key).select(F.col(key).cast("string").alias("CID"), F.col(name).alias("SubscriberKey"))


def silver_after_failure(spark, sf):
    """Silver after a run that stopped between its silver rows and their record, and the run after it."""
    from driftsweep.plans import ledger
    from driftsweep.plans.run import Run, run_sweep

    key = (app_id(spark), sf, "after_failure")
    if key not in _INBOXES:
        inbox = _written(spark, sf, "failing", {"weekly.csv": _keyed(table(spark, sf, "customer"), "c_custkey", "c_name"),
                                                "other.csv": _keyed(table(spark, sf, "supplier"), "s_suppkey", "s_name")})
        out = scratch_path(spark, "after_failure_out")
        stopped = Run(spark, inbox, out, "run-1")
        stopped.record_status()
        stopped.append_silver()
        run_sweep(spark, inbox, out, "run-2")
        _INBOXES[key] = out
    out = _INBOXES[key]
    rows = tables.read_silver(spark, f"{out}/silver", with_run=True, runs=ledger.committed_runs(spark, out))
    return rows.select("run_id", "file_name", "cid", "subscriberkey")


def quarantine_chunks(spark, sf):
    """What the quarantine keeps of an unreadable export: bytes, lines and a checksum over its lines."""
    from driftsweep.plans.run import Run

    key = (app_id(spark), sf, "quarantine")
    if key not in _INBOXES:
        inbox, out = scratch_path(spark, "bad_inbox"), scratch_path(spark, "bad_out")
        o = table(spark, sf, "orders")
        line = F.concat_ws(",", F.col("o_orderkey").cast("string"), "o_orderstatus", F.when(F.col("o_orderkey") % 7 == 0, F.lit("extra")))
        lines = o.select(F.col("o_orderkey").cast("long").alias("k"), line.alias("value")).union(
            spark.createDataFrame([(-1, "CID,State")], "k long, value string"))
        lines.repartition(1).sortWithinPartitions("k").select("value").write.text(f"{inbox}/overlong.csv")
        _keyed(table(spark, sf, "customer"), "c_custkey", "c_name").write.option("header", "true").csv(f"{inbox}/good.csv")
        run = Run(spark, inbox, out, "run-1")
        run.record_status()
        run.quarantine()
        _INBOXES[key] = out
    held = spark.read.schema("entry string, reason string, path string, offset long, content binary, run_id string").parquet(
        f"{_INBOXES[key]}/quarantine")
    lines = held.select("entry", "reason", "content", F.explode(F.split(F.rtrim(F.col("content").cast("string"), F.lit("\n")), "\n")).alias("line"))
    sums = lines.groupBy("entry", "reason").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.sum(F.conv(F.substring(F.md5(F.col("line").cast("binary")), 1, 8), 16, 10).cast("long")).alias("checksum"))
    sizes = held.groupBy("entry").agg(F.sum(F.octet_length("content")).cast("long").alias("bytes"))
    return sums.join(sizes, "entry").select("entry", "reason", "bytes", "n_lines", "checksum")


def gold_changed(spark, sf):
    """Gold after a second delivery that changed one of two datasets: only that one was rebuilt."""
    from driftsweep.plans.run import run_sweep

    key = (app_id(spark), sf, "gold_changed")
    if key not in _INBOXES:
        out = scratch_path(spark, "gold_changed_out")
        c, s = _keyed(table(spark, sf, "customer"), "c_custkey", "c_name"), _keyed(table(spark, sf, "supplier"), "s_suppkey", "s_name")
        run_sweep(spark, _written(spark, sf, "changed-1", {"weekly.csv": c, "other.csv": s}), out, "run-1")
        run_sweep(spark, _written(spark, sf, "changed-2", {"weekly.csv": s}), out, "run-2")
        _INBOXES[key] = out
    return tables.read_gold(spark, f"{_INBOXES[key]}/gold").select("sourcefile", "cid", "subscriberkey")


def compact_files(spark, sf):
    """Files and rows of a silver table's partitions after its crowded ones were rewritten."""
    from driftsweep.schema import SILVER_SCHEMA

    key = (app_id(spark), sf, "compacted")
    if key not in _INBOXES:
        path = scratch_path(spark, "crowded")
        tables.append_silver(Sweep.from_fixtures(spark, sf).silver.repartition(7), path)
        tables.compact(spark, path, SILVER_SCHEMA, ["file_name"])
        _INBOXES[key] = path
    files = tables.file_sizes(spark, _INBOXES[key]).groupBy("folder").agg(F.count(F.lit(1)).alias("n_files"))
    files = files.select(F.regexp_extract("folder", "file_name=([^/]*)$", 1).alias("file_name"), "n_files")
    rows = tables.read_silver(spark, _INBOXES[key]).groupBy("file_name").agg(F.count(F.lit(1)).alias("n_rows"))
    return rows.join(files, "file_name").select("file_name", "n_files", "n_rows")


def read_success_status(spark, sf):
    """Read-success counter of a swept inbox: its good entries."""
    st = Sweep.from_csv_inbox(spark, fixture_inbox(spark, sf, True)).status
    return st.agg(F.count_if(F.col("status") == "good").alias("n_read"), F.count(F.lit(1)).alias("n_entries"))


def date_day_first(spark, sf):
    """Dates of an export with one day-first and one month-first column: each column is read in its own order."""
    o = table(spark, sf, "orders")
    d = F.col("o_orderdate")
    df = o.select(F.col("o_orderkey").cast("string").alias("CID"), F.date_format(d, "dd/MM/yyyy").alias("CreatedDate"),
                  F.date_format(d, "M/d/yyyy").alias("LastModifiedDate"),
                  F.when(F.col("o_orderkey") % 3 > 0, F.date_format(d, "d/M/yyyy HH:mm")).alias("sentdate"))
    sw = Sweep.from_csv_inbox(spark, _written(spark, sf, "dayfirst", {"dayfirst.csv": df}))
    return sw.silver_rows.select("cid", "createddate", "lastmodifieddate", "sentdate")


def cells_to_records_q(spark, sf):
    """Customers as sheets of long cells, with blank cells and blank rows, put together to records."""
    from driftsweep.operators.records import cells_to_records

    c = table(spark, sf, "customer")
    k = F.col("c_custkey")
    sheet = F.concat(F.lit("S"), (k / 400).cast("int").cast("string"))
    values = F.array(F.col("c_name"), F.when(k % 5 > 0, F.col("c_mktsegment")), F.when(k % 7 == 0, k.cast("string")))
    body = c.where(k % 11 > 0).select(sheet.alias("sheet"), (k % 400 + 2).cast("long").alias("row_no"), F.posexplode(values).alias("col", "value"))
    heads = c.select(sheet.alias("sheet")).distinct().select(
        "sheet", F.lit(1).cast("long").alias("row_no"), F.posexplode(F.array(F.lit("Name"), F.lit("Segment"), F.lit("Key"))).alias("col", "value"))
    r = cells_to_records(body.where("value IS NOT NULL").unionByName(heads), ["sheet"])
    return r.select("sheet", "row_no", F.array_join("headers", "|").alias("headers"), F.array_join("cells", "|", "-").alias("cells"))


# ---------------------------------------------------------------- incremental sweep (Structured Streaming)


def _stream_out(spark, sf):
    key = (app_id(spark), sf, "stream")
    if key not in _INBOXES:
        inbox = scratch_path(spark, "stream_inbox")
        csv_inbox.write_fixture_inbox(spark, sf, inbox)
        out = scratch_path(spark, "stream_out")
        # a few files a time, so that entries of several parts are cut by micro-batches
        sweep_stream.run_available(spark, inbox, out, scratch_path(spark, "stream_ckpt"), max_files_per_trigger=3)
        _INBOXES[key] = out
    return _INBOXES[key]


def stream_sweep(spark, sf):
    return sweep_stream.read_stream_silver(spark, _stream_out(spark, sf)).select("file_name", *TARGETS)


def stream_gold(spark, sf):
    return sweep_stream.read_stream_gold(spark, _stream_out(spark, sf))


def stream_archive(spark, sf):
    """Two runs of the stream over an inbox whose handled entries leave it: what is left, and the silver rows."""
    key = (app_id(spark), sf, "stream_archive")
    if key not in _INBOXES:
        inbox, out, ckpt, archive = (scratch_path(spark, f"archived_{n}") for n in ("inbox", "out", "ckpt", "done"))
        _keyed(table(spark, sf, "customer"), "c_custkey", "c_name").repartition(4).write.option("header", "true").csv(f"{inbox}/weekly.csv")
        sweep_stream.run_available(spark, inbox, out, ckpt, max_files_per_trigger=3, archive=archive)
        _keyed(table(spark, sf, "supplier"), "s_suppkey", "s_name").write.option("header", "true").csv(f"{inbox}/other.csv")
        sweep_stream.run_available(spark, inbox, out, ckpt, max_files_per_trigger=3, archive=archive)
        _INBOXES[key] = f"{inbox}|{out}"
    inbox, out = _INBOXES[key].split("|")
    left = csv_inbox.manifest(spark, inbox).agg(F.count(F.lit(1)).alias("n_left"))
    rows = sweep_stream.read_stream_silver(spark, out).groupBy("file_name").agg(F.count(F.lit(1)).alias("n_rows"))
    return rows.join(F.broadcast(left)).select("file_name", "n_rows", "n_left")   # one row of counts


# ---------------------------------------------------------------- workbooks + CSV in one inbox


def _mixed_inbox(spark, sf):
    key = (app_id(spark), sf, "mixed")
    if key not in _INBOXES:
        from driftsweep.sources.xlsx_writer import write_fixture_workbooks

        inbox = scratch_path(spark, "mixed_inbox")
        csv_layouts = tuple(l for l in fixtures.LAYOUTS if l.fmt == "csv")
        csv_inbox.write_fixture_inbox(spark, sf, inbox, csv_layouts)
        write_fixture_workbooks(spark, sf, inbox)
        _INBOXES[key] = inbox
    return _INBOXES[key]


def xlsx_sweep(spark, sf):
    """Gold from an inbox where upper_S1 is the sheet S1 of upper.xlsx (decoded in tasks)."""
    return Sweep.from_inbox(spark, _mixed_inbox(spark, sf)).gold


def xlsx_cells(spark, sf):
    """Decoded workbook cells in long form (entry, sheet, row, col, value)."""
    from driftsweep.sources.xlsx_inbox import workbook_rows

    rows = workbook_rows(spark, _mixed_inbox(spark, sf))
    return rows.select("entry", "sheet", "row_no", F.posexplode("cells").alias("col", "value")).where("value IS NOT NULL")


def sheet_fanout(spark, sf):
    """One dataset per worksheet of every workbook entry."""
    ds = Sweep.from_inbox(spark, _mixed_inbox(spark, sf)).datasets
    return ds.where("fmt = 'xlsx'").select("file_name", "sheet", "n_rows", F.size("headers").alias("n_cols"))


def silver_union(spark, sf):
    """Silver rows of CSV and workbook datasets in one table (union by name)."""
    return Sweep.from_inbox(spark, _mixed_inbox(spark, sf)).silver_rows.select("file_name", *TARGETS)


def mixed_rowid(spark, sf):
    """Dense rowid over a mixed inbox: workbooks come first in discovery order."""
    return Sweep.from_inbox(spark, _mixed_inbox(spark, sf)).silver.select("rowid", "file_name", "emailaddress")


def registry() -> dict[str, Query]:
    return {
        "gold_harmonise": gold_harmonise,
        "silver_order": silver_order,
        "silver_project": silver_project,
        "resolver": resolver,
        "match_report": match_report,
        "best_header": best_header,
        "non_blank_counts": non_blank_counts,
        "date_normalise": date_normalise,
        "silver_date_rejects": silver_date_rejects,
        "split_name": split_name,
        "fill_cid": fill_cid,
        "rowid": rowid,
        "lineage": lineage,
        "min_shape": min_shape,
        "header_gate": header_gate,
        "sheet_shape": sheet_shape,
        "audit_datasets": audit_datasets,
        "read_success_count": read_success_count,
        "preview": preview,
        "non_blank": non_blank,
        "na_tokens": na_tokens,
        "indel_ratio": indel_ratio_q,
        "score_threshold": score_threshold,
        "clean_header": clean_header_q,
        "date_normalise_mixed": date_normalise_mixed,
        "date_reject_report": date_reject_report,
        "inbox_filter": inbox_filter,
        "dispatch_ext": dispatch_ext,
        "discover_order": discover_order,
        "dataset_name": dataset_name_q,
        "basename": basename_q,
        "run_stamp": run_stamp,
        "csv_sweep": csv_sweep,
        "hot_sweep": hot_sweep,
        "hot_lineage": hot_lineage,
        "csv_silver": csv_silver,
        "probe_status": probe_status,
        "route_good": route_good,
        "route_error": route_error,
        "inbox_manifest": inbox_manifest,
        "inbox_gates": inbox_gates,
        "csv_multiline": csv_multiline,
        "csv_wide": csv_wide,
        "header_repair": header_repair,
        "silver_two_runs": silver_two_runs,
        "gold_pii_absent": gold_pii_absent,
        "csv_lineage": csv_lineage,
        "last_write_wins": last_write_wins,
        "silver_typed": silver_typed,
        "silver_roundtrip": silver_roundtrip,
        "partition_read": partition_read,
        "silver_table": silver_table,
        "gold_compact": gold_compact,
        "stream_sweep": stream_sweep,
        "stream_gold": stream_gold,
        "stream_archive": stream_archive,
        "silver_after_failure": silver_after_failure,
        "quarantine_chunks": quarantine_chunks,
        "gold_changed": gold_changed,
        "compact_files": compact_files,
        "read_success_status": read_success_status,
        "date_day_first": date_day_first,
        "cells_to_records": cells_to_records_q,
        "xlsx_sweep": xlsx_sweep,
        "xlsx_cells": xlsx_cells,
        "mixed_rowid": mixed_rowid,
        "sheet_fanout": sheet_fanout,
        "silver_union": silver_union,
    }
