"""Medallion plan: bronze + dataset catalogue -> gates -> resolver -> silver -> gold.

``Sweep`` is lazy: every attribute is a DataFrame built on first use. The eager steps all
materialise *small* tables into the shared checkpoint folder: the per-file profile and
header lists of a file inbox (one row per file and column), and the resolver mapping (one
row per dataset) whose row count decides the broadcast.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftsweep.operators import harmonise, quality, resolver
from driftsweep.operators.joins import stored
from driftsweep.operators.rowid import with_dense_index, with_dense_index_by_runs
from driftsweep.sources import csv_inbox, fixtures


class Sweep:
    def __init__(self, bronze, datasets: DataFrame, counts: DataFrame):
        # bronze: a DataFrame (file_name, source, part, src_row, cells array<string>), or a
        # callable that gives one (a file scan)
        self.bronze = bronze
        self.datasets = datasets    # file_name, source, file_ordinal, fmt, sheet, n_rows, headers
        self.counts = counts        # file_name, source, pos, n_non_blank (data rows only)

    @classmethod
    def from_fixtures(cls, spark: SparkSession, sf_dir: str) -> "Sweep":
        bronze = fixtures.persisted_bronze(spark, sf_dir)
        counts = fixtures.fixture_counts(bronze)
        return cls(bronze, fixtures.fixture_datasets(spark, counts), counts.where("pos >= 0"))

    @staticmethod
    def _manifest(spark: SparkSession, inbox: str, entries: DataFrame | None) -> tuple[DataFrame, str | None]:
        """Manifest of all entries or the given ones, and the time their files were modified after (if given)."""
        if entries is None:
            return csv_inbox.manifest(spark, inbox), None
        man = entries
        if "file_ordinal" not in entries.columns:    # names only
            man = stored(csv_inbox.manifest(spark, inbox).join(entries.select("entry"), "entry", "left_semi"))
        return man, csv_inbox.since(man)

    @classmethod
    def from_csv_inbox(cls, spark: SparkSession, inbox: str, entries: DataFrame | None = None) -> "Sweep":
        """Sweep of the CSV entries of an inbox folder, all or those of a table (see sources.csv_inbox)."""
        man, modified_after = cls._manifest(spark, inbox, entries)
        if man.where("kind = 'csv' AND type_rank IS NOT NULL AND n_parts > 0").isEmpty():
            sw = cls.empty(spark)
            sw.manifest = man
            return sw
        ci = csv_inbox.CsvInbox(spark, inbox, entries, modified_after)
        profile = stored(ci.profile())     # hash aggregate; (#files x width) rows
        status = ci.status(man, ci.parts(profile))
        datasets = quality.last_write_wins(ci.datasets(status)).drop("sheet_no")
        sw = cls(lambda: ci.bronze(datasets), datasets, ci.counts(profile, datasets))
        sw.manifest, sw.status = man, status
        return sw

    @classmethod
    def empty(cls, spark: SparkSession) -> "Sweep":
        """A sweep of an empty inbox: every table exists with its schema and has no rows."""
        from driftsweep.schema import BRONZE_SCHEMA, COUNTS_SCHEMA, DATASET_SCHEMA

        bronze = spark.createDataFrame([], BRONZE_SCHEMA)
        datasets = spark.createDataFrame([], DATASET_SCHEMA)
        counts = spark.createDataFrame([], COUNTS_SCHEMA)
        sw = cls(bronze, datasets, counts)
        sw.status = spark.createDataFrame([], "entry string, file_ordinal int, n_parts bigint, bytes bigint, modified timestamp, status string, "
                                              "reason string, n_rows bigint, headers array<string>")
        return sw

    @classmethod
    def from_inbox(cls, spark: SparkSession, inbox: str, entries: DataFrame | None = None) -> "Sweep":
        """Sweep of every CSV and workbook entry of an inbox folder (or of those of a table: the manifest's
        rows, or just a column ``entry``).

        Workbooks are decoded once (``mapInArrow``) into the shared scratch folder; both
        kinds then share the profile -> gates -> resolver -> silver plan.
        """
        from driftsweep.session import scratch_path
        from driftsweep.sources import xlsx_inbox

        man, modified_after = cls._manifest(spark, inbox, entries)
        kinds = {r.kind: r.n for r in man.where("type_rank IS NOT NULL").groupBy("kind")
                 .agg(F.sum(F.greatest("n_parts", F.lit(0))).alias("n")).collect()}   # at most three rows
        ci = csv_inbox.CsvInbox(spark, inbox, entries, modified_after)
        parts, statuses, counts, bronzes = [], [], [], []
        if kinds.get("csv"):
            cprof = stored(ci.profile())
            cparts = ci.parts(cprof)
            cstatus = ci.status(man, cparts)
            parts.append(ci.datasets(cstatus).withColumn("sheet_no", F.lit(0)).withColumn("header_text_ok", F.lit(True)))
            statuses.append(cstatus)
            counts.append(lambda ds, p=cprof: ci.counts(p, ds))
            bronzes.append(ci.bronze)
        if kinds.get("xlsx") or kinds.get("xls"):
            rows_path = scratch_path(spark, "xlsx_rows")
            if kinds.get("xlsx"):
                xlsx_inbox.workbook_rows(spark, inbox, entries, modified_after).write.parquet(rows_path)
                rows = spark.read.parquet(rows_path)
            else:
                rows = spark.createDataFrame([], xlsx_inbox.ROWS_SCHEMA)
            xi = xlsx_inbox.XlsxInbox(spark, rows)
            raw = xi.raw()
            xprof = stored(csv_inbox.profile_rows(raw))
            xhead = stored(csv_inbox.header_cells_rows(raw, xprof))
            sheets = xi.sheets(xprof, xhead, raw)
            xstatus = xi.status(man, sheets)
            parts.append(xi.datasets(sheets, xstatus))
            statuses.append(xstatus)
            counts.append(lambda ds, p=xprof, h=xhead, q=sheets: xi.counts(p, h, q, ds))
            bronzes.append(lambda ds, r=raw, q=sheets: xi.bronze(r, q, ds))
        if not parts:
            sw = cls.empty(spark)     # empty inbox: fixed schemas flow through, no branch later
            sw.manifest, sw.status = man, sw.status
            return sw
        ds = parts[0]
        for p in parts[1:]:
            ds = ds.unionByName(p, allowMissingColumns=True)
        ds = quality.last_write_wins(ds)
        cnt = counts[0](ds)
        for c in counts[1:]:
            cnt = cnt.unionByName(c(ds))

        def brz(ds=ds):
            out = bronzes[0](ds)
            for b in bronzes[1:]:
                out = out.unionByName(b(ds))
            return out
        st = statuses[0]
        for x in statuses[1:]:
            st = st.unionByName(x)
        sw = cls(brz, ds, cnt)
        sw.manifest, sw.status = man, st
        return sw

    @cached_property
    def gated(self) -> DataFrame:
        return quality.with_gates(self.datasets)

    @cached_property
    def accepted(self) -> DataFrame:
        return quality.accepted(self.datasets)

    @cached_property
    def resolution(self) -> dict[str, DataFrame]:
        return resolver.resolve(self.accepted, self.counts)

    @cached_property
    def mapping(self) -> DataFrame:
        return stored(self.resolution["mapping"])

    def bronze_rows(self) -> DataFrame:
        return self.bronze() if callable(self.bronze) else self.bronze

    @cached_property
    def projected(self) -> DataFrame:
        """P1-P3 only (before dates, name split and cid fill)."""
        return harmonise.project_targets(self.bronze_rows(), self.mapping)

    @cached_property
    def silver_rows(self) -> DataFrame:
        return harmonise.fill_cid(harmonise.split_name(harmonise.normalise_dates(self.projected)))

    @cached_property
    def silver(self) -> DataFrame:
        """Silver with a dense rowid in (dataset order, row order).

        Scanned rows are written once and numbered from runs of consecutive scan ids (no data
        shuffle); other sources use the range-partitioned zip-with-index.
        """
        rows = self.silver_rows
        if "_file" in rows.columns:      # data at rest written in row order (fixture bronze)
            ided = with_dense_index_by_runs(rows, ["file_ordinal", "_file", "_blk"], "_mid")
        elif "_blk" in rows.columns:     # scanned files: ids run in file order
            ided = with_dense_index_by_runs(rows, ["file_ordinal", "part", "_blk"], "src_row")
        else:
            ided = with_dense_index(rows, harmonise.ROW_ORDER)
        return harmonise.silver_table(ided)

    @cached_property
    def gold(self) -> DataFrame:
        return harmonise.gold(self.silver_rows)
