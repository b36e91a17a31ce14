"""Dataset gates and audit tables (minimum shape, header gate, preview, audit listing)."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftsweep.schema import MIN_COLUMNS, MIN_DATA_ROWS, PARTIAL_NAMES


def _partial_pattern(partials: list[str]) -> str:
    return "|".join(re.escape(p) for p in partials)


def min_shape_ok(fmt: Column, n_rows: Column, n_cols: Column) -> Column:
    """Keep iff more than one column and enough data rows for the format
    (CSV counts data rows only, so it needs two; a workbook sheet needs one)."""
    need = F.coalesce(*[F.when(fmt == k, F.lit(v)) for k, v in MIN_DATA_ROWS.items()], F.lit(2))
    return (n_cols >= MIN_COLUMNS) & (n_rows >= need)


def header_gate_ok(headers: Column, partials: list[str] = PARTIAL_NAMES) -> Column:
    """Keep iff some header contains some partial name (case-sensitive substring)."""
    pat = _partial_pattern(partials)
    return F.exists(headers, lambda h: h.rlike(pat))


def with_gates(datasets: DataFrame, partials: list[str] = PARTIAL_NAMES) -> DataFrame:
    """Adds ``shape_ok``, ``gate_ok`` and ``accepted`` to the dataset catalogue."""
    text_ok = F.col("header_text_ok") if "header_text_ok" in datasets.columns else F.lit(True)
    return (datasets
            .withColumn("shape_ok", min_shape_ok(F.col("fmt"), F.col("n_rows"), F.size("headers")))
            .withColumn("gate_ok", text_ok & header_gate_ok(F.col("headers"), partials))
            .withColumn("accepted", F.col("shape_ok") & F.col("gate_ok")))


def accepted(datasets: DataFrame, partials: list[str] = PARTIAL_NAMES) -> DataFrame:
    return with_gates(datasets, partials).where("accepted").drop("shape_ok", "gate_ok", "accepted")


def last_write_wins(datasets: DataFrame) -> DataFrame:
    """When two sources produce the same dataset name, the later-read source wins."""
    w = Window.partitionBy("file_name").orderBy(F.col("file_ordinal").desc(), F.col("sheet_no").desc())
    df = datasets if "sheet_no" in datasets.columns else datasets.withColumn("sheet_no", F.lit(0))
    return df.withColumn("_rk", F.row_number().over(w)).where("_rk = 1").drop("_rk")


def preview(bronze: DataFrame, k: int = 10) -> DataFrame:
    """First ``k`` rows of each dataset, in the order that also numbers its rows.

    ``row_number() <= k`` lets Spark insert a partial WindowGroupLimit before the shuffle,
    so a hot dataset ships at most ``k`` rows per map task.
    """
    w = Window.partitionBy("file_name").orderBy("part", *[c for c in ("_blk",) if c in bronze.columns], "src_row")
    return bronze.withColumn("preview_no", F.row_number().over(w)).where(F.col("preview_no") <= k)


def audit_datasets(datasets: DataFrame) -> DataFrame:
    """Audit listing of the datasets held in bronze."""
    return datasets.select("file_name", "source", "fmt", "n_rows", F.size("headers").alias("n_cols"))
