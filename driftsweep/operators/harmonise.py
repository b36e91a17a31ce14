"""Silver and gold projections: resolved copy, dates, name split, cid fill, gold select."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftsweep.functions.dates import month_first_text, normalise_date, parse_date
from driftsweep.functions.text import na_to_null, non_blank, py_split, py_strip
from driftsweep.operators.joins import join_checked
from driftsweep.schema import DATE_TARGETS, GOLD_ORDER, GOLD_UPPER, NAT, SILVER_ORDER, TARGETS

KEY = ["file_name", "source"]
LINEAGE = ["file_name", "source", "file_ordinal", "part", "src_row"]
ROW_ORDER = ["file_ordinal", "part", "src_row"]


def project_targets(bronze: DataFrame, mapping: DataFrame) -> DataFrame:
    """P1/P2/P3: every target from its resolved column ('' for an empty cell) or NULL when
    the dataset has no column for it. Datasets without any resolved target yield no rows.
    ``mapping`` is a stored table.

    The targets' positions are one array a dataset and their values one ``transform`` over it: 33 such
    expressions side by side took nearly three times as long a row.
    """
    from driftsweep.operators.resolver import day_first_col, source_col

    flags = [c for c in map(day_first_col, DATE_TARGETS) if c in mapping.columns]
    positions = mapping.select(*KEY, "file_ordinal", *flags, F.array(*[source_col(t) for t in TARGETS]).alias("_pos"))
    j = join_checked(bronze, positions, KEY, at_rest=True, salt_from=["part", "src_row"])
    cell = lambda src: F.coalesce(na_to_null(F.try_element_at(F.col("cells"), src + 1)), F.lit(""))
    extra = [c for c in ("_file", "_blk", "_mid") if c in bronze.columns] + flags
    values = j.select(*LINEAGE, *extra, F.transform("_pos", lambda src: F.when(src.isNotNull(), cell(src))).alias("_values"))
    return values.select(*LINEAGE, *extra, *[F.get("_values", F.lit(k)).alias(t) for k, t in enumerate(TARGETS)])


def date_text(df: DataFrame, target: str) -> Column:
    """A date target's text, day-first columns turned month first (the order that the accepted forms have)."""
    from driftsweep.operators.resolver import day_first_col

    flag = day_first_col(target)
    return F.when(F.col(flag), month_first_text(F.col(target))).otherwise(F.col(target)) if flag in df.columns else F.col(target)


def normalise_dates(df: DataFrame, targets: list[str] = DATE_TARGETS) -> DataFrame:
    """P5: the date targets become YYYY-MM-DD text, or 'NaT'; one order of slash dates for each column.

    One ``transform`` over the targets' texts, as in ``project_targets``."""
    from driftsweep.operators.resolver import day_first_col

    dates = df.withColumn("_dates", F.transform(F.array(*[date_text(df, t) for t in targets]), normalise_date))
    return (dates.withColumns({t: F.get("_dates", F.lit(k)) for k, t in enumerate(targets)})
            .drop("_dates", *map(day_first_col, targets)))


def date_rejects(df: DataFrame, targets: list[str] = DATE_TARGETS) -> DataFrame:
    """Data-quality report: non-blank date cells that no accepted form parses."""
    long = df.select("file_name", F.explode(F.map_from_arrays(
        F.array(*[F.lit(t) for t in targets]), F.array(*[date_text(df, t) for t in targets]))).alias("target", "value"))
    bad = non_blank(F.col("value")) & parse_date(F.col("value")).isNull()
    return (long.groupBy("file_name", "target")
            .agg(F.count_if(bad).alias("n_rejects"), F.count_if(non_blank(F.col("value"))).alias("n_values"))
            .where(F.col("n_rejects") > 0))


def split_name(df: DataFrame) -> DataFrame:
    """P6: when lastname is NULL and the stripped firstname holds a space, split the full name
    on whitespace: first token -> firstname, the rest joined by one space -> lastname."""
    fn, ln = F.col("firstname"), F.col("lastname")
    parts = py_split(fn)
    cond = ln.isNull() & fn.isNotNull() & py_strip(fn).contains(" ")
    return df.withColumns({
        "firstname": F.when(cond, F.element_at(parts, 1)).otherwise(fn),
        "lastname": F.when(cond, F.array_join(F.slice(parts, 2, F.size(parts) - 1), " ")).otherwise(ln),
    })


def fill_cid(df: DataFrame) -> DataFrame:
    """P7: a NULL cid becomes var1..var4 concatenated without separator, NULLs skipped."""
    return df.withColumn("cid", F.coalesce(F.col("cid"), F.concat_ws("", "var1", "var2", "var3", "var4")))


def silver_table(with_rowid: DataFrame) -> DataFrame:
    """Silver in its fixed 35-column order."""
    return with_rowid.select(*SILVER_ORDER)


def gold(silver: DataFrame) -> DataFrame:
    """K5: business columns only, names upper-cased, 'NaT' -> NULL, file_name -> sourcefile."""
    cols = []
    for c in GOLD_ORDER:
        if c == "sourcefile":
            cols.append(F.col("file_name").alias("sourcefile"))
        elif c in GOLD_UPPER:
            cols.append(F.upper(F.col(c)).alias(c))
        elif c in DATE_TARGETS:
            cols.append(F.when(F.col(c).like(NAT), F.lit(None).cast("string")).otherwise(F.col(c)).alias(c))
        else:
            cols.append(F.col(c))
    return silver.select(*cols)
