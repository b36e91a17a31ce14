"""Long cell tables to records: (sheet, row, col, value) becomes one row per record, as a sheet is read.

The first row of a sheet holds its headers; every later row up to the last one with a cell is a record, rows
without any cell included; a record is as wide as the sheet's widest row, absent cells are NULL. A cell
that is given twice stops the query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftsweep.operators.joins import join_checked, stored


def cells_to_records(cells: DataFrame, keys: list[str], row: str = "row_no", col: str = "col", value: str = "value") -> DataFrame:
    """(keys, row, headers, cells) of every record of every sheet, ``keys`` naming a sheet.

    Rows are put together by (keys, row), so a sheet of any length is spread over all tasks; the gaps between its
    rows come from a sequence, not from a window over the sheet."""
    by_row = cells.groupBy(*keys, row).agg(
        F.map_from_entries(F.collect_list(F.struct(F.col(col).cast("int").alias("k"), F.col(value).alias("v")))).alias("_cells"),
        F.max(F.col(col).cast("int")).alias("_last"))
    by_row = stored(by_row)
    sheets = by_row.groupBy(*keys).agg(F.min(row).alias("_first"), F.max(row).alias("_end"), (F.max("_last") + 1).alias("_width"))
    whole = lambda m: F.transform(F.sequence(F.lit(0), F.col("_width") - 1), lambda i: F.try_element_at(m, i))
    rows_at = by_row.select(*keys, row, "_cells").hint("merge")    # a map for each row: never broadcast, however small its files are
    heads = (sheets.withColumn(row, F.col("_first")).join(rows_at, [*keys, row])
             .select(*keys, "_width", whole(F.col("_cells")).alias("headers")))
    spine = sheets.where("_end > _first").select(*keys, F.explode(F.sequence(F.col("_first") + 1, F.col("_end"))).alias(row))
    rows = spine.join(rows_at, [*keys, row], "left")
    return (join_checked(rows, heads, keys, salt_from=[row])
            .select(*keys, row, "headers", whole(F.col("_cells")).alias("cells")))
