"""Workbook (.xlsx) inbox: zip entries to XML elements, everything else as DataFrames.

The only Python in tasks is a small helper that opens a workbook's zip and passes on the text of its XML elements: one row for
each worksheet ``<row>``, each shared string, and each of the small parts (workbook, relationships, styles). They are
stored once. What the elements mean is worked out by column expressions and joins: sheet names by relationship, cells by
reference, shared strings by a size-checked or salted join, number formats by style index. Cached formula results
are read (not formulas), and number cells whose style is a date format become ``YYYY-MM-DD HH:MM:SS`` text, the way
the tabular reader being replaced renders them. Cells are put together to rows by (sheet, row), so a long
sheet is spread over all tasks. Everything after that (header row, counts, gates, resolver, silver) is the
DataFrame plan shared with the CSV sweep.

Opening a workbook is one task (the zip format is not splittable). BIFF ``.xls`` files are not read: they
are quarantined with reason ``unsupported_xls``. Parts are taken as UTF-8; character references beyond those of XML
itself and of line breaks and tabs stay as written.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftsweep.functions.dates import day_first
from driftsweep.functions.text import dataset_name, na_to_null, non_blank
from driftsweep.operators.joins import join_checked, stored
from driftsweep.sources.csv_inbox import VOTES, entry_of, qualified

ROWS_SCHEMA = T.StructType([
    T.StructField("entry", T.StringType()),
    T.StructField("sheet_no", T.IntegerType()),
    T.StructField("sheet", T.StringType()),
    T.StructField("row_no", T.LongType()),
    T.StructField("seq", T.LongType()),
    T.StructField("cells", T.ArrayType(T.StringType())),
    T.StructField("all_text", T.BooleanType()),
    T.StructField("error", T.StringType()),
])

# Built-in number formats that are dates or times (ECMA-376 Part 1, 18.8.30).
_BUILTIN_DATE_IDS = [*range(14, 23), *range(27, 37), 45, 46, 47, *range(50, 59)]

# ---- zip to XML elements (the helper that runs in tasks)

PARTS = "entry string, member string, no long, xml string, error string"
_ELEMENT = {kind: re.compile(rb"<(?:\w+:)?%b(?=[\s>/])(?:[^>]*/>|.*?</(?:\w+:)?%b>)" % (kind, kind), re.DOTALL) for kind in (b"row", b"si")}
_WHOLE = ("xl/workbook.xml", "xl/_rels/workbook.xml.rels", "xl/styles.xml")
_READ = 1 << 20


def _elements(file, pattern: re.Pattern) -> Iterator[bytes]:
    """Elements of a part, read in pieces."""
    held = b""
    while piece := file.read(_READ):
        held += piece
        end = 0
        for m in pattern.finditer(held):
            yield m.group()
            end = m.end()
        held = held[end:]


def _xml_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ("entry", "member", "no", "xml", "error")

    def rows(entry: str, content: bytes) -> Iterator[tuple]:
        try:
            z = zipfile.ZipFile(io.BytesIO(content))
            members = z.namelist()
            for m in _WHOLE[:2]:
                z.getinfo(m)
            for m in members:
                if m in _WHOLE:
                    yield entry, m, 0, z.read(m).decode(), None
                elif m == "xl/sharedStrings.xml" or (m.startswith("xl/") and "worksheets/" in m and m.endswith(".xml")):
                    yield entry, m, -1, None, None     # the part is there
                    with z.open(m) as f:
                        for n, x in enumerate(_elements(f, _ELEMENT[b"si" if m == "xl/sharedStrings.xml" else b"row"])):
                            yield entry, m, n, x.decode(), None
        except Exception as e:  # noqa: BLE001  (unreadable workbook -> quarantine)
            yield entry, None, -1, None, f"unreadable: {type(e).__name__}"

    def batch(held: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if n == "no" else pa.string())
                                           for n, c in zip(names, zip(*held, strict=True), strict=True)], names=list(names))

    for b in batches:
        for entry, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            held: list[tuple] = []
            for r in rows(entry, content):
                held.append(r)
                if len(held) == 4096:
                    yield batch(held)
                    held = []
            if held:
                yield batch(held)


# ---- XML elements to values


def _tags(xml: Column, name: str) -> Column:
    """Start tags of the elements ``name``."""
    return F.regexp_extract_all(xml, F.lit(rf"<(?:\w+:)?{name}(?=[\s>/])[^>]*>"), F.lit(0))


def _attr(tag: Column, name: str) -> Column:
    """Value of an attribute of the first tag, '' if it has none."""
    at = F.regexp_extract(tag, "(?s)^<[^>]*>", 0)
    value = rf"\s(?:\w+:)?{name}\s*=\s*(?:\"([^\"]*)\"|'([^']*)')"
    return _text(F.concat(F.regexp_extract(at, value, 1), F.regexp_extract(at, value, 2)))


def _text(s: Column) -> Column:
    """Character references undone."""
    out = s
    for ref, ch in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&#10;", "\n"), ("&#xA;", "\n"),
                    ("&#13;", "\r"), ("&#xD;", "\r"), ("&#9;", "\t"), ("&#x9;", "\t"), ("&amp;", "&")):
        out = F.replace(out, F.lit(ref), F.lit(ch))
    return F.when(F.contains(s, F.lit("&")), out).otherwise(s)


def _texts(xml: Column) -> Column:
    """Texts of all <t> elements end to end, phonetic runs left out."""
    plain = F.regexp_replace(xml, r"(?s)<(?:\w+:)?rPh[\s>].*?</(?:\w+:)?rPh>", "")
    return _text(F.array_join(F.regexp_extract_all(plain, F.lit(r"<(?:\w+:)?t(?:\s[^>]*)?>([^<]*)</(?:\w+:)?t>"), F.lit(1)), ""))


def _column(ref: Column) -> Column:
    """0-based column of a cell reference such as AB12."""
    letters = F.split(F.upper(F.regexp_extract(ref, "^[A-Za-z]+", 0)), "")
    return F.aggregate(letters, F.lit(0), lambda n, c: F.when(c == "", n).otherwise(n * 26 + F.ascii(c) - 64)) - 1


def _code(tag: Column, name: str) -> Column:
    """Value of an attribute that holds a plain code (reference, type, number), '' if the tag has none."""
    return F.regexp_extract(tag, rf"\s(?:\w+:)?{name}\s*=\s*[\"']([^\"']*)", 1)


def with_number(df: DataFrame, v: str, name: str) -> DataFrame:
    """Column ``name``: the number text ``v`` as the replaced reader renders it, whole values without '.0'.

    Each step is a column of its own, so no expression is repeated in the generated code."""
    x, plain, unscaled = F.col("_x"), F.col("_plain"), F.col("_unscaled")
    out = df.withColumn("_x", F.col(v).try_cast("double")).withColumn("_plain", x.cast("string"))
    # the same shortest digits, exponents only where the replaced reader has them
    out = out.withColumn("_unscaled", plain.try_cast("decimal(38,18)").cast("string"))
    out = out.withColumn("_unscaled", F.regexp_replace(F.regexp_replace(unscaled, r"(\.\d*?)0+$", "$1"), r"\.$", ""))
    power = F.lower(F.regexp_replace(F.regexp_replace(plain, r"\.0E", "E"), r"E-(\d)$", "E-0$1"))
    whole = F.coalesce(x.try_cast("decimal(38,0)").cast("string"), plain)
    size = F.abs(x)
    text = (F.when(~F.col(v).rlike("[.eE]"), F.coalesce(F.col(v).try_cast("decimal(38,0)").cast("string"), F.col(v)))
            .when((size >= 2.0**53) | (F.pmod(x, F.lit(1.0)) == 0), whole)
            .when(size < 1e-4, power).when((size >= 1e7) | (size < 1e-3), unscaled).otherwise(plain))
    return out.withColumn(name, text).drop("_x", "_plain", "_unscaled")


def with_serial(df: DataFrame, v: str, date1904: str, name: str) -> DataFrame:
    """Column ``name``: the date serial ``v`` as text; a part of a day is a time."""
    x, day, ms, second = F.col("_x"), F.col("_day"), F.col("_ms"), F.col("_second")
    out = df.withColumn("_x", F.col(v).try_cast("double")).withColumn("_time", (x >= 0) & (x < 1))
    leap = ~F.col("_time") & ~F.col(date1904) & (x > 0) & (x < 60)    # the 1900 leap-year bug
    out = out.withColumn("_x", F.when(leap, x + 1).otherwise(x)).withColumn("_day", F.floor(x))
    out = out.withColumn("_ms", day * 86_400_000 + F.round((x - day) * 86_400_000).cast("long"))
    out = out.withColumn("_day", F.floor(ms / 86_400_000).cast("int")).withColumn("_ms", F.pmod(ms, F.lit(86_400_000)))
    out = out.withColumn("_second", F.floor(ms / 1000)).withColumn("_ms", F.pmod(ms, F.lit(1000)))
    clock = F.format_string("%02d:%02d:%02d", F.floor(second / 3600), F.pmod(F.floor(second / 60), F.lit(60)), F.pmod(second, F.lit(60)))
    out = out.withColumn("_clock", F.concat(clock, F.when(ms > 0, F.format_string(".%03d000", ms)).otherwise("")))
    base = F.when(F.col(date1904), F.lit("1904-01-01").cast("date")).otherwise(F.lit("1899-12-30").cast("date"))
    text = F.when(F.col("_time") & (day == 0), F.col("_clock")).otherwise(F.concat_ws(" ", F.date_add(base, day).cast("string"), "_clock"))
    return out.withColumn(name, text).drop("_x", "_time", "_day", "_ms", "_second", "_clock")


def _sheets(parts: DataFrame) -> DataFrame:
    """entry, sheet_no, sheet, member, date1904: one row per worksheet."""
    book = parts.where("member = 'xl/workbook.xml'")
    date1904 = _attr(F.get(_tags(F.col("xml"), "workbookPr"), F.lit(0)), "date1904").isin("1", "true")
    sheets = book.select("entry", F.coalesce(date1904, F.lit(False)).alias("date1904"), F.posexplode(_tags(F.col("xml"), "sheet")).alias("sheet_no", "tag"))
    rels = (parts.where("member = 'xl/_rels/workbook.xml.rels'").select("entry", F.explode(_tags(F.col("xml"), "Relationship")).alias("rel"))
            .select("entry", _attr(F.col("rel"), "Id").alias("id"), F.ltrim(_attr(F.col("rel"), "Target"), F.lit("/")).alias("target")))
    member = F.when(F.col("target").startswith("xl/"), F.col("target")).otherwise(F.concat(F.lit("xl/"), F.col("target")))
    return (sheets.select("entry", "date1904", "sheet_no", _attr(F.col("tag"), "name").alias("sheet"), _attr(F.col("tag"), "id").alias("id"))
            .join(rels, ["entry", "id"]).select("entry", "sheet_no", "sheet", member.alias("member"), "date1904"))


def _styles(parts: DataFrame) -> DataFrame:
    """entry, style, is_date: one row per cell style."""
    styles = parts.where("member = 'xl/styles.xml'")
    own = (styles.select("entry", F.explode(_tags(F.col("xml"), "numFmt")).alias("tag"))
           .select("entry", _attr(F.col("tag"), "numFmtId").try_cast("int").alias("fmt"), _attr(F.col("tag"), "formatCode").alias("code")))
    section = F.regexp_extract("xml", r"(?s)<(?:\w+:)?cellXfs[\s>].*?</(?:\w+:)?cellXfs>", 0)
    xfs = (styles.select("entry", F.posexplode(_tags(section, "xf")).alias("style", "tag"))
           .select("entry", "style", F.coalesce(_attr(F.col("tag"), "numFmtId").try_cast("int"), F.lit(0)).alias("fmt")))
    bare = F.regexp_replace("code", r'"[^"]*"|\\.|\[[^\]]*\]', "")     # quoted text, escapes, [colour] etc.
    is_date = bare.rlike("(?i)[dmyhs]") & ~F.contains(bare, F.lit("General"))
    return xfs.join(own, ["entry", "fmt"], "left").select(
        "entry", "style", F.when(F.col("code").isNull(), F.col("fmt").isin(_BUILTIN_DATE_IDS)).otherwise(is_date).alias("is_date"))


def _cells(parts: DataFrame, sheets: DataFrame) -> DataFrame:
    """entry, sheet_no, row_no, col, value, is_text of the cells that hold something."""
    rows = join_checked(parts.where("no >= 0 AND member LIKE 'xl/%worksheets/%'"), sheets, ["entry", "member"], salt_from=["no"])
    tag = rf"(?s)<(?:\w+:)?c(?=[\s>/])(?:[^>]*/>|.*?</(?:\w+:)?c>)"
    cells = rows.select("entry", "sheet_no", "date1904", F.coalesce(_code(F.regexp_extract("xml", "(?s)^<[^>]*>", 0), "r").try_cast("long"), F.col("no") + 1).alias("row_no"),
                        F.posexplode(F.regexp_extract_all("xml", F.lit(tag), F.lit(0))).alias("place", "c"))
    cells = cells.withColumn("tag", F.regexp_extract("c", "(?s)^<[^>]*>", 0))
    cells = cells.withColumns({"ref": _code(F.col("tag"), "r"), "t": _code(F.col("tag"), "t"), "style": _code(F.col("tag"), "s"),
                               "v": F.regexp_extract("c", r"<(?:\w+:)?v(?:\s[^>]*)?>([^<]*)</", 1)})
    cells = cells.select("entry", "sheet_no", "date1904", "row_no", F.when(F.col("ref") == "", F.col("place")).otherwise(_column(F.col("ref"))).alias("col"),
                         F.when(F.col("t") == "", "n").otherwise(F.col("t")).alias("t"),
                         F.coalesce(F.col("style").try_cast("int"), F.lit(0)).alias("style"), _text(F.col("v")).alias("v"),
                         F.when(F.col("t") == "inlineStr", _texts(F.col("c"))).alias("inline"))
    cells = cells.withColumn("at", F.when(F.col("t") == "s", F.col("v").try_cast("long")))
    strings = parts.where("no >= 0 AND member = 'xl/sharedStrings.xml'").select("entry", F.col("no").alias("at"), _texts(F.col("xml")).alias("shared"))
    cells = join_checked(cells, strings, ["entry", "at"], "left", salt_from=["row_no", "col"])
    cells = join_checked(cells, _styles(parts), ["entry", "style"], "left", salt_from=["row_no", "col"])
    cells = with_serial(with_number(cells, "v", "number"), "v", "date1904", "serial")
    t, value, held = F.col("t"), F.col("v"), F.col("v") != ""
    out = (F.when(t == "inlineStr", F.col("inline")).when(~held, None).when(t == "s", F.col("shared")).when(t == "str", value)
           .when(t == "d", F.date_format(value.try_cast("timestamp_ntz"), "yyyy-MM-dd HH:mm:ss"))
           .when(t == "b", F.when(F.trim(value) == "1", "True").otherwise("False")).when(t == "e", None)     # error cells read as missing
           .when(F.coalesce("is_date", F.lit(False)), F.col("serial")).otherwise(F.col("number")))
    return (cells.select("entry", "sheet_no", "row_no", "col", out.alias("value"), t.isin("s", "str", "inlineStr").alias("is_text"))
            .where("value <> ''"))


def sheet_rows(parts: DataFrame) -> DataFrame:
    """Rows of every worksheet (ROWS_SCHEMA) from the stored XML elements; ``seq`` numbers a sheet's rows 0, 1, 2, ...

    Rows run from the first to the last with a value; rows without values stay rows."""
    sheets = stored(_sheets(parts))
    keys = ["entry", "sheet_no", "row_no"]
    by_row = stored(_cells(parts, sheets).groupBy(*keys).agg(
        F.map_from_entries(F.collect_list(F.struct("col", "value"))).alias("held"), (F.max("col") + 1).alias("width"),
        F.bool_and("is_text").alias("all_text")), sink="sheet_rows")
    ends = by_row.groupBy("entry", "sheet_no").agg(F.max("row_no").alias("last"))
    spine = (sheets.join(ends, ["entry", "sheet_no"])
             .select("entry", "sheet_no", "sheet", F.explode(F.sequence(F.lit(1).cast("long"), "last")).alias("row_no")))
    whole = F.transform(F.sequence(F.lit(0), F.col("width") - 1), lambda i: F.try_element_at("held", i))
    # by_row has a map for each row of the inbox: never broadcast, however small its files are
    rows = spine.join(by_row.hint("merge"), keys, "left").select(
        "entry", "sheet_no", "sheet", "row_no", (F.col("row_no") - 1).alias("seq"),
        F.coalesce(whole, F.array().cast("array<string>")).alias("cells"), F.coalesce("all_text", F.lit(True)).alias("all_text"),
        F.lit(None).cast("string").alias("error"))
    there = parts.where("no = -1 AND member IS NOT NULL").select("entry", "member").distinct()
    failed = parts.where("error IS NOT NULL").select("entry", "error").unionByName(
        sheets.join(there, ["entry", "member"], "left_anti").select("entry", F.lit("unreadable sheet: no such part").alias("error")))
    none = lambda kind: F.lit(None).cast(kind)
    return rows.unionByName(failed.select("entry", F.lit(-1).alias("sheet_no"), none("string").alias("sheet"), F.lit(-1).cast("long").alias("row_no"),
                                          F.lit(-1).cast("long").alias("seq"), none("array<string>").alias("cells"), none("boolean").alias("all_text"), "error"))


def workbook_rows(spark: SparkSession, inbox: str, entries: DataFrame | None = None,
                  modified_after: str | None = None) -> DataFrame:
    """Rows of every ``*.xlsx`` entry, or of those of a table with a column ``entry``."""
    from driftsweep.session import ship_package

    ship_package(spark)   # the helper runs in Python workers
    root = qualified(spark, inbox)
    reader = spark.read.format("binaryFile")
    if modified_after is not None:
        reader = reader.option("modifiedAfter", modified_after).option("timeZone", spark.conf.get("spark.sql.session.timeZone"))
    files = reader.load(f"{inbox.rstrip('/')}/*.xlsx").select(entry_of(F.col("path"), root).alias("entry"), "content")
    if entries is not None:
        files = join_checked(files, entries.select("entry"), ["entry"], "left_semi", salt_from=["entry"])
    # a workbook is opened by one task; its elements are dealt over all
    parts = files.mapInArrow(_xml_parts, PARTS).repartition("entry", "member", "no")
    return sheet_rows(stored(parts, sink="workbook_xml"))


class XlsxInbox:
    """Profile, catalogue and bronze for the workbook entries of an inbox.

    The decoded rows are written once to the shared scratch folder (one decode per run);
    every later pass reads that table.
    """

    def __init__(self, spark: SparkSession, rows: DataFrame):
        self.spark = spark
        self.rows = rows.where(F.col("error").isNull())
        self.errors = rows.where(F.col("error").isNotNull()).select("entry", "error").distinct()

    def raw(self) -> DataFrame:
        """Rows in the shape of the row-profile input: one 'part' per sheet, values as decoded
        (no padding)."""
        return self.rows.select("entry", F.concat_ws("!", "entry", F.col("sheet_no").cast("string")).alias("part"),
                                "sheet_no", "sheet", F.lit(0).cast("long").alias("_blk"), F.col("seq").alias("mid"),
                                "all_text", "cells")

    def sheets(self, profile: DataFrame, headers: DataFrame, raw: DataFrame) -> DataFrame:
        """Per sheet: header list (pandas rules: width = widest row), data rows, text header."""
        from driftsweep.sources.csv_inbox import repair_headers

        rec = profile.where("pos = -1").select("entry", "part", F.col("first_mid").alias("hdr_mid"),
                                               F.col("n_present").alias("n_records"))
        f = profile.where("pos >= 0").join(rec, ["entry", "part"]).join(headers, ["entry", "part", "pos"], "left")
        g = f.groupBy("entry", "part", "hdr_mid", "n_records").agg(
            F.max("pos").alias("last_pos"),
            F.map_from_entries(F.collect_list(F.struct("pos", F.col("header_value")))).alias("name_map"))
        width = F.col("last_pos") + 1
        names = F.transform(F.sequence(F.lit(0), width - 1), lambda i: F.element_at(F.col("name_map"), i))
        meta = raw.groupBy("entry", "part").agg(F.first("sheet_no").alias("sheet_no"), F.first("sheet").alias("sheet"),
                                                F.min_by("all_text", "mid").alias("header_text_ok"))
        return (g.join(meta, ["entry", "part"])
                .select("entry", "part", "sheet_no", "sheet", "hdr_mid", "n_records", width.alias("width"),
                        repair_headers(names).alias("headers"), "header_text_ok"))

    def status(self, manifest_df: DataFrame, sheets_df: DataFrame) -> DataFrame:
        """Readability per workbook entry; old-format .xls is not decoded (quarantined)."""
        per = sheets_df.groupBy("entry").agg(F.count(F.lit(1)).alias("n_sheets"),
                                             F.sum(F.col("n_records") - 1).alias("n_rows"))
        err = self.errors.groupBy("entry").agg(F.min("error").alias("error"))
        books = manifest_df.where(F.col("kind").isin("xlsx", "xls") & F.col("type_rank").isin(0, 1))
        j = books.join(per, "entry", "left").join(err, "entry", "left")
        reason = (F.when(F.col("kind") == "xls", "unsupported_xls")
                   .when(F.col("error").isNotNull(), F.col("error"))
                   .when(F.col("n_sheets").isNull(), "empty"))
        return j.select("entry", "file_ordinal", "n_parts", "bytes", "modified",
                        F.when(reason.isNull(), "good").otherwise("error").alias("status"),
                        reason.alias("reason"), F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
                        F.array().cast("array<string>").alias("headers"))

    def datasets(self, sheets_df: DataFrame, status_df: DataFrame) -> DataFrame:
        good = status_df.where(F.col("status") == "good").select("entry", "file_ordinal")
        return (sheets_df.join(good, "entry")
                .select(dataset_name(F.col("entry"), F.col("sheet")).alias("file_name"),
                        F.col("part").alias("source"), "file_ordinal", F.lit("xlsx").alias("fmt"), "sheet",
                        "sheet_no", (F.col("n_records") - 1).cast("long").alias("n_rows"), "headers",
                        "header_text_ok"))

    def counts(self, profile: DataFrame, headers: DataFrame, sheets_df: DataFrame, datasets_df: DataFrame) -> DataFrame:
        hdr = sheets_df.select("entry", "part", "width")
        p = profile.where("pos >= 0").join(hdr, ["entry", "part"]).join(headers, ["entry", "part", "pos"], "left")
        own = F.when(non_blank(na_to_null(F.col("header_value"))), 1).otherwise(0)
        c = (p.where(F.col("pos") < F.col("width"))
             .groupBy("part", "pos").agg(F.sum(F.col("n_non_blank") - own).alias("n_non_blank"), *[F.sum(k).alias(k) for k in VOTES]))
        return (c.join(datasets_df.select("file_name", F.col("source").alias("part")), "part")
                .select("file_name", F.col("part").alias("source"), "pos", F.col("n_non_blank").cast("long"),
                        day_first(*[F.col(k) for k in VOTES]).alias("day_first")))

    def bronze(self, raw: DataFrame, sheets_df: DataFrame, datasets_df: DataFrame) -> DataFrame:
        """Data rows: each sheet's header row removed by a join with one row per sheet."""
        per_sheet = sheets_df.select("part", "hdr_mid").join(
            datasets_df.select("file_name", F.col("source").alias("part")), "part")
        rows = join_checked(raw, per_sheet, ["part"], salt_from=["mid"]).where(F.col("mid") != F.col("hdr_mid"))
        return rows.select("file_name", F.col("part").alias("source"), "part", F.col("mid").alias("src_row"),
                           F.transform("cells", na_to_null).alias("cells"), "_blk")
