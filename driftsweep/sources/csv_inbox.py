"""CSV inbox sweep: manifest, readability probe, dataset catalogue, bronze rows.

An inbox *entry* is a top-level item of the inbox folder: a plain ``name.csv`` file or a
folder of part files (what Spark itself writes). A sweep of some entries (one run's new ones, a
stream's changed ones) takes them as a table; nothing is kept per entry on the driver beyond
Spark's own file listing.

Files are read as lines, splittably, at any size and any width:

* pass 0 (``files``) groups the text lines by file: the header line, invalid UTF-8, and
  whether some line leaves a quoted field open;
* the data rows (``rows``) come from a line scan that drops each file's header line. In a
  file without open lines every line is a record;
* lines of files with open lines (their *content* decides, not their size) are put together by
  ``driftsweep.sources.quote_state``, split by split; only these files are read for it, and their
  records are written once to the shared folder;
* a record without quotes is split at its commas; only records with quotes go through the
  pattern that finds quoted fields.

Reader rules that mirror the tabular reader being replaced: header in the first record,
every value text, quote ``"`` doubled to escape, records of blanks only are skipped, a
record with more fields than the header (an empty extra field included) is an error, so
is a quote that is still open at the end of the file (known before any record of the file is
put together). A line break inside quotes is kept as ``\\n``.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftsweep.functions.dates import day_first, slash_votes
from driftsweep.functions.text import dataset_name, extension, na_to_null, non_blank
from driftsweep.operators.joins import join_checked, stored
from driftsweep.operators.rowid import with_dense_index
from driftsweep.schema import INBOX_EXTENSIONS
from driftsweep.sources.quote_state import QUOTED, has_text, opens, put_together

_TYPE_RANK = {".xlsx": 0, ".xls": 1, ".csv": 2}


def qualified(spark: SparkSession, path: str) -> str:
    """Fully qualified form of a folder path, as Spark reports file paths."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.makeQualified(p).toString().rstrip("/")


def _decoded(path_col):
    # file paths are reported as URIs: %-escapes decoded, a literal '+' kept
    return F.url_decode(F.replace(path_col, F.lit("+"), F.lit("%2B")))


def entry_of(path_col, root: str):
    """Top-level inbox item a file belongs to (the file itself or its parent folder)."""
    return F.regexp_extract(_decoded(path_col), "^" + re.escape(root) + "/([^/]+)", 1)


def type_rank(entry):
    """Discovery order: workbooks, old workbooks, CSV; case-sensitive suffixes."""
    r = None
    for ext, k in _TYPE_RANK.items():
        r = F.when(entry.endswith(ext), F.lit(k)) if r is None else r.when(entry.endswith(ext), F.lit(k))
    return r


def top_level_entries(spark: SparkSession, inbox: str) -> DataFrame:
    """Names of the inbox's top-level items (one directory listing, metadata only).

    Needed because Spark's file scans skip zero-byte files, which must still be reported
    (and quarantined) as empty. The listing comes over in one call and is cut up by Spark.
    """
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(inbox)
    statuses = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(p)
    listed = jvm.scala.collection.immutable.ArraySeq.unsafeWrapArray(statuses).mkString("\u0001")
    path = F.regexp_extract("status", "(?s)path=(.*); isDirectory=(?:true|false);", 1)
    return (spark.createDataFrame([(listed,)], "listed string")
            .select(F.explode(F.split("listed", "\u0001")).alias("status"))
            .select(F.regexp_extract(path, "(?s)([^/]*)$", 1).alias("entry")).where("entry <> ''")
            .where(~F.col("entry").startswith(".") & ~F.col("entry").startswith("_")))


def file_states(spark: SparkSession, inbox: str) -> DataFrame:
    """Per entry with files: their number, size and modification times, from the listing."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(inbox)
             .select("path", "length", "modificationTime"))
    return (files.groupBy(entry_of(F.col("path"), qualified(spark, inbox)).alias("entry"))
            .agg(F.count(F.lit(1)).alias("n_parts"), F.sum("length").alias("bytes"),
                 F.max("modificationTime").alias("modified"), F.min("modificationTime").alias("oldest")))


def manifest(spark: SparkSession, inbox: str) -> DataFrame:
    """One row per inbox entry: name, kind, size, part count, latest (``modified``) and earliest
    (``oldest``) modification time of its files, discovery ordinal.

    ``binaryFile`` with only path/length/modificationTime selected lists the (non-empty)
    files without reading their content; the per-entry aggregate is joined to the
    top-level listing so that empty entries are kept with zero parts.
    """
    sized = file_states(spark, inbox)
    listed = top_level_entries(spark, inbox)
    per_entry = (listed.join(sized, "entry", "left")
                 .select("entry", F.coalesce("n_parts", F.lit(0)).alias("n_parts"),
                         F.coalesce("bytes", F.lit(0)).alias("bytes"), "modified", "oldest"))
    allowed = F.exists(F.array(*[F.lit(e) for e in INBOX_EXTENSIONS]), lambda e: F.col("entry").endswith(e))
    ext = extension(F.col("entry"))
    kind = F.when(ext == ".xls", "xls").when(ext == ".xlsx", "xlsx").when(ext == ".csv", "csv").otherwise("other")
    m = per_entry.select("*", allowed.alias("allowed"), ext.alias("ext"), kind.alias("kind"),
                         type_rank(F.col("entry")).alias("type_rank"))
    typed = m.where(F.col("type_rank").isNotNull())
    ranked = with_dense_index(typed, ["type_rank", "entry"], "file_ordinal")
    ranked = ranked.withColumn("file_ordinal", (F.col("file_ordinal") + 1).cast("int"))
    return ranked.unionByName(m.where(F.col("type_rank").isNull()).withColumn("file_ordinal", F.lit(None).cast("int")))


def repair_headers(names: Column) -> Column:
    """Reader header rules on a list of names: blank -> 'Unnamed: i'; repeated names get '.k'.

    The o-th repetition of a name takes the o-th positive number k for which 'name.k' is not
    itself a name of the header; names given by the file come before 'Unnamed' ones.
    """
    blank = lambda x: x.isNull() | (x == "")
    marked = F.transform(names, lambda x, i: F.struct(
        F.when(blank(x), F.concat(F.lit("Unnamed: "), i.cast("string"))).otherwise(x).alias("n"),
        (blank(x).cast("int") * F.size(names) + i).alias("turn")))     # unnamed ones take their turn last
    plain = F.transform(marked, lambda x: x["n"])

    def name(x: Column) -> Column:
        earlier = F.size(F.filter(marked, lambda y: (y["n"] == x["n"]) & (y["turn"] < x["turn"])))
        free = F.filter(F.sequence(F.lit(1), F.size(names) + 1),
                        lambda k: ~F.array_contains(plain, F.concat(x["n"], F.lit("."), k.cast("string"))))
        return F.when(earlier == 0, x["n"]).otherwise(
            F.concat(x["n"], F.lit("."), F.get(free, earlier - 1).cast("string")))
    return F.when(F.size(F.array_distinct(plain)) == F.size(names), plain).otherwise(F.transform(marked, name))


_TOKEN = f"(?s),(?:{QUOTED}[^,]*|[^,]*)"
_CLOSED = '(?s)^,"([^"]*+(?:""[^"]*+)*+)"(.*)$'


def _unquoted(token: Column) -> Column:
    """Text of a field with its leading comma: surrounding quotes removed, doubled quotes undone."""
    inner = F.replace(F.regexp_extract(token, _CLOSED, 1), F.lit('""'), F.lit('"'))
    return (F.when(token.rlike(_CLOSED), F.concat(inner, F.regexp_extract(token, _CLOSED, 2)))
            .otherwise(F.substring(token, 2, 2**31 - 1)))


def fields(record: Column) -> Column:
    """Texts of a record's fields, trailing empty ones included; only records with quotes need the pattern."""
    quoted = F.transform(F.regexp_extract_all(F.concat(F.lit(","), record), F.lit(_TOKEN), F.lit(0)), _unquoted)
    return F.when(F.contains(record, F.lit('"')), quoted).otherwise(F.split(record, ",", -1))


# ---- helpers for rows that still hold their header row (decoded workbook sheets)


def profile_rows(raw: DataFrame) -> DataFrame:
    """Per (entry, part, field position) statistics over rows that include the header row;
    pos -1 counts records. All buffers are fixed-width: a hash (not sort) aggregate.
    ``first_mid`` is the smallest id among rows of the file's first split."""
    marked = F.concat(F.array(F.lit("\u0001")), F.col("cells"))
    x = (raw.select("entry", "part", "_blk", "mid", F.posexplode(marked).alias("p1", "value"))
         .where(F.col("value").isNotNull()))
    v = F.col("value")
    return (x.groupBy("entry", "part", (F.col("p1") - 1).alias("pos"))
            .agg(F.min(F.when(F.col("_blk") == 0, F.col("mid"))).alias("first_mid"),
                 F.count(F.lit(1)).alias("n_present"),
                 F.count_if(non_blank(na_to_null(v))).alias("n_non_blank"),
                 F.count_if(v.contains("\ufffd")).alias("n_bad_text"),
                 *[F.count_if(x).alias(k) for k, x in slash_votes(v).items()]))


def header_cells_rows(raw: DataFrame, profile: DataFrame) -> DataFrame:
    """(entry, part, pos, header_value) of every file's first row. ``raw`` must be the
    DataFrame the profile came from (same ids); an equi-join on (part, id) with one row per
    file keeps only header rows and pushes nothing into the scan."""
    hdr = profile.where("pos = -1").select("part", F.col("first_mid").alias("mid"))
    rows = join_checked(raw.select("entry", "part", "mid", "cells"), hdr, ["part", "mid"])
    return (rows.select("entry", "part", F.posexplode("cells").alias("pos", "header_value"))
            .where(F.col("header_value").isNotNull()))


#: The profile's votes on the order of slash dates.
VOTES = ["n_slash", "n_month_first", "n_day_first"]
#: Up to so many files with open lines are named in their scan's filter, which then opens no other file.
NAMED_FILES = 1000
#: A table of one short row a file is broadcast up to so many rows (and BROADCAST_BYTES).
FILE_ROWS = 250_000


def since(manifest_df: DataFrame) -> str | None:
    """Time before which no file of the manifest's entries was modified (one value), for ``modifiedAfter``."""
    oldest = manifest_df.agg(F.date_format(F.min("oldest") - F.expr("INTERVAL 1 SECOND"), "yyyy-MM-dd'T'HH:mm:ss")).first()[0]
    return oldest


class CsvInbox:
    """Probe + catalogue + bronze for the CSV entries of an inbox folder (see the module docstring).

    ``entries`` (a table with a column ``entry``) restricts the sweep to some top-level items, and
    ``modified_after`` the files that Spark's listing gives to its scans.
    """

    def __init__(self, spark: SparkSession, inbox: str, entries: DataFrame | None = None, modified_after: str | None = None):
        self.spark, self.inbox, self.entries = spark, inbox.rstrip("/"), entries
        self.root = qualified(spark, self.inbox)
        # case-sensitive, like the original discovery
        self.sources = f"{self.inbox}/*.csv"
        self.options = {} if modified_after is None else {
            "modifiedAfter": modified_after, "timeZone": spark.conf.get("spark.sql.session.timeZone")}
        self._files: DataFrame | None = None
        self._several: DataFrame | None = None      # files with open lines: their records, once put together
        self._named: list[str] | None = None         # their paths, if they are few

    # -- pass 0: one row per file -----------------------------------------------------------

    def _lines(self) -> DataFrame:
        return self.spark.read.options(**self.options).text(self.sources).select(
            F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("_blk"),
            F.monotonically_increasing_id().alias("mid"), "value")

    def _put_together(self, paths: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Records of the files in ``paths`` (path, _blk, mid, record; written once), and per file whether a
        quote stays open (path, unclosed)."""
        few = [r.path for r in paths.limit(NAMED_FILES + 1).collect()]
        if len(few) <= NAMED_FILES:
            self._named = few
            lines = self._lines().where(F.col("path").isin(few))   # prunes the scan's files
        else:
            lines = join_checked(self._lines(), paths, ["path"], "left_semi", at_rest=True, max_rows=FILE_ROWS, salt_from=["mid"])
        records, ends = put_together(lines)
        return stored(records, sink="records"), ends

    def files(self) -> DataFrame:
        """Per file: path, entry, part, headers, width, several (records span lines), head (split of the header
        record of such a file), bad_text, unclosed."""
        if self._files is None:
            v = F.col("value")
            first = F.min(F.when(has_text(v), F.struct("_blk", "mid", "value")))
            # collect_set keeps this an object-hash aggregate although a buffer holds text
            agg = self._lines().groupBy("path").agg(
                first.alias("first"), F.collect_set(F.when(opens(v), F.lit(True))).alias("open"),
                F.count_if(~F.is_valid_utf8(v)).alias("n_bad"))
            agg = agg.select("path", entry_of(F.col("path"), self.root).alias("entry"), F.col("first.value").alias("record"),
                             (F.size("open") > 0).alias("several"), (F.col("n_bad") > 0).alias("bad_text"))
            if self.entries is not None:
                agg = agg.join(self.entries.select("entry"), "entry", "left_semi")
            agg = stored(agg)
            several = agg.where("several").select("path")
            if several.isEmpty():
                agg = agg.select("*", F.lit(None).cast("long").alias("head"), F.lit(False).alias("unclosed"))
            else:
                self._several, ends = self._put_together(several)
                place = F.struct("_blk", "mid")
                own = self._several.groupBy("path").agg(F.min_by("record", place).alias("_record"), F.min("_blk").alias("head"))
                agg = (agg.join(own, "path", "left").join(ends, "path", "left")
                       .select("path", "entry", F.coalesce("_record", "record").alias("record"), "several", "bad_text", "head",
                               F.coalesce("unclosed", F.lit(False)).alias("unclosed")))
            agg = agg.where(F.col("record").isNotNull()).withColumn(
                "names", fields(F.regexp_replace("record", "^\ufeff", "")))
            out = agg.select("path", "entry", _decoded(F.col("path")).alias("part"),
                             F.size("names").alias("width"), repair_headers(F.col("names")).alias("headers"),
                             "several", "head", "bad_text", "unclosed")
            self._files = stored(out)
        return self._files

    # -- data rows ----------------------------------------------------------------------------

    def rows(self) -> DataFrame:
        """(path, _blk, mid, cells as written) of every data record. In a file's split the ``mid`` are consecutive."""
        files = self.files()
        # one column per line: no quoting (the quote is a character that text does not hold), a separator that
        # lines rarely hold (a line with it arrives whole in _line); the reader drops each file's first line
        # with text, and lines without text
        lines = (self.spark.read.schema("value string, _line string").options(**self.options).option("header", "true")
                 .option("enforceSchema", "true").option("sep", "\u0001").option("quote", "\ufdd0").option("escape", "")
                 .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_line").csv(self.sources))
        out = lines.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("_blk"),
                           F.monotonically_increasing_id().alias("mid"),
                           F.coalesce("_line", "value").alias("record"))
        by_path = {"on": ["path"], "at_rest": True, "max_rows": FILE_ROWS, "salt_from": ["mid"]}
        if self._several is not None and self._named is not None:
            out = out.where(~F.col("path").isin(self._named))
        if self.entries is not None or (self._several is not None and self._named is None):
            out = join_checked(out, files.where("not several").select("path"), how="left_semi", **by_path)
        if self._several is not None:
            heads = files.where("several").select("path", "head")
            whole = (join_checked(self._several, heads, **by_path).where("not (_blk = head and mid = 1)")
                     .select("path", "_blk", "mid", "record"))
            out = out.unionByName(whole)
        return out.select("path", "_blk", "mid", fields(F.col("record")).alias("cells"))

    # -- pass 1: profile -------------------------------------------------------------------

    def profile(self) -> DataFrame:
        """Per (path, pos): non-blank cells and the votes on slash dates; pos -1 carries the records and the widest record.

        One hash partial aggregate over the exploded fields; a file ships a row per field and task.
        """
        marked = F.concat(F.array(F.lit("\u0001")), F.col("cells"))
        x = self.rows().select("path", F.size("cells").alias("w"), F.posexplode(marked).alias("p1", "value"))
        return (x.groupBy("path", (F.col("p1") - 1).alias("pos"))
                .agg(F.count(F.lit(1)).alias("n_rows"),
                     F.count_if((F.col("p1") > 0) & non_blank(na_to_null(F.col("value")))).alias("n_non_blank"),
                     F.max("w").alias("max_width"),
                     *[F.count_if(v).alias(k) for k, v in slash_votes(F.col("value")).items()]))

    def parts(self, profile: DataFrame) -> DataFrame:
        """Per physical file: headers, data rows, width, overlong / decode / quote flags."""
        per = profile.where("pos = -1").select("path", "n_rows", "max_width")
        return (self.files().join(per, "path", "left")
                .select("path", "entry", "part", F.coalesce("n_rows", F.lit(0)).alias("n_rows"), "width", "headers",
                        (F.coalesce("max_width", F.lit(0)) > F.col("width")).alias("overlong"), "bad_text", "unclosed"))

    def status(self, manifest_df: DataFrame, parts_df: DataFrame) -> DataFrame:
        """Readability per CSV entry: good, or error with a reason (probe S10 + route S12)."""
        per_entry = parts_df.groupBy("entry").agg(
            F.min_by("headers", "part").alias("headers"),
            F.count_distinct("headers").alias("n_header_sets"),
            F.sum("n_rows").alias("n_rows"),
            F.bool_or("overlong").alias("overlong"), F.bool_or("unclosed").alias("unclosed"),
            F.bool_or("bad_text").alias("bad_text"))
        csv = manifest_df.where((F.col("kind") == "csv") & F.col("entry").endswith(".csv"))
        j = csv.join(per_entry, "entry", "left")
        reason = (F.when(F.col("n_rows").isNull(), "empty")
                   .when(F.col("bad_text"), "decode_error")
                   .when(F.col("unclosed"), "unclosed_quote")
                   .when(F.col("overlong"), "overlong")
                   .when(F.col("n_header_sets") > 1, "header_mismatch"))
        return j.select("entry", "file_ordinal", "n_parts", "bytes", "modified",
                        F.when(reason.isNull(), "good").otherwise("error").alias("status"),
                        reason.alias("reason"), F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
                        F.coalesce("headers", F.array().cast("array<string>")).alias("headers"))

    def datasets(self, status_df: DataFrame) -> DataFrame:
        good = status_df.where(F.col("status") == "good")
        return good.select(dataset_name(F.col("entry"), F.lit(None).cast("string")).alias("file_name"),
                           F.col("entry").alias("source"), "file_ordinal", F.lit("csv").alias("fmt"),
                           F.lit(None).cast("string").alias("sheet"), F.col("n_rows").cast("long").alias("n_rows"),
                           "headers")

    def counts(self, profile: DataFrame, datasets_df: DataFrame) -> DataFrame:
        """Non-blank data cells per (dataset, position), and whether its slash dates are day first."""
        c = (profile.where("pos >= 0").join(self.files().select("path", "entry"), "path")
             .groupBy("entry", "pos").agg(F.sum("n_non_blank").alias("n_non_blank"), *[F.sum(k).alias(k) for k in VOTES]))
        return (c.join(datasets_df.select("file_name", F.col("source").alias("entry")), "entry")
                .select("file_name", F.col("entry").alias("source"), "pos", F.col("n_non_blank").cast("long"),
                        day_first(*[F.col(k) for k in VOTES]).alias("day_first")))

    def bronze(self, datasets_df: DataFrame) -> DataFrame:
        """Pass 2: data rows of the datasets, cells as written (the projection applies the missing-value
        tokens to the cells it uses). What belongs to a file is joined from one row per file."""
        per_file = (self.files().select("path", F.col("entry").alias("source"), "part")
                    .join(datasets_df.select("file_name", "source"), "source")
                    .select("path", "file_name", "source", "part"))
        return (join_checked(self.rows(), per_file, ["path"], max_rows=FILE_ROWS, salt_from=["_blk", "mid"])
                .select("file_name", "source", "part", F.col("mid").alias("src_row"), "cells", "_blk"))


def write_fixture_inbox(spark: SparkSession, sf_dir: str, inbox: str, layouts=None) -> str:
    """Write each fixture dataset as a CSV entry (a folder of part files, each with the
    dataset's own drifting header). Workbook layouts are written as ``<dataset>.csv``.

    An entry has a part file a core at most: one for each shuffle partition would make the scans pack by the number
    of files, and the large files of other entries into few tasks."""
    from driftsweep.sources import fixtures

    layouts = fixtures.LAYOUTS if layouts is None else layouts
    rows = fixtures.fixture_rows(spark, sf_dir).persist()
    cores = spark.sparkContext.defaultParallelism
    try:
        for l in layouts:
            name = l.source if l.fmt == "csv" else f"{l.file_name}.csv"
            out = rows.where(F.col("file_name") == l.file_name).select(*[F.col(c).alias(h) for h, c in l.columns])
            (out.coalesce(cores).write.mode("overwrite").option("header", "true").option("escape", '"')
                .csv(f"{inbox.rstrip('/')}/{name}"))
    finally:
        rows.unpersist()
    return inbox


def write_adversarial_entries(spark: SparkSession, sf_dir: str, inbox: str) -> str:
    """Entries that exercise the probe and the gates, each drawn from a driver table:
    overlong rows, a one-column sheet, headers that fail the gate, headers that pass the
    gate but resolve nothing, and a non-CSV file."""
    from driftsweep.sources.fixtures import table

    root = inbox.rstrip("/")
    sup = table(spark, sf_dir, "supplier")
    s = lambda c: F.col(c).cast("string")
    entries = {
        "narrow.csv": table(spark, sf_dir, "part").select(F.col("p_name").alias("FirstName")),
        "gate_fail.csv": sup.select(F.col("s_name").alias("foo"), s("s_acctbal").alias("bar")),
        "email_only.csv": table(spark, sf_dir, "customer").select(
            F.concat(F.lit("u"), s("c_custkey"), F.lit("@example.com")).alias("EmailAddress"),
            F.col("c_mktsegment").alias("notes")),
        "unmatched.csv": table(spark, sf_dir, "orders").select(
            F.col("o_orderstatus").alias("Statement"), F.col("o_orderpriority").alias("Remarks")),
        # both name the dataset 'twin'; the later-discovered entry wins
        "twin.csv": sup.select(F.col("s_name").alias("FirstName"), s("s_suppkey").alias("CID")),
        "twin.csv.csv": table(spark, sf_dir, "part").select(F.col("p_name").alias("FirstName"),
                                                            s("p_partkey").alias("CID")),
    }
    for name, df in entries.items():
        df.write.mode("overwrite").option("header", "true").option("escape", '"').csv(f"{root}/{name}")
    # header "s_name,s_acctbal"; some rows carry a third field (quoting off, so the comma
    # inside the value splits it)
    over = sup.select(F.col("s_name"), F.concat(s("s_acctbal"), F.when(F.col("s_suppkey") % 10 == 0, F.lit(",extra"))
                                                .otherwise(F.lit(""))).alias("s_acctbal"))
    over.write.mode("overwrite").option("header", "true").option("quote", "").csv(f"{root}/overlong.csv")
    sup.select("s_name").write.mode("overwrite").text(f"{root}/notes.txt")
    return inbox


def write_lineitem_entry(spark: SparkSession, sf_dir: str, inbox: str) -> str:
    """The large export (every lineitem row) as one CSV entry of many part files."""
    from driftsweep.sources.fixtures import LINEITEM_LAYOUT, lineitem_rows

    out = lineitem_rows(spark, sf_dir).select(*[F.col(c).alias(h) for h, c in LINEITEM_LAYOUT.columns])
    (out.write.mode("overwrite").option("header", "true").option("escape", '"')
        .csv(f"{inbox.rstrip('/')}/{LINEITEM_LAYOUT.source}"))
    return inbox
