"""Files as bytes, in chunks, whatever their size: what the quarantine keeps of unreadable entries.

Files are read splittably as lines that end at ``\\n`` (all other bytes stay as they are, valid text or not),
lines of a split are joined to chunks of about ``CHUNK_BYTES``, and a chunk's offset is the running total of the
chunks before it. Only the given entries' files are opened, and no row holds a whole file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from driftsweep.operators.joins import join_checked, stored
from driftsweep.operators.rowid import running_totals
from driftsweep.sources.csv_inbox import FILE_ROWS, NAMED_FILES, entry_of, qualified

CHUNK_BYTES = 1 << 20
SCHEMA = "entry string, reason string, path string, offset long, content binary"


def chunks(spark: SparkSession, inbox: str, entries: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(entry, reason, path, offset, content) of the files of ``entries`` (entry, reason); their concatenation by offset is
    the file. Empty files have no chunk."""
    root = qualified(spark, inbox)
    listed = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(inbox)
              .select(F.col("_metadata.file_path").alias("path"), F.col("length").alias("_size"))
              .withColumn("entry", entry_of(F.col("path"), root)))
    files = stored(listed.join(entries, "entry"))   # one row a file, no content read
    few = [r.path for r in files.select("path").limit(NAMED_FILES + 1).collect()]
    if not few:
        return spark.createDataFrame([], SCHEMA)
    lines = spark.read.option("recursiveFileLookup", "true").option("lineSep", "\n").text(inbox).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("_blk"),
        F.monotonically_increasing_id().alias("mid"), "value")
    if len(few) <= NAMED_FILES:
        lines = lines.where(F.col("path").isin(few))    # prunes the scan's files
    else:
        lines = join_checked(lines, files.select("path"), ["path"], "left_semi", at_rest=True, max_rows=FILE_ROWS, salt_from=["mid"])
    size = F.octet_length("value") + 1
    w = Window.partitionBy("path", "_blk").orderBy("mid")
    lines = lines.withColumn("_no", F.floor((F.sum(size).over(w) - 1) / chunk_bytes))
    pieces = F.array_sort(F.collect_list(F.struct("mid", "value")))
    parts = lines.groupBy("path", "_blk", "_no").agg(
        F.concat(F.array_join(F.transform(pieces, lambda x: x["value"]), "\n"), F.lit("\n")).cast("binary").alias("content"))
    parts = stored(parts.withColumn("_bytes", F.octet_length("content").cast("long")))
    places = running_totals(parts.select("path", "_blk", "_no", "_bytes"), ["path", "_blk", "_no"], {"_before": "_bytes"})
    first = places.groupBy("path").agg(F.min("_before").alias("_start"))
    places = places.join(first, "path").select("path", "_blk", "_no", (F.col("_before") - F.col("_start")).alias("offset"))
    out = join_checked(parts.join(places, ["path", "_blk", "_no"]), files, ["path"], at_rest=True, max_rows=FILE_ROWS, salt_from=["_blk", "_no"])
    # a file need not end with a line end
    whole = F.col("offset") + F.col("_bytes") <= F.col("_size")
    content = F.when(whole, F.col("content")).otherwise(F.substring("content", 1, (F.col("_bytes") - 1).cast("int")))
    return out.select("entry", "reason", "path", "offset", content.alias("content"))
