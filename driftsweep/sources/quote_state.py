"""Records of CSV files whose quoted fields span lines, put together split by split.

A line maps the state before it (inside a quoted field or not) to the state after it: it sets the state,
flips it, or keeps it. So a whole split is a function of two states, too, and a file's splits compose:

1. in a window over each *split* (never over a file) every line gets the state after it, as far as the split
   alone tells: absolute after a line that sets it, else the number of flips to apply to the split's start;
2. each split becomes one row: its end state, absolute or relative, and its last record start under either
   start state. Running totals over these rows (range partitions, in file order) and equi-joins
   on them give every split its start state and the record that reaches into it;
3. a file that ends inside a quoted field is known by now and is left out;
4. lines that are records are passed on as they are; only lines of records that span lines are grouped, by
   the place of the record's first line. A group is one record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftsweep.operators.joins import join_checked, stored
from driftsweep.operators.rowid import running_totals

# A closed quoted run, and a field up to its comma: quoted (text may follow) or plain.
QUOTED = '"[^"]*+(?:""[^"]*+)*+"'
_FIELD = f'(?:{QUOTED}[^,]*|[^",][^,]*|)'
_OPEN_TAIL = '"[^"]*+(?:""[^"]*+)*+$'
_OPENS = f"(?s)^(?:{_FIELD},)*+{_OPEN_TAIL}"
_STAYS = f'(?s)^[^"]*+(?:""[^"]*+)*+(?:$|"[^,]*,(?:{_FIELD},)*+{_OPEN_TAIL})'


def opens(line: Column) -> Column:
    """A line that begins outside quotes ends inside a quoted field."""
    return F.contains(line, F.lit('"')) & line.rlike(_OPENS)


def stays(line: Column) -> Column:
    """A line that begins inside a quoted field ends inside one."""
    return line.rlike(_STAYS)


def has_text(line: Column) -> Column:
    """Some character beyond blanks and control characters (other records are skipped)."""
    return line.rlike("[^\\x00-\\x20]")


def _odd(n: Column) -> Column:
    return n % 2 == 1


def _under(absolute: Column, odd: Column, start: bool) -> Column:
    """State under a start state: the absolute one, else the start, flipped if ``odd``."""
    return F.coalesce(absolute, ~odd if start else odd)


def marked_lines(lines: DataFrame) -> DataFrame:
    """Lines (path, _blk, mid, value) with, from their split alone, for start states s = 0 and 1: ``new_s`` (a record
    begins here), ``after_s`` (state after the line), ``from_s`` (mid of the last record start up to here), ``n_s`` (records
    with text begun up to here); and ``after`` (the absolute state or null) with ``odd`` (flips otherwise)."""
    w = Window.partitionBy("path", "_blk").orderBy("mid")
    v = F.col("value")
    out = lines.withColumns({"_a": opens(v), "_b": stays(v), "_text": has_text(v)})
    sets = F.col("_a") == F.col("_b")
    out = out.withColumn("_flips", F.sum((F.col("_a") & ~F.col("_b")).cast("int")).over(w))
    out = out.withColumns({"after": F.last(F.when(sets, F.col("_a")), True).over(w),
                           "_then": F.last(F.when(sets, F.col("_flips")), True).over(w)})
    flipped = _odd(F.col("_flips") - F.col("_then"))
    out = out.withColumns({"after": F.when(F.col("_then").isNotNull(), F.col("after") != flipped), "odd": _odd(F.col("_flips"))})
    first = F.lag("mid").over(w).isNull()
    before, odd = F.lag("after").over(w), F.coalesce(F.lag("odd").over(w), F.lit(False))
    out = out.withColumns({"_before": F.when(~first, before), "_odd": odd})
    for s in (0, 1):
        out = out.withColumns({f"new_{s}": ~_under(F.col("_before"), F.col("_odd"), bool(s)),
                               f"after_{s}": _under(F.col("after"), F.col("odd"), bool(s))})
    for s in (0, 1):
        new = F.col(f"new_{s}")
        out = out.withColumns({f"from_{s}": F.last(F.when(new, F.col("mid")), True).over(w),
                               f"n_{s}": F.sum((new & (F.col(f"after_{s}") | F.col("_text"))).cast("long")).over(w)})
    return out.drop("_a", "_b", "_flips", "_then", "_before", "_odd")


def split_starts(marked: DataFrame) -> DataFrame:
    """One row a split: path, _blk, ``start`` (state before it), ``end`` (after it), ``at_blk`` and ``at_mid`` (first line of
    the record that reaches into it; null for a file's first split)."""
    at_end = F.max_by(F.struct("after", "odd", "from_0", "from_1"), "mid").alias("e")
    splits = marked.groupBy("path", "_blk").agg(at_end)
    firsts = splits.groupBy("path").agg(F.min("_blk").alias("_blk")).withColumn("first", F.lit(True))
    splits = splits.join(firsts, ["path", "_blk"], "left").select(
        "path", "_blk", F.coalesce("first", F.lit(False)).alias("first"), F.col("e.after").alias("after"), F.col("e.odd").alias("odd"),
        F.col("e.from_0").alias("from_0"), F.col("e.from_1").alias("from_1"))
    # a file's first split starts outside quotes, so its end is absolute
    known = F.col("first") | F.col("after").isNotNull()
    splits = splits.withColumns({"_set": known.cast("long"), "_flip": (~known & F.col("odd")).cast("long")})
    splits = stored(running_totals(splits, ["path", "_blk"], {"sets": "_set", "flips": "_flip"}))
    base = splits.where("_set = 1").select((F.col("sets") + 1).alias("sets"), F.coalesce("after", "odd").alias("_base"),
                                           F.col("flips").alias("_then"))
    start = F.when(F.col("first"), F.lit(False)).otherwise(F.col("_base") != _odd(F.col("flips") - F.col("_then")))
    splits = splits.join(base, "sets", "left").withColumn("start", start)
    splits = splits.withColumns({"end": F.coalesce("after", F.col("start") != F.col("odd")),
                                 "_from": F.when(F.col("start"), F.col("from_1")).otherwise(F.col("from_0"))})
    splits = splits.withColumn("_has", F.col("_from").isNotNull().cast("long"))
    splits = stored(running_totals(splits, ["path", "_blk"], {"begun": "_has"}))
    # the first split of a file has a record start, so the last one before a later split lies in the same file
    held = splits.where("_has = 1").select((F.col("begun") + 1).alias("begun"), F.col("_blk").alias("at_blk"), F.col("_from").alias("at_mid"))
    return splits.join(held, "begun", "left").select(
        "path", "_blk", "start", "end", F.when(~F.col("first"), F.col("at_blk")).alias("at_blk"),
        F.when(~F.col("first"), F.col("at_mid")).alias("at_mid"))


def put_together(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Records with text of files that end outside quotes: (path, _blk, mid, record), where a split's ``mid`` are 1, 2, ...;
    and for every file (path, unclosed)."""
    marked = stored(marked_lines(lines), sink="lines")
    starts = stored(split_starts(marked))
    ends = stored(starts.groupBy("path").agg(F.max_by("end", "_blk").alias("unclosed")))
    closed = starts.join(ends.where("not unclosed").select("path"), "path", "left_semi")
    known = join_checked(marked, closed.drop("end"), ["path", "_blk"], salt_from=["mid"])
    pick = lambda c: F.when(F.col("start"), F.col(f"{c}_1")).otherwise(F.col(f"{c}_0"))
    known = known.select("path", "_blk", "mid", "value", "at_blk", "at_mid", "_text",
                         *[pick(c).alias(c) for c in ("new", "after", "from", "n")])
    single = known.where("new and not after and _text").select("path", "_blk", F.col("n").alias("mid"), F.col("value").alias("record"))
    own = F.col("from").isNotNull()
    pieces = F.array_sort(F.collect_list(F.struct("_blk", "mid", "value")))
    several = (known.where("not new or after")
               .groupBy("path", F.when(own, F.col("_blk")).otherwise(F.col("at_blk")).alias("k_blk"),
                        F.when(own, F.col("from")).otherwise(F.col("at_mid")).alias("k_mid"))
               .agg(F.array_join(F.transform(pieces, lambda x: x["value"]), "\n").alias("record"),
                    F.max(F.when(F.col("new"), F.col("n"))).alias("mid"))
               .select("path", F.col("k_blk").alias("_blk"), "mid", "record"))
    return single.unionByName(several), ends
