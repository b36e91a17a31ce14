"""Mixing sources to target weights: capped water-filling, seeded whole and fractional repetitions.

Size of a document: its number of words ``[^\\x20\\x09-\\x0D]+`` (null text: 0). Sources in code point
order, null last, weigh ``WEIGHTS`` repeating and share ``BUDGET`` times the size of all documents.
Water-filling: shares are proportional to the weights; a source above ``MAX_EPOCHS`` times its size
is clamped there and the excess goes to the others by weight, until none is above.

Sampling: a source with target t and size s takes every document floor(t / s) times whole, and the
rest of t from its documents in the order of a seeded hash, the document at the border in part. So
a source's words differ from its target by rounding only, no document goes beyond MAX_EPOCHS
times its size, and reruns agree whatever the partitions.

The border is found from sums over 4096 hash ranges of each source; only the documents of the one
range that holds it are put in order, after equal rows are counted together. So neither a source
nor a group of equal rows meets in one task. Empty and null texts have size 0 and are taken with 0
words (rows of size 0 go with the whole repetitions and with the ranges under the border); sources of
size 0 get target 0; an empty table gives no rows. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftsweep.llm.common import cut, ranked, ready

WEIGHTS, BUDGET, MAX_EPOCHS, SEED = (3, 1, 2), 1.5, 2, "mix-1"
RANGE_DIGITS = 3
#: One row for each source is broadcast up to so many sources; beyond, they are joined by a shuffle.
BROADCAST_SOURCES = 10_000


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def row_key(docs: DataFrame) -> Column:
    """Seeded place of a row in its source: MD5 of the seed, the id, the text and the other columns."""
    other = [c for c in docs.columns if c not in ("doc_id", "text", "source")]
    parts = [F.lit(SEED), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce(F.md5("text"), F.lit(""))]
    if other:
        parts.append(F.to_json(F.struct(*[F.col(f"`{c}`") for c in other])))
    return F.md5(F.concat_ws("|", *parts))


def targets(sizes: DataFrame) -> DataFrame:
    """(source, total) to source, total, target by water-filling; one aggregate for each round."""
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (F.col("rank") % len(WEIGHTS) + 1).cast("int"))
    s = ranked(sizes, F.col("source").isNull(), F.col("source")).withColumn("w", weight.cast("long"))
    cap = F.col("total") * MAX_EPOCHS
    level, last = 0.0, None
    while level != last:
        over = F.col("w") * F.lit(level) > cap
        r = s.agg(F.sum("total"), F.sum(F.when(over, 0).otherwise(F.col("w"))), F.sum(F.when(over, cap).otherwise(0))).first()
        last, level = level, (BUDGET * r[0] - r[2]) / r[1] if r[1] else level
        if last == 0.0 and level == 0.0:
            break
    return s.select("source", "total", F.least(F.col("w") * F.lit(level), cap.cast("double")).alias("target"))


def _border(rows: DataFrame) -> DataFrame:
    """source, total, target, whole, extra, edge, before: how each source is sampled.

    Whole repetitions; the words left; the hash range in which they end; the words in ranges before.
    """
    t = cut(targets(rows.groupBy("source").agg(F.sum("size").alias("total"))))
    t = t.withColumn("whole", F.coalesce(F.floor(F.try_divide("target", "total")), F.lit(0)).cast("long"))
    t = t.withColumn("extra", F.round("target").cast("long") - F.col("whole") * F.col("total"))
    cells = rows.groupBy("source", F.substring("key", 1, RANGE_DIGITS).alias("range")).agg(F.sum("size").alias("n"))
    upto = cells.withColumn("upto", F.sum("n").over(Window.partitionBy("source").orderBy("range")))
    ends = (upto.join(_small(t).select(F.col("source").alias("s"), "extra"), F.col("source").eqNullSafe(F.col("s")))
            .filter((F.col("extra") > 0) & (F.col("upto") >= F.col("extra")))
            .groupBy("source").agg(F.min(F.struct("range", (F.col("upto") - F.col("n")).alias("before"))).alias("e")))
    ends = ends.select(F.col("source").alias("s"), F.col("e.range").alias("edge"), F.col("e.before").alias("before"))
    return cut(t.join(ends, t["source"].eqNullSafe(ends["s"]), "left").drop("s"))


def _small(sources: DataFrame) -> DataFrame:
    """The sources' rows, marked for broadcast if they are few (they are checkpointed: the count is cheap)."""
    return F.broadcast(sources) if sources.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES else sources


def _placed(rows: DataFrame, border: DataFrame) -> tuple[DataFrame, DataFrame, Column]:
    """Rows with their source's sampling; groups of equal rows in the border ranges; words a row takes elsewhere."""
    b = border.withColumnRenamed("source", "__src")
    placed = rows.join(_small(b), rows["source"].eqNullSafe(b["__src"])).drop("__src")
    at = F.substring("key", 1, RANGE_DIGITS)
    inside = placed.filter((at == F.col("edge")) & (F.col("size") > 0))
    order = Window.partitionBy("source").orderBy("key", "size").rowsBetween(Window.unboundedPreceding, -1)
    groups = (inside.groupBy("source", "key", "size", "doc_id", "total", "target", "whole", "extra", "before")
              .agg(F.count("*").alias("n"))
              .withColumn("from", F.col("before") + F.coalesce(F.sum(F.col("n") * F.col("size")).over(order), F.lit(0))))
    elsewhere = placed.filter(F.col("edge").isNull() | (at != F.col("edge")) | (F.col("size") == 0))
    return elsewhere, groups, F.col("whole") + F.coalesce(at < F.col("edge"), F.lit(False)).cast("long")


def mix_plan(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken for every row of docs (doc_id, text, source)."""
    ready(docs.sparkSession)
    docs = docs.select("doc_id", "text", "source")
    rows = cut(docs.select("doc_id", "source", words(F.col("text")).alias("size"), row_key(docs).alias("key")))
    elsewhere, groups, times = _placed(rows, _border(rows))
    nth = groups.withColumn("j", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
    left = F.col("extra") - F.col("from") - F.col("j") * F.col("size")
    part = F.greatest(F.lit(0).cast("long"), F.least(left, F.col("size")))
    name = ["doc_id", "size", F.col("total").alias("source_size"), "target"]
    return (elsewhere.select(*name, (times * F.col("size")).alias("taken"))
            .union(nth.select(*name, (F.col("whole") * F.col("size") + part).alias("taken"))))


def mixed(docs: DataFrame) -> DataFrame:
    """The mix itself: rows of ``docs``, columns as they are, each as often as it is taken.

    The document at a source's border is taken whole if at least half of it is, else not.
    """
    ready(docs.sparkSession)
    own = [F.col(f"`{c}`") for c in docs.columns]
    full = docs.select(F.struct(*own).alias("row"), "doc_id", "source", words(F.col("text")).alias("size"),
                       row_key(docs).alias("key"))
    border = _border(cut(full.select("source", "size", "key")))
    elsewhere, groups, times = _placed(full, border)
    left = F.try_divide(F.col("extra") - F.col("from"), F.col("size"))  # rows of the group that fit, and a part
    copies = F.col("whole") * F.col("n") + F.least(F.greatest(F.round(left), F.lit(0)), F.col("n")).cast("long")
    edges = border.select(F.col("source").alias("__src"), F.col("edge").alias("__edge"))
    once = full.join(_small(edges), F.col("source").eqNullSafe(F.col("__src")))
    once = (once.filter((F.substring("key", 1, RANGE_DIGITS) == F.col("__edge")) & (F.col("size") > 0))
            .groupBy("key", "source").agg(F.first("row").alias("row")))
    sums = groups.select(F.col("key").alias("k"), F.col("source").alias("__s"), copies.alias("copies"))
    edge = (once.join(sums, (F.col("key") == F.col("k")) & F.col("source").eqNullSafe(F.col("__s")))
            .filter("copies > 0").withColumn("i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))))
    rest = (elsewhere.withColumn("copies", times).filter("copies > 0")
            .withColumn("i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))))
    return rest.select("row.*").union(edge.select("row.*"))


SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5('mix-1|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || coalesce(md5(text), '')) AS key
  FROM documents),
s AS (
  SELECT source, total, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS w
  FROM (SELECT source, CAST(sum(size) AS BIGINT) AS total FROM d GROUP BY source)),
c AS (  -- sources in the order in which they are clamped, and the level if those before are
  SELECT *, row_number() OVER o AS k, (1.5 * sum(total) OVER () - coalesce(sum(2 * total) OVER o, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER o, 0)) AS level
  FROM s WINDOW o AS (ORDER BY 2.0 * total / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT arg_min(level, k) FILTER (WHERE w * level <= 2 * total) AS level FROM c),
t AS (
  SELECT source, total, target, CAST(coalesce(floor(target / nullif(total, 0)), 0) AS BIGINT) AS whole
  FROM (SELECT source, total, least(w * CAST(l.level AS DOUBLE), CAST(2 * total AS DOUBLE)) AS target FROM s, l)),
p AS (
  SELECT d.*, t.total, t.target, t.whole, CAST(round(t.target) AS BIGINT) - t.whole * t.total AS extra,
         coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY key, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, total AS source_size, target,
       CAST(whole * size + greatest(0, least(size, extra - before)) AS BIGINT) AS taken
FROM p
"""
