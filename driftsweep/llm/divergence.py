"""Source divergence audit: how far the word frequencies of each source lie from its language's other sources.

Tokenizer. One ``bytes.translate`` lower-cases A-Z and blanks every other ASCII byte that is not a letter
(bytes from 0x80 on stay, so words of any script hold together), ``bytes.split`` cuts the terms, and a
``Counter`` for each document gives its term frequencies; its keys are the document's one vote for the term's
document frequency. Counters are added up in the task, for each (lang, source), until ``HELD`` entries are
held, and Spark sums the sparse rows (lang, source, term, n, docs).

Scores. Each lang keeps the V terms in at least ``min_docs`` of its documents. A group, (lang, source) or the
whole lang, gives a kept term with count c the integer p = 1 + floor(10^9 (c + 2) / (N + 2 V)), N its count over
all kept terms; two groups differ in a term by f = floor((p - q)^2 / (p + q)). A pair's value sums f over all
kept terms, and is put together from sparse rows: a group's absent terms all have the same p, z, so

    sum f = sum over terms of a of f(p, z_b) + sum over terms of b of f(z_a, q) + (V - |a| - |b|) f(z_a, z_b)
            + sum over common terms of f(p, q) - f(p, z_b) - f(z_a, q) + f(z_a, z_b).

The first two sums run over the distinct p of a group, the last over a join of terms whose rows are the sources
of one term and are summed in the same task. The result has a row for each ordered pair of a language's
sources, as the contract asks. All arithmetic is on integers (decimals where 10^9 c could pass a long).

Defined results. Null text, lang and source are ''. Empty texts and texts without a term count as documents and
make their (lang, source) occur; a source alone in its language has no pair row; a language with V = 0 gives pair
values 0 and no term rows. Ties rank by UTF-8 bytes of the item. Repeated rows are documents of their own,
doc_id is not read; very long texts are counted whole by one Counter; an empty table gives no rows; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftsweep.llm.common import cut, ready
from driftsweep.operators.joins import join_checked

MIN_DOCS, TOP, SCALE = 10, 10, 1_000_000_000
#: Entries that a task's counters hold before they are sent on.
HELD = 400_000

_LETTERS = bytes(range(0x41, 0x5B)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
TABLE = bytes(b if b in _LETTERS else 0x20 for b in range(256)).lower()


def terms(text: bytes) -> list[bytes]:
    """Terms of a text, in order."""
    return text.translate(TABLE).split()


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n: dict[tuple[str, str], Counter] = {}
    docs: dict[tuple[str, str], Counter] = {}

    def rows() -> Iterator[pa.RecordBatch]:
        for (lang, source), found in n.items():
            # the row without a term tells that the group occurs
            t, own = [None, *found], docs[lang, source]
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(t), pa.string()), pa.array([source] * len(t), pa.string()), pa.array(t, pa.binary()),
                 pa.array([0, *found.values()], pa.int64()), pa.array([0, *(own[x] for x in found)], pa.int64())],
                ["lang", "source", "term", "n", "docs"])
        n.clear()
        docs.clear()

    for batch in batches:
        text, lang, source = (batch.column(i).to_pylist() for i in range(3))
        for t, group in zip(text, zip(lang, source, strict=True), strict=True):
            found = Counter(terms(t))
            n.setdefault(group, Counter()).update(found)
            docs.setdefault(group, Counter()).update(found.keys())
        if sum(map(len, n.values())) >= HELD:
            yield from rows()
    yield from rows()


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n, docs; a group's row with a null term tells that it occurs."""
    ready(docs.sparkSession)
    plain = docs.select(*[F.coalesce(F.col(c).cast(t), F.lit("").cast(t)).alias(c)
                          for c, t in (("text", "binary"), ("lang", "string"), ("source", "string"))])
    counted = plain.mapInArrow(_count, "lang string, source string, term binary, n long, docs long")
    return (counted.withColumn("term", F.col("term").cast("string")).groupBy("lang", "source", "term")
            .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))


def _share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(10^9 (count + 2) / (total + 2 kept)), exact; null where nothing is kept."""
    big = lambda c: c.cast("decimal(20,0)")
    return F.when(kept > 0, 1 + F.call_function("div", F.lit(SCALE).cast("decimal(10,0)") * big(count + 2), big(total + 2 * kept)))


def _apart(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """lang, source, part (pair or term), item, value, rank."""
    counts = cut(term_counts(docs))
    of_term = Window.partitionBy("lang", "term")
    kept = cut(counts.filter("term IS NOT NULL")
               .withColumns({"all_docs": F.sum("docs").over(of_term), "all_n": F.sum("n").over(of_term)})
               .filter(F.col("all_docs") >= min_docs).select("lang", "source", "term", "n", "all_n"))
    # one row for each group and language
    langs = kept.select("lang", "term", "all_n").distinct().groupBy("lang").agg(F.count("*").alias("v"), F.sum("all_n").alias("lang_n"))
    sizes = kept.groupBy("lang", "source").agg(F.sum("n").alias("group_n"), F.count("*").alias("held"))
    zero = F.lit(0).cast("long")
    groups = (counts.filter("term IS NULL").select("lang", "source").join(sizes, ["lang", "source"], "left").join(langs, "lang", "left")
              .select("lang", "source", *[F.coalesce(c, zero).alias(c) for c in ("group_n", "held", "v", "lang_n")]))
    groups = cut(groups.withColumn("z", _share(zero, F.col("group_n"), F.col("v"))))
    p = cut(join_checked(kept, groups, ["lang", "source"], salt_from=["term"])
            .select("lang", "source", "term", "z", _share(F.col("n"), F.col("group_n"), F.col("v")).alias("p"),
                    _share(F.col("all_n"), F.col("lang_n"), F.col("v")).alias("q")))

    side = lambda df, s, *cols: df.select("lang", *[F.col(c).alias(f"{c}_{s}") for c in ("source", *cols)])
    pairs = side(groups, "a", "z", "held", "v").join(side(groups, "b", "z", "held"), "lang")
    pairs = pairs.filter("source_a <> source_b")
    values = p.groupBy("lang", "source", "p").agg(F.count("*").alias("times"))
    # own terms of a against the absent terms of b
    own = (side(values, "a", "p", "times").join(side(groups, "b", "z"), "lang").filter("source_a <> source_b")
           .groupBy("lang", "source_a", "source_b")
           .agg(F.sum(F.col("times_a") * _apart(F.col("p_a"), F.col("z_b"))).alias("own")))
    pa_, pb, za, zb = (F.col(c) for c in ("p_a", "p_b", "z_a", "z_b"))
    a = p.select("lang", "term", *[F.col(c).alias(f"{c}_a") for c in ("source", "p", "z")])
    b = p.select("lang", "term", *[F.col(c).alias(f"{c}_b") for c in ("source", "p", "z")])
    common = (a.join(b, ["lang", "term"]).filter("source_a < source_b").groupBy("lang", "source_a", "source_b")
              .agg(F.sum(_apart(pa_, pb) - _apart(pa_, zb) - _apart(za, pb) + _apart(za, zb)).alias("both")))
    turned = lambda df, c: df.select("lang", F.col("source_b").alias("source_a"), F.col("source_a").alias("source_b"), F.col(c).alias(f"{c}_t"))
    on = ["lang", "source_a", "source_b"]
    common = cut(common)
    own = cut(own)
    summed = (pairs.join(own, on, "left").join(turned(own, "own"), on, "left")
              .join(common, on, "left").join(turned(common, "both"), on, "left"))
    none = lambda c: F.coalesce(F.col(c), zero)
    absent = F.coalesce((F.col("v_a") - F.col("held_a") - F.col("held_b")) * _apart(za, zb), zero)
    pair = summed.select("lang", F.col("source_a").alias("source"), F.lit("pair").alias("part"), F.col("source_b").alias("item"),
                         (none("own") + none("own_t") + absent + none("both") + none("both_t")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    pair = pair.withColumn("rank", F.row_number().over(order))
    term = (p.filter("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                                     _apart(F.col("p"), F.col("q")).alias("value"))
            .withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top))
    return pair.unionByName(term)


SQL = f"""
WITH d AS (SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
x AS (SELECT k, lang, source, unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS raw FROM d),
t AS (SELECT k, lang, source, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM x),
c AS (SELECT lang, source, term, count(*) AS n FROM t GROUP BY ALL),
kept AS (SELECT lang, term, count(*) AS all_n FROM t GROUP BY ALL HAVING count(DISTINCT k) >= {MIN_DOCS}),
l AS (SELECT lang, count(*) AS v, sum(all_n) AS n FROM kept GROUP BY ALL),
g AS (SELECT DISTINCT lang, source FROM d),
dense AS (SELECT g.lang, g.source, k.term, k.all_n, coalesce(c.n, 0) AS n
          FROM g JOIN kept k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
s AS (SELECT lang, source, sum(n) AS n FROM dense GROUP BY ALL),
p AS (SELECT e.lang, e.source, e.term, e.n, 1 + ({SCALE}::HUGEINT * (e.n + 2)) // (s.n + 2 * l.v) AS p,
             1 + ({SCALE}::HUGEINT * (e.all_n + 2)) // (l.n + 2 * l.v) AS q
      FROM dense e JOIN s ON s.lang = e.lang AND s.source = e.source JOIN l ON l.lang = e.lang),
pv AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
       FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(pv.value, 0) AS BIGINT) AS value
          FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN pv ON pv.lang = a.lang AND pv.source = a.source AND pv.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, CAST(((p - q) * (p - q)) // (p + q) AS BIGINT) AS value
          FROM p WHERE n > 0 AND p > q),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS INTEGER) AS rank
           FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT * FROM ranked WHERE part = 'pair' OR rank <= {TOP}
"""
