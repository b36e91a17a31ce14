"""Exact top-k inner products by Fagin's threshold algorithm over sorted per-dimension lists.

Vectors become integers, floor(256 * x) per component. Queries are the rows whose vec_id is
divisible by ``QUERY_EVERY``; candidates are all other rows, also those that repeat the query's vec_id; score is the
integer inner product; a query row's ``K`` highest scores are returned, ties to the smaller vec_id.

Rows are dealt by the hash of their id into candidate blocks and the queries into query blocks, both
of bounded size; each pair of blocks is one group (a stated query set against all rows). In a group
every dimension has its list of rows sorted by value. A query reads all lists in step, from the top
where its component is positive and from the bottom where it is negative; new rows are scored at
once; the threshold is the score of a row that had, in each dimension, the last value read. It
stops when the threshold is under its kth score (equal is not enough: an unseen row could tie with
a smaller id). The groups' top k are ranked per query in a window of K rows a candidate block.

Null vectors and vectors with a null or non-finite component (256 x must be finite, too), or null id, take no part;
vectors of unequal length are padded by zeros; every row counts, repeated rows each for itself, as query and as
candidate; a query with fewer than K candidates returns all; an empty table gives no rows. Products that 53 bits hold are
exact in floating point; beyond, scores and bounds are taken on Python integers. A score beyond a long is
the largest (or smallest) long, such scores tie. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from driftsweep.llm.common import cut, ready

K, QUERY_EVERY, SCALE = 5, 50, 256
CANDIDATE_BLOCK, QUERY_BLOCK = 8192, 1024
FIRST_DEPTH = 64


_LONG = 2**63 - 1


def integers(vectors: DataFrame) -> DataFrame:
    """vec_id, v (whole numbers as doubles, which hold them exactly) and a number for each row that takes part."""
    scaled = F.transform("embedding", lambda e: e.cast("double") * SCALE)
    fine = F.forall(scaled, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) != float("inf")))
    # below 2^52 a double may have a fraction; floor returns a long
    x = F.transform(scaled, lambda e: F.when(F.abs(e) < 2.0**52, F.floor(e).cast("double")).otherwise(e))
    return (vectors.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & fine)
            .select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("v"), F.monotonically_increasing_id().alias("row")))


class Lists:
    """Sorted per-dimension lists of a block of candidates."""

    def __init__(self, ids: np.ndarray, m: np.ndarray, rows: np.ndarray) -> None:
        order = np.argsort(ids, kind="stable")
        self.ids, self.m, self.rows = ids[order], m[order].astype(np.float64), rows[order]
        self.top = float(np.abs(self.m).max()) if self.m.size else 0.0
        self.order = np.argsort(self.m, axis=0, kind="stable")
        self.sorted = np.take_along_axis(self.m, self.order, axis=0)

    def _products(self, m: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Inner products as longs, kept within their range."""
        if len(q) * self.top * (float(np.abs(q).max()) if q.size else 0.0) < 2.0**53:
            return (m @ q).astype(np.int64)
        own = [int(x) for x in q.tolist()]
        exact = (sum(int(x) * y for x, y in zip(r, own, strict=True)) for r in m.tolist())
        return np.array([max(-_LONG, min(_LONG, s)) for s in exact], np.int64)

    def search(self, query_row: int, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Positions and scores of the k best other rows, and the depth at which the lists were left."""
        n = len(self.ids)
        dims = np.flatnonzero(q)
        up = q[dims] > 0
        seen = np.zeros(n, bool)
        own = self.rows == query_row
        best, score = np.zeros(0, np.int64), np.zeros(0, np.int64)
        depth, at = 0, FIRST_DEPTH
        while depth < n:
            at = min(at, n)
            new = ~seen if not len(dims) or at == n else np.zeros(n, bool)
            if len(dims) and at < n:
                new[self.order[n - at:n - depth][:, dims[up]].ravel()] = True
                new[self.order[depth:at][:, dims[~up]].ravel()] = True
                new &= ~seen
            seen |= new
            got = np.flatnonzero(new & ~own)
            best = np.concatenate((best, got))
            score = np.concatenate((score, self._products(self.m[got], q)))
            keep = np.lexsort((best, -score))[:k]  # positions are in id order
            best, score = best[keep], score[keep]
            depth = at
            if len(best) == k and len(dims) and depth < n:
                last = np.where(up, self.sorted[n - depth, dims], self.sorted[depth - 1, dims])
                if self._products(last[None], q[dims])[0] < score[-1]:
                    break
            at *= 2
        return best, score, depth


def top_k(vectors: DataFrame, k: int = K, every: int = QUERY_EVERY) -> DataFrame:
    """query_id, rank, vec_id, score for vectors (vec_id, embedding)."""
    ready(vectors.sparkSession)
    rows = cut(integers(vectors))
    size = rows.agg(F.count("*"), F.count(F.when(F.col("vec_id") % every == 0, 1))).first()
    c, q = max(1, -(-size[0] // CANDIDATE_BLOCK)), max(1, -(-size[1] // QUERY_BLOCK))
    block = lambda n, seed: F.pmod(F.xxhash64("row", F.lit(seed)), F.lit(n))
    every_block = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    queries = rows.filter(F.col("vec_id") % every == 0).select(
        every_block(c).alias("c"), block(q, 1).cast("long").alias("q"), "vec_id", "v", "row")
    # columns of their own: both sides of the cogroup come from the same rows
    own = [F.col(n).alias(n) for n in ("vec_id", "v", "row")]
    candidates = rows.select(block(c, 2).cast("long").alias("c"), *own).select("c", every_block(q).alias("q"), "vec_id", "v", "row")

    def dense(t: pa.Table, width: int) -> np.ndarray:
        out = np.zeros((t.num_rows, width), np.float64)
        for i, v in enumerate(t.column("v").to_pylist()):
            out[i, :len(v)] = v
        return out

    def answer(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if left.num_rows and right.num_rows:
            width = max(len(v) for t in (left, right) for v in t.column("v").to_pylist())
            lists = Lists(right.column("vec_id").to_numpy(), dense(right, width), right.column("row").to_numpy())
            for query, row, x in zip(left.column("vec_id").to_pylist(), left.column("row").to_pylist(), dense(left, width), strict=True):
                best, score, _ = lists.search(row, x, k)
                out += [(query, row, int(lists.ids[b]), int(s)) for b, s in zip(best, score, strict=True)]
        return pa.table({n: pa.array([r[i] for r in out], pa.int64()) for i, n in enumerate(("query_id", "row", "vec_id", "score"))})

    found = (queries.groupBy("c", "q").cogroup(candidates.groupBy("c", "q"))
             .applyInArrow(answer, "query_id long, row long, vec_id long, score long"))
    order = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT a.r, a.vec_id AS query_id, b.vec_id,
         CAST(list_sum([coalesce(p[1], 0) * coalesce(p[2], 0) FOR p IN list_zip(a.v, b.v)]) AS BIGINT) AS score
  FROM d a JOIN d b ON a.vec_id % 50 = 0 AND a.r <> b.r)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 5
"""
