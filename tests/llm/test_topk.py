import math
from collections import Counter

import duckdb
import numpy as np

from driftsweep.llm import topk


def brute(rows):
    """Every row is a query or candidate of its own; scores are kept within a long."""
    exact = lambda x: math.floor(256 * x) if abs(x) < 2.0**40 else int(x) * 256
    ok = [(i, tuple(exact(x) for x in v)) for i, v in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    top = 2**63 - 1
    dot = lambda a, b: max(-top, min(top, sum(x * y for x, y in zip(a, b, strict=False))))
    out = Counter()
    for n, (i, v) in enumerate(ok):
        if i % 50 == 0:
            best = sorted((-dot(v, u), j) for m, (j, u) in enumerate(ok) if m != n)[:5]
            out.update((i, k + 1, j, -s) for k, (s, j) in enumerate(best))
    return out


def test_search_stops_early_and_is_exact():
    rng = np.random.default_rng(1)
    for n, width, spread in ((3, 2, 9), (10, 8, 9), (900, 2, 50), (900, 6, 3), (500, 1, 2)):
        m, ids = rng.integers(-spread, spread, (n, width)), rng.permutation(n) * 25
        lists, depths = topk.Lists(ids, m, np.arange(n)), []
        for i in range(n):
            best, score, depth = lists.search(i, m[i].astype(float), 5)
            depths.append(depth)
            want = sorted((-int(m[j] @ m[i]), int(ids[j])) for j in range(n) if j != i)[:5]
            assert [(-int(s), int(lists.ids[b])) for b, s in zip(best, score, strict=True)] == want
        if (n, width) == (900, 2):
            assert np.mean(depths) < 0.3 * n


def test_rows_like_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=4).round(2).tolist()) for i in range(400)]
    rows += [(i, [0.5, -0.25, 0.0, 1.0]) for i in range(400, 500)]  # one common vector
    rows += [(600, None), (650, [None, 1.0, 0.0, 0.0]), (700, [float("nan"), 1.0, 0.0, 0.0]), (750, [float("inf"), 0.0, 0.0, 0.0]),
             (800, [1.0, 2.0]), (850, []), (None, [1.0, 0.0, 0.0, 0.0]), (3, rows[3][1]), (900, [0.0, 0.0, 0.0, 0.0]),
             (50, rows[50][1]), (50, rows[51][1])]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, score string")
    want = brute(rows)
    assert Counter(map(tuple, topk.top_k(df).collect())) == want
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 60)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 4)
    assert Counter(map(tuple, topk.top_k(df).collect())) == want


def test_like_sql(spark):
    path = "/root/testdata/sf0.001/embeddings.parquet"
    got = sorted(map(tuple, topk.top_k(spark.read.parquet(path)).collect()))
    with duckdb.connect() as con:
        con.sql(f"create view embeddings as select * from '{path}'")
        assert sorted(con.sql(topk.SQL).fetchall()) == got


def test_few_rows_and_empty(spark):
    kind = "vec_id long, embedding array<float>"
    assert topk.top_k(spark.createDataFrame([], kind)).count() == 0
    assert topk.top_k(spark.createDataFrame([(0, [1.0])], kind)).count() == 0
    assert [tuple(r) for r in topk.top_k(spark.createDataFrame([(0, [1.0]), (7, [-0.5])], kind)).collect()] == [(0, 1, 7, -32768)]


def test_large_components_are_exact_or_kept_within_a_long(spark):
    rng = np.random.default_rng(5)
    for scale in (1e5, 134217729 / 256, 1e14, 1e300):
        rows = [(i, (scale * x).tolist()) for i, x in enumerate(rng.normal(size=(120, 3)))] + [(300, [1e6, 2.0, 0.25]), (350, [1e14, -1.0, 0.0])]
        df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
        assert Counter(map(tuple, topk.top_k(df).collect())) == brute(rows)
    odd = [(0, [134217729 / 256]), (1, [134217729 / 256]), (2, [1.0])]
    got = topk.top_k(spark.createDataFrame(odd, "vec_id long, embedding array<double>")).collect()
    assert got[0].score == 134217729 * 134217729
