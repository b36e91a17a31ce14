from collections import Counter, defaultdict

import duckdb

from driftsweep.llm import mixing


def water_fill(sizes):
    """source -> target by the rule itself; sources in order, null last."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(order)}
    left, out = 1.5 * sum(sizes.values()), {}
    while len(out) < len(order):
        free = [s for s in order if s not in out]
        share = left / sum(w[s] for s in free)
        over = [s for s in free if w[s] * share > 2 * sizes[s]]
        for s in over:
            out[s] = 2.0 * sizes[s]
            left -= out[s]
        if not over:
            out |= {s: w[s] * share for s in free}
    return out


def words(text):
    return len((text or "").encode().split())


def test_targets_taken_and_limits(small):
    rows = small.collect()
    sizes = defaultdict(int)
    for r in rows:
        sizes[r.source] += words(r.text)
    want = water_fill(sizes)
    plan = mixing.mix_plan(small).collect()
    assert Counter((r.doc_id, r.size) for r in plan) == Counter((r.doc_id, words(r.text)) for r in rows)
    source = {(r.doc_id, words(r.text)): r.source for r in rows}
    taken = defaultdict(int)
    for r in plan:
        s = source[r.doc_id, r.size]
        assert abs(r.target - want[s]) < 1e-6 and r.source_size == sizes[s] and 0 <= r.taken <= 2 * r.size
        taken[s] += r.taken
    assert all(abs(taken[s] - want[s]) <= 1 for s in sizes)
    assert Counter(map(tuple, mixing.mix_plan(small.repartition(5)).collect())) == Counter(map(tuple, plan))


def test_like_sql(spark):
    path = "/root/testdata/sf0.001/documents.parquet"
    got = sorted(map(tuple, mixing.mix_plan(spark.read.parquet(path)).collect()))
    with duckdb.connect() as con:
        con.sql(f"create view documents as select * from '{path}'")
        assert sorted(con.sql(mixing.SQL).fetchall()) == got


def test_hot_copies_at_the_border(spark):
    docs = [(1, "a b c d", "s")] * 300 + [(i, "x " * (i % 7), "s") for i in range(2, 200)] + [(500, "q " * 3000, "t"), (501, "z", "u")]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    plan = mixing.mix_plan(df).collect()
    assert len(plan) == len(docs) and all(0 <= r.taken <= 2 * r.size for r in plan)
    total = defaultdict(int)
    for r in plan:
        total[r.target] += r.taken
    assert all(abs(t - n) <= 1 for t, n in total.items())
    out = mixing.mixed(df).collect()
    copies = Counter(r.doc_id for r in out)
    assert copies[1] <= 600 and all(copies[i] <= 2 for i in copies if i != 1)
    for s, sizes in (("s", [4] * 300 + [i % 7 for i in range(2, 200)]),):
        target = next(r.target for r in plan if r.doc_id == 1)
        assert abs(sum(words(r.text) for r in out if r.source == s) - target) <= max(sizes)


def test_mix_keeps_rows_as_they_are(small, empty):
    out = mixing.mixed(small)
    assert out.columns == small.columns
    have = Counter(map(str, small.collect()))
    got = Counter(map(str, out.collect()))
    assert set(got) <= set(have) and all(n <= 2 * have[r] for r, n in got.items())
    assert mixing.mixed(empty).count() == 0 and mixing.mix_plan(empty).count() == 0


def test_no_python_in_the_plan(small):
    plan = mixing.mix_plan(small)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
