from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from driftsweep.llm import simhash


def plain(text):
    words = (text or "").encode().lower().split()
    parts = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    ones = [0] * 64
    for p in parts:
        h = xxhash.xxh64_intdigest(p, 42)
        for k in range(64):
            ones[k] += h >> k & 1
    return sum((2 * c > len(parts)) << k for k, c in enumerate(ones))


def classes(fps):
    fps = np.array(fps, np.uint64)
    label = np.full(len(fps), -1)
    for i in range(len(fps)):
        todo = [i] if label[i] < 0 else []
        while todo:
            x = todo.pop()
            near = np.flatnonzero((np.bitwise_count(fps ^ fps[x]) <= 3) & (label < 0))
            label[near] = i
            todo += near.tolist()
    return label


def test_fingerprint_uses_the_engine_hash(spark):
    got = spark.range(1).select(F.xxhash64(F.lit("one two three"))).first()[0] % 2**64
    assert got == xxhash.xxh64_intdigest(b"one two three", 42)
    assert simhash.fingerprint("ONE\ttwo\n three".encode()) == got
    assert simhash.fingerprint(b"") == simhash.fingerprint(b" \n\x0b") == 0


def test_every_row_like_brute_force(small):
    rows = small.select("doc_id", "text").collect()
    fps = [plain(r.text) for r in rows]
    label = classes(fps)
    first = {}
    for r, c in zip(rows, label, strict=True):
        if r.doc_id is not None:
            first[c] = min(first.get(c, r.doc_id), r.doc_id)
    want = Counter((r.doc_id, f"{f:016x}", first.get(c)) for r, f, c in zip(rows, fps, label, strict=True))
    assert Counter(map(tuple, simhash.near_duplicates(small).collect())) == want
    kept = simhash.one_of_each(small)
    assert kept.columns == small.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(first.values()) and len(ids) == len(set(label))


@pytest.mark.parametrize("limit", [40, 4096])
def test_dense_cluster_is_whole_with_small_trees(spark, limit, monkeypatch):
    rng = np.random.default_rng(0)
    centre, fps = int(rng.integers(0, 2**62)), set()
    for _ in range(700):
        x = centre
        for b in rng.integers(0, 64, rng.integers(0, 9)):
            x ^= 1 << int(b)
        fps.add(x)
    fps |= {int(x) for x in rng.integers(0, 2**62, 300)}
    fps = np.array(sorted(fps), np.uint64)
    df = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    found = simhash.components(simhash.links(df, limit)).collect()
    label = dict(zip(fps.view(np.int64).tolist(), classes(fps).tolist(), strict=True))
    size = Counter(label.values())
    assert {r.node for r in found} == {f for f, c in label.items() if size[c] > 1}
    assert len({(r.root, label[r.node]) for r in found}) == len({r.root for r in found}) == sum(n > 1 for n in size.values())


def test_tree_links_span_the_classes():
    rng = np.random.default_rng(5)
    fps = np.unique(rng.integers(0, 2**12, 900, dtype=np.uint64) * np.uint64(0x10008004002001))
    links = simhash.tree_links(fps)
    parent = list(range(len(fps)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in links:
        assert np.bitwise_count(fps[a] ^ fps[b]) <= 3
        parent[top(a)] = top(b)
    assert len(links) < len(fps)
    want = classes(fps)
    assert len({(top(i), c) for i, c in enumerate(want)}) == len({top(i) for i in range(len(fps))}) == len(set(want))


def test_long_path_of_links(spark):
    edges = spark.range(300).selectExpr("id as a", "id + 1 as b")
    found = simhash.components(edges).collect()
    assert len(found) == 301 and len({r.root for r in found}) == 1


def test_empty(empty):
    assert simhash.near_duplicates(empty).count() == 0 and simhash.one_of_each(empty).count() == 0


def test_rows_of_a_hot_fingerprint_are_dealt_and_kept(spark):
    rows = [(i if i % 3 else None, "the very same few words here") for i in range(60)] + [(100 + i, f"another text {i} of its own {i * 7}") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = Counter(map(tuple, simhash.near_duplicates(docs).collect()))
    assert sum(want.values()) == 90 and Counter(map(tuple, simhash.near_duplicates(docs, hot_rows=7).collect())) == want
