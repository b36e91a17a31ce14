import hashlib
import re
from collections import Counter

import numpy as np
import pytest

from driftsweep.llm import substrings

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, n_words string, batch string, range string"
KNOBS = {"batch_bytes": 20_000, "key_bytes": 5_000, "range_bytes": 5_000}


def brute(rows, length=35):
    docs = [(i, WORD.findall(t or "")) for i, t in rows]
    seen = Counter(tuple(w[k:k + length]) for _, w in docs for k in range(len(w) - length + 1))
    out = []
    for i, w in docs:
        gone = [False] * len(w)
        for k in range(len(w) - length + 1):
            if seen[tuple(w[k:k + length])] > 1:
                gone[k:k + length] = [True] * length
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def got(df, **kw):
    out = substrings.remove_repeated(df, **kw)
    assert out.columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]
    return sorted((tuple(r) for r in out.collect()), key=str)


def test_equals_brute_force_on_the_small_table(small):
    rows = [(r.doc_id, r.text) for r in small.select("doc_id", "text").collect()]
    want = brute(rows)
    assert any(r[2] for r in want) and any(0 < r[2] < r[1] for r in want)
    assert got(small) == want


def planted():
    """Shared passages in own surroundings, near the least length, across line breaks, periodic text, copies."""
    rng = np.random.default_rng(4)
    words = lambda n, v=5000: [f"w{x}" for x in rng.integers(0, v, n)]
    footer, just, short = words(60), words(35), words(34)
    rows = [(i, " ".join(words(rng.integers(0, 80)) + footer + words(rng.integers(0, 80)))) for i in range(150)]
    rows += [(200 + i, "\n".join(words(20) + just + words(20))) for i in range(2)]
    rows += [(210 + i, "\t ".join(words(20) + short + words(20))) for i in range(2)]
    rows += [(220, " ".join(["again"] * 300)), (221, " ".join(["a", "b", "c"] * 40)), (222, " ".join(["x"] * 35)),
             (223, " ".join(["x"] * 35)), (224, " ".join(["y"] * 35))]
    long = words(3000)
    rows += [(300, " ".join(long + words(50) + long[100:200])), (301, " ".join(long[::-1])), (302, " ".join(words(2000, 2)))]
    body = words(120)
    rows += [(400 + i, " ".join(body)) for i in range(40)] + [(500, None), (501, ""), (502, " \n\t"), (None, " ".join(body[5:60]))]
    # one trigger, each context twice: the contexts of a frequent passage repeat themselves
    rows += [(600 + i, " ".join(own + footer)) for k in range(30) for own in [words(40)] for i in (2 * k, 2 * k + 1)]
    return rows + [rows[200]] * 2


@pytest.mark.parametrize("hot", [10, substrings.HOT])
def test_equals_brute_force_on_planted_passages(spark, hot):
    rows = planted()
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA).repartition(4)
    assert got(df, hot=hot, **KNOBS) == brute(rows)


def test_one_batch_or_many_give_the_same(spark):
    rows = planted()[100:]
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA).repartition(3)
    assert got(df, batch_bytes=500, key_bytes=300, range_bytes=300, hot=3) == got(df.coalesce(1)) == brute(rows)


def test_the_catalog_is_left_as_it_was(spark, empty):
    before = len(spark.catalog.listTables())
    assert got(empty) == []
    assert len(spark.catalog.listTables()) == before


def test_words_longer_than_a_hashing_step(spark, monkeypatch):
    monkeypatch.setattr(substrings, "_PIECE", 7)
    monkeypatch.setattr(substrings, "_powers", [])
    data = np.frombuffer(b"ab abcdefghijklmnopqrstuvwxyz ab abcdefghijklmnopqrstuvwxyz abcdefghijklmnopqrstuvwxy abcdefg ab", np.uint8)
    blank = np.concatenate(([True], data == 32, [True]))
    edge = np.flatnonzero(blank[1:] != blank[:-1])
    h = substrings._word_hashes(data, edge[::2], edge[1::2])
    assert h[0] == h[2] == h[6] and len(set(h.tolist())) >= 4


@pytest.mark.parametrize("depth", [1, 2, 5, 35])
def test_index_counts_like_brute_force(depth):
    rng = np.random.default_rng(depth)
    runs = [rng.integers(1, 4, rng.integers(1, 60)) for _ in range(50)]
    index = substrings.FmIndex(np.concatenate([x for r in runs for x in (r, [0])]), depth)
    times = Counter(tuple(r[k:k + depth].tolist()) for r in runs for k in range(len(r) - depth + 1))
    runs.sort(key=len, reverse=True)
    size = np.array([len(r) for r in runs])
    begin = np.cumsum(size) - size
    found = index.matches(np.concatenate(runs), begin, size)
    for r, a in zip(runs, begin, strict=True):
        assert found[a:a + len(r)].tolist() == [times.get(tuple(r[k:k + depth].tolist()), 0) if k + depth <= len(r) else 0
                                               for k in range(len(r))]
