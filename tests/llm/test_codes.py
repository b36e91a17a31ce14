import hashlib
import math

import numpy as np
import pytest

from driftsweep.llm import codes

SCHEMA = "vec_id long, embedding array<double>, label int, code string, part string"


def brute(rows, entries=256, rounds=4):
    """(vec_id, code, error, label_error, digest) by all distances, in Python integers."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    if not kept:
        return []
    dim = -(-max(len(r[1]) for r in kept) // 4) * 4
    d = dim // 4
    exact = lambda x: math.floor(x * 1024) if abs(x) < 2.0**52 else int(x) * 1024
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    vec = [[exact(x) for x in r[1]] + [0] * (dim - len(r[1])) for r in kept]
    parts = [[v[k * d:(k + 1) * d] for v in vec] for k in range(4)]
    books = [[list(x) for x in p[:entries]] for p in parts]
    dist = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    nearest = lambda p, b: [min((dist(x, e), i) for i, e in enumerate(b)) for x in p]
    for _ in range(rounds):
        for k in range(4):
            near = nearest(parts[k], books[k])
            for i in range(len(books[k])):
                own = [x for x, (_, j) in zip(parts[k], near, strict=True) if j == i]
                if own:
                    books[k][i] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    last = [nearest(parts[k], books[k]) for k in range(4)]
    error = [sum(last[k][n][0] for k in range(4)) for n in range(len(kept))]
    fits = lambda x: x if x < 2**63 else None
    by_label = {}
    for r, e in zip(kept, error, strict=True):
        by_label[r[2]] = by_label.get(r[2], 0) + e
    if any(e >= 2**63 for e in error):   # a label with an unknown error has none
        for r, e in zip(kept, error, strict=True):
            if e >= 2**63:
                by_label[r[2]] = 2**63
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((r[0], "".join(f"{last[k][n][1]:02x}" for k in range(4)), fits(error[n]), fits(by_label[r[2]]), sha)
                   for n, r in enumerate(kept)), key=str)


def got(df):
    return sorted((tuple(r) for r in codes.compress(df).collect()), key=str)


@pytest.fixture()
def blocks_of_64(monkeypatch):
    monkeypatch.setattr(codes, "BLOCK_BYTES", 1)


def awkward(n=300, d=8, seed=1):
    rng = np.random.default_rng(seed)
    rows = [(int(i), [round(float(x), 3) for x in rng.normal(0, 0.2, d)], int(i) % 3 or None) for i in rng.permutation(n)]
    rows += [(5, None, 1), (6, [0.1] * (d - 1) + [None], 1), (7, [float("nan")] * d, 1), (8, [float("inf")] + [0.0] * (d - 1), 2)]
    rows += [rows[0]] * 3 + [(rows[1][0], rows[2][1], 2), (None, [0.5] * d, None), (900, [0.25] * (d - 2), 1), (901, [], 1)]
    return rows + [(1000 + i, [0.1] * d, 7) for i in range(400)]   # one group holds half of the rows


def test_equals_brute_force(spark, blocks_of_64):
    rows = awkward()
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(3)
    assert got(df) == brute(rows)


@pytest.mark.parametrize("scale", [3.0, 1e15, 1e300])
def test_large_values(spark, scale):
    rows = [(i, [scale * x if x is not None else None for x in v], lab) for i, v, lab in awkward(60) if v is not None][:70]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    assert got(df) == brute(rows)


def test_fewer_rows_than_entries_and_a_dimension_not_divisible(spark):
    rows = [(i, [0.1 * i, -0.2, 0.3 * i, 0.0, 1.0, i / 7], None) for i in range(5)]
    assert got(spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)) == brute(rows)


def test_whole_nodes_are_assigned_and_ties_go_to_the_lower_index():
    rng = np.random.default_rng(3)
    centres = rng.integers(-1000, 1000, (40, 4))
    x = np.repeat(centres, 100, axis=0) + rng.integers(-3, 4, (4000, 4))
    entries = np.concatenate((centres, centres[:5], centres[:3] + [2, 0, 0, 0]))
    tree = codes.Tree(x, codes.LEAF)
    want = np.argmin(((tree.x[:, None, :] - entries[None]) ** 2).sum(axis=2), axis=1)
    code, off = codes.Codebook(entries).assign(tree.x, True)
    assert (code == want).all() and (off == ((tree.x - entries[want]) ** 2).sum(axis=1)).all()
    used, n, s = codes.Codebook(entries).assign(tree.x, False)
    assert dict(zip(used.tolist(), n.tolist(), strict=True)) == {i: c for i, c in enumerate(np.bincount(want)) if c}
    assert all((s[k] == tree.x[want == e].sum(axis=0)).all() for k, e in enumerate(used))


def test_empty(spark):
    assert got(spark.createDataFrame([], SCHEMA)) == []
    assert got(spark.createDataFrame([(1, None, 1, "x", "y")], SCHEMA)) == []
