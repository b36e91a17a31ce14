import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from driftsweep.llm import repeats

AWKWARD = [(None, None), (5000, ""), (5001, "a" * 300), (5002, "a" * 120 + "b"), (5003, "ab" * 200), (5004, "ab" * 90), (5004, "ab" * 90),
           (None, "ab" * 99), (5005, "é" * 400), (5006, "x" * 49), (5007, "x" * 50), (5008, "x" * 51), (4999, "x" * 50)]


def brute(rows):
    enc = [(2**63 - 1 if i is None else i, (t or "").encode()) for i, t in rows]
    first = {}
    for i, b in enc:
        for k in range(len(b) - 49):
            first[b[k:k + 50]] = min(i, first.get(b[k:k + 50], 2**64))
    out = Counter()
    for (doc, _), (i, b) in zip(rows, enc, strict=True):
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - 49):
            if first[b[k:k + 50]] < i:
                gone[k:k + 50] = True
        spans = int((gone & ~np.concatenate(([False], gone[:-1]))).sum()) if len(b) else 0
        out[doc, len(b), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest()] += 1
    return out


@pytest.mark.parametrize("sizes", [{}, {"batch_bytes": 20_000, "range_bytes": 9000}])
def test_every_document_like_brute_force(spark, small, sizes):
    docs = small.select("doc_id", "text").filter("doc_id is null or doc_id < 60 or doc_id > 80000")
    docs = docs.union(spark.createDataFrame(AWKWARD, "doc_id long, text string"))
    got = Counter(map(tuple, repeats.remove_repeats(docs, **sizes).collect()))
    assert got == brute([tuple(r) for r in docs.collect()])


def test_random_overlaps_over_many_batches(spark):
    rng = np.random.default_rng(2)
    pool = "".join(chr(97 + x) for x in rng.integers(0, 3, 900))
    rows = []
    for i in rng.permutation(80).tolist():
        cuts = [pool[a:a + n] for a, n in zip(rng.integers(0, 800, 5).tolist(), rng.integers(30, 120, 5).tolist(), strict=True)]
        rows.append((i, "".join(cuts)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert Counter(map(tuple, repeats.remove_repeats(df, batch_bytes=1500, range_bytes=700).collect())) == brute(rows)


def test_text_longer_than_a_piece(spark):
    rng = np.random.default_rng(3)
    long = "".join(chr(97 + x) for x in rng.integers(0, 26, 2_300_000))
    rows = [(1, long), (2, "0" * 60 + long[1_048_000:1_049_500] + "1" * 10), (3, long[2_299_960:])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in repeats.remove_repeats(df).collect()}
    assert got[1].n_removed == 0 and (got[2].n_removed, got[2].n_spans) == (1500, 1) and got[3].n_removed == 0


def test_suffix_array_orders_all_strings():
    rng = np.random.default_rng(4)
    text = rng.integers(0, 2, 4000).astype(np.uint8) * 200
    starts = np.arange(len(text) - 49)
    order, new = repeats.string_order(text, starts)
    strings = [text[s:s + 50].tobytes() for s in starts[order]]
    assert strings == sorted(strings) and new.sum() == len(set(strings))


def test_empty(empty):
    assert repeats.remove_repeats(empty).count() == 0


def around_one_passage(n, passage=60, seed=5):
    rng = np.random.default_rng(seed)
    word = lambda k: "".join(chr(97 + x) for x in rng.integers(0, 26, k))
    shared = word(passage)
    return [(i, word(80) + shared + word(80)) for i in range(n)]


def group(tables, key):
    rows = pa.concat_tables(tables)
    return [rows.filter(pc.equal(rows[key], k)) for k in sorted(set(rows[key].to_pylist()))]


def test_no_range_gets_all_strings_at_the_edge_of_a_shared_passage():
    docs, bits = around_one_passage(2000), 6
    batches = [pa.table({"batch": pa.array([b] * 100), "doc_id": pa.array([i for i, _ in part]),
                         "text": pa.array([t.encode() for _, t in part])}) for b in range(20) for part in [docs[b * 100:b * 100 + 100]]]
    shared = group([repeats._shared_triggers(g) for g in group([repeats._send_triggers(bits)(d) for d in batches], "range")], "batch")
    phrases = group([repeats._send_phrases(bits)(d, t) for d, t in zip(batches, shared, strict=True)], "range")
    asked = pa.concat_tables([repeats._smallest(g, 200) for g in phrases])
    told = group([asked.filter(pc.not_equal(asked["kind"], 0))], "batch")
    texts = group([repeats._send_texts(bits)(d, t) for d, t in zip(batches, told, strict=True)], "range")
    # entries of the second round do not grow with a batch's documents, bytes of the third are spread
    assert max(sum(len(b) for b in g["blob"].to_pylist()) for g in phrases) < 20_000
    held = [sum(len(b) for b in g["blob"].to_pylist()) for g in texts]
    assert max(held) < 3 * sum(held) / len(held) and len(held) > 40


@pytest.mark.parametrize("hot", [0, 3, 100])
def test_hot_triggers_like_brute_force(spark, hot):
    rng = np.random.default_rng(6)
    docs = around_one_passage(300) + around_one_passage(150, 25, 7)
    docs += [(int(i), t[40:190]) for i, t in zip(rng.integers(0, 900, 200), (t for _, t in docs[::2]), strict=False)]
    docs += [(i, t + t) for i, t in docs[:20]] + [(None, docs[3][1]), (None, None), (7, "")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = repeats.remove_repeats(df, batch_bytes=9000, range_bytes=4000, hot=hot)
    assert Counter(map(tuple, got.collect())) == brute(docs)
