import re
from collections import Counter

import numpy as np

from driftsweep.llm import decontaminate as dc


def words_of(text):
    return re.findall(rb"[0-9a-z\x80-\xff]+", (text or "").lower().encode())


def runs(words, n):
    return {b" ".join(words[i:i + n]) for i in range(len(words) - n + 1)}


def brute(docs, items):
    items = [(i, n, runs(w, n)) for i, t in {tuple(r) for r in items.collect()} for w in [words_of(t)] for n in [min(5, len(w))] if w]
    out = Counter()
    for r in docs.select("doc_id", "text").collect():
        own = {n: runs(words_of(r.text), n) for n in range(1, 6)}
        out.update((r.doc_id, i, len(s & own[n])) for i, n, s in items if len(s & own[n]) >= 0.8 * len(s) - 1e-9)
    return out


def test_pairs_like_brute_force(small, items):
    want = brute(small, items)
    got = Counter((r.doc_id, r.item_id, r.shared) for r in dc.contaminated(small, items).collect())
    assert want and got == want


def test_planted_items_with_edits_in_long_documents(spark, items):
    rng = np.random.default_rng(3)
    filler = lambda n: " ".join(f"w{x}" for x in rng.integers(0, 10**9, n))
    docs = []
    for k, r in enumerate(items.filter("length(text) > 40").limit(40).collect()):
        words = r.text.split()
        words[len(words) // 2] += "x" if k % 2 and len(words) > 30 else ""
        docs.append((k, f"{filler(int(rng.integers(0, 6000)))} {' '.join(words).upper()} {filler(300)}"))
    docs.append((999, filler(5000)))
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    want = brute(docs, items)
    assert len(want) >= 30
    assert Counter((r.doc_id, r.item_id, r.shared) for r in dc.contaminated(docs, items).collect()) == want


def test_clean_keeps_all_other_rows_and_columns(small, items, empty):
    bad = {d for d, _, _ in brute(small, items)}
    got = dc.clean(small, items)
    assert got.columns == small.columns
    assert Counter(r.doc_id for r in got.collect()) == Counter(r.doc_id for r in small.collect() if r.doc_id not in bad)
    assert dc.clean(empty, items).count() == 0 and dc.contaminated(empty, items).count() == 0
    assert dc.clean(small, items.limit(0)).count() == small.count() and dc.contaminated(small, items.limit(0)).count() == 0


def test_blocks_of_items_give_the_same(small, items, monkeypatch):
    want = Counter(map(tuple, dc.contaminated(small, items).collect()))
    monkeypatch.setattr(dc, "ITEM_BYTES", 2000)
    assert Counter(map(tuple, dc.contaminated(small, items).collect())) == want


def test_items_of_few_words_are_found_inside_documents(spark):
    kind = "item_id long, text string"
    items = spark.createDataFrame([(1, "Zebra"), (2, "two  words"), (3, "a b c d"), (4, "b"), (5, "ünï code!"), (6, "...")], kind)
    docs = spark.createDataFrame([(1, "x " * 3000 + "TWO, words " + "y " * 3000), (2, "two other words"), (3, "zebra"), (4, "a b c e"),
                                  (5, "one a-b-c-d one"), (6, "ünï"), (7, "say ünï code"), (8, None), (9, "zebras")], "doc_id long, text string")
    got = Counter((r.doc_id, r.item_id, r.shared) for r in dc.contaminated(docs, items).collect())
    assert got == brute(docs, items) == Counter({(1, 2, 1): 1, (3, 1, 1): 1, (4, 4, 1): 1, (5, 3, 1): 1, (5, 4, 1): 1, (7, 5, 1): 1})
    assert sorted(r.doc_id for r in dc.clean(docs, items).collect()) == [2, 6, 8, 9]
