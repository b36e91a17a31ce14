import random

import pytest

from driftsweep.llm import token_counts as tc


@pytest.fixture(scope="module")
def counter():
    return tc.Counter(tc.read_ranks())


def edited(text, edits):
    for a, b, new in reversed(edits):
        text = text[:a] + new + text[b:]
    return text


def full(counter, text):
    return len(counter.encoding.encode_ordinary(text))


def test_tree_counts_like_the_whole_text(counter):
    for text in ("", "a", "it's  fine\n\n ", "x" * 999, " " * 300, "é ñ 12 !!" * 90):
        assert tc.Tree.of(text, counter)[0].tokens == full(counter, text)


def test_random_edits_count_like_the_edited_text(counter, spark):
    rng = random.Random(4)
    texts = [r[0] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    texts += ["", " ", "it's we're " * 200, " \n " * 300, "a" * 700]
    for text in texts:
        tree = tc.Tree.of(text, counter)[0]
        for _ in range(2):  # the second round edits a tree that was edited before
            points = sorted(rng.randint(0, len(text)) for _ in range(2 * rng.choice((1, 2, 9))))
            edits = [(a, min(b, a + rng.choice((0, 1, 30))), rng.choice(("", " ", "'re", "\n\n", "abc", " x  ", "é")))
                     for a, b in zip(points[::2], points[1::2], strict=True)]
            edits = [e for i, e in enumerate(edits) if i == 0 or e[0] >= edits[i - 1][1]]
            want = edited(text, edits)
            got, _ = tc.apply_edits(text, tree, edits, counter)
            assert got == want and tree.tokens == full(counter, want) and int(tree.sums[0, 1]) == len(want)
            text = want


def test_only_the_neighbourhood_is_encoded_again(counter):
    text = "some plain words here " * 5000
    tree, n = tc.Tree.of(text, counter)
    _, again = tc.apply_edits(text, tree, [(50_000, 50_004, "other")], counter)
    assert n == 20_001 and again <= 4 * tc.LEAF


def test_query_counts_every_row(small, empty, counter):
    got = sorted(map(tuple, tc.count_edited(small).collect()), key=str)
    want = []
    for r in small.collect():
        text = r.text or ""
        edits = tc.redactions(text)
        want.append((r.doc_id, full(counter, text), len(edits), full(counter, edited(text, edits))))
    assert [(r[0], r[2], r[3], r[5]) for r in got] == sorted(want, key=lambda w: str((w[0],))) or \
        sorted((r[0] or -1, r[2], r[3], r[5]) for r in got) == sorted((w[0] or -1, *w[1:]) for w in want)
    assert tc.count_edited(empty).count() == 0
