import re
from collections import Counter, defaultdict

import pytest

from driftsweep.llm import divergence

TERM = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute(rows, min_docs, top):
    n, df, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        found = Counter(w.translate(LOWER) for w in TERM.findall(text or ""))
        n[lang, source] += found
        df[lang].update(found.keys())
    out = set()
    for lang in {g[0] for g in groups}:
        kept = [t for t, c in df[lang].items() if c >= min_docs]
        own = {s: {t: n[g, s][t] for t in kept} for g, s in groups if g == lang}
        own[None] = {t: sum(c[t] for s, c in own.items()) for t in kept}
        p = {s: {t: 1 + 10**9 * (c[t] + 2) // (sum(c.values()) + 2 * len(kept)) for t in kept} for s, c in own.items()}
        f = lambda a, b, t: (p[a][t] - p[b][t]) ** 2 // (p[a][t] + p[b][t])
        for s in own:
            if s is None:
                continue
            pair = [(o, sum(f(s, o, t) for t in kept)) for o in own if o not in (s, None)]
            term = [(t, f(s, None, t)) for t in kept if own[s][t] and p[s][t] > p[None][t]]
            for part, items, limit in (("pair", pair, len(pair)), ("term", term, top)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out |= {(lang, s, part, i, v, r) for r, (i, v) in enumerate(items[:limit], 1)}
    return out


def got(df, **kw):
    rows = divergence.audit(df, **kw).select("lang", "source", "part", "item", "value", "rank").collect()
    assert len(rows) == len(set(rows))
    return {tuple(r) for r in rows}


@pytest.mark.parametrize("min_docs", [1, 3, 10])
def test_equals_brute_force(small, min_docs):
    rows = [(r.text, r.lang, r.source) for r in small.select("text", "lang", "source").collect()]
    want = brute(rows, min_docs, divergence.TOP)
    assert want and got(small, min_docs=min_docs) == want


def test_terms_keep_other_scripts_and_lower_ascii_only():
    text = "ÀB c d É'x_y \x00Z\t\U0001f600a 1"
    assert [t.decode() for t in divergence.terms(text.encode())] == [w.translate(LOWER) for w in TERM.findall(text)]


def test_nothing_kept_lone_sources_and_ties(spark):
    schema = "text string, lang string, source string"
    rows = [(None, "a", "x"), ("", "a", "y"), ("one two", None, None), ("b a", "t", "s"), ("a b", "t", "r")]
    df = spark.createDataFrame(rows, schema)
    assert got(df) == brute(rows, 10, 10) == {("a", "x", "pair", "y", 0, 1), ("a", "y", "pair", "x", 0, 1),
                                             ("t", "s", "pair", "r", 0, 1), ("t", "r", "pair", "s", 0, 1)}
    assert got(df, min_docs=1) == brute(rows, 1, 10)


def test_partitioning_changes_nothing(small):
    a = got(small, min_docs=2)
    assert got(small.repartition(5), min_docs=2) == a


def test_empty(empty):
    assert got(empty) == set()
