import re
import textwrap

import duckdb

from driftsweep.llm import licenses


def brute(text):
    found = []
    for segment in re.sub(r"([.!?])[ \t]+", r"\1\n", text or "").split("\n"):
        own = set(licenses.grams(segment))
        best = max((2.0 * len(own & set(g)) / (len(own) + len(g)), -k) for k, (_, t) in enumerate(licenses.TEMPLATES)
                   for g in [licenses.grams(t)])
        if best[0] >= licenses.DICE:
            found.append((licenses.TEMPLATES[-best[1]][0], best[0]))
    return len(found), ",".join(sorted({x for x, _ in found})), max((d for _, d in found), default=0.0)


def rows(spark, small):
    more = [(1, t) for _, t in licenses.TEMPLATES] + [
        (2, "x. Licensed under the  APACHE license - version 2.0! foo\nAll rights reserved"),
        (3, "All rights reserved. " * 70 + licenses.TEMPLATES[4][1]), (4, "Licensed under the Apache License, Version 3.0."),
        (5, "Licensed under the Apache"), (6, "rights reserved all"), (7, "licensed licensed under under cc cc by nc 4 0")]
    return small.select("doc_id", "text").union(spark.createDataFrame(more, "doc_id long, text string"))


def test_scan_like_brute_force_and_like_sql(spark, small, tmp_path):
    docs = rows(spark, small)
    got = sorted(map(tuple, licenses.scan(docs).collect()), key=str)
    assert got == sorted(((r.doc_id, *brute(r.text)) for r in docs.collect()), key=str)
    assert sum(r[1] for r in got) > 70
    documents = docs.toPandas()  # noqa: F841  (read by the query)
    with duckdb.connect() as con:
        con.register("documents", documents.astype({"doc_id": "Int64"}))
        assert sorted(con.sql(licenses.sql()).fetchall(), key=str) == got


def test_pruning_bounds_are_lossless():
    for n in range(1, 60):
        low, high = licenses.bounds(n)
        for a in range(1, 200):
            if 2 * min(a, n) / (a + n) >= licenses.DICE:
                assert low <= a <= high


def test_empty(empty):
    assert licenses.scan(empty).count() == 0


def test_wrapped_notices_are_found(spark):
    long = [(name, t) for name, t in licenses.TEMPLATES if len(t) > 60]
    docs, want = [], {}
    for n, (name, t) in enumerate(long * 2):
        width, mark = (60, " * ") if n < len(long) else (72, "")
        docs.append((n, f"Some words before\n{mark}\n" + "\n".join(mark + x for x in textwrap.wrap(t, width)) + f"\n{mark}\nand words after"))
        want[n] = (1, name, 1.0)
    docs += [(900, "All rights reserved.\nAll rights\nreserved."), (901, "All rights reserved\nfoo bar baz\nfoo bar"), (902, "\n\n"), (903, None)]
    want |= {900: (2, "proprietary", 1.0), 901: (1, "proprietary", 1.0), 902: (0, "", 0.0), 903: (0, "", 0.0)}
    got = licenses.scan(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.doc_id: tuple(r)[1:] for r in got} == want


def test_given_documents_like_sql(spark):
    path = "/root/testdata/sf0.01/documents.parquet"
    got = sorted(map(tuple, licenses.scan(spark.read.parquet(path)).collect()), key=str)
    with duckdb.connect() as con:
        con.sql(f"CREATE VIEW documents AS SELECT * FROM '{path}'")
        assert sorted(con.sql(licenses.sql()).fetchall(), key=str) == got
