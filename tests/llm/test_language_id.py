import zlib
from collections import Counter

import numpy as np

from driftsweep.llm import language_id as lid


def trigrams(text):
    folded = bytes(lid._FOLD[np.frombuffer(text.encode(), np.uint8)])
    out = np.zeros(lid.DIMS)
    for a, b, c in zip(folded, folded[1:], folded[2:], strict=False):
        if not (b == 32 and 32 in (a, c)):
            out[((a << 16 | b << 8 | c) * 2654435761 % 2**32) >> 20] += 1
    return out


def test_counts_like_one_by_one():
    texts = ["", "a", "ab", "The  cat.", "Été à la mer", "x" * 50, "1 2 3", "last one"]
    raw = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    got = lid.trigram_counts(data, np.concatenate(([0], np.cumsum([len(r) for r in raw]))))
    assert (got == np.array([trigrams(t) for t in texts])).all()


def test_counts_over_pieces(monkeypatch):
    monkeypatch.setattr(lid, "SLICE_BYTES", 7)
    texts = ["The quick brown fox", "jumps", "", "over it all again and again"]
    raw = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    got = lid.trigram_counts(data, np.concatenate(([0], np.cumsum([len(r) for r in raw]))))
    assert (got == np.array([trigrams(t) for t in texts])).all()


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r.doc_id: r for r in lid.identify(docs).collect()}
    lang = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    held = [i for i, r in got.items() if r.held_out]
    assert set(held) == {i for i in lang if zlib.crc32(str(i).encode()) % 5 == 0}
    assert sum(got[i].lang_pred == lang[i] for i in held) >= 0.99 * len(held)
    assert all(0 <= r.score <= 1 for r in got.values()) and not any(r.rejected for r in got.values())


def test_awkward_rows(small, empty, spark):
    got = lid.identify(small).collect()
    rows = small.select("doc_id", "text").collect()
    assert len(got) == len(rows)
    und = Counter(r.doc_id for r in got if r.lang_pred == "und")
    assert und == Counter(r.doc_id for r in rows if not any(c.isalpha() for c in r.text or ""))
    assert all(r.score == 0 and r.rejected for r in got if r.lang_pred == "und")
    kept = lid.accepted(small)
    assert kept.columns == small.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(r.doc_id for r in got if not r.rejected)
    assert lid.identify(empty).count() == 0 and lid.accepted(empty).count() == 0
    unlabelled = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert [tuple(r)[2:4] for r in lid.identify(unlabelled).collect()] == [("und", 0.0)]


def test_labels_of_held_out_rows_and_other_columns_do_not_matter(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang", "source")
    want = sorted(map(tuple, lid.identify(docs).collect()))
    other = docs.selectExpr("doc_id", "text", "if(crc32(cast(doc_id as string)) % 5 = 0, 'xx', lang) as lang", "'s' as source")
    assert sorted(map(tuple, lid.identify(other).collect())) == want


FINNISH = ("suomi on tasavalta ja sen naapurimaat ovat ruotsi norja sekä viro joka sijaitsee meren toisella puolella kaikki "
           "ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan heille on annettu järki ja omatunto").split()


def test_foreign_training_rows_are_rejected_and_do_not_switch_rejection_off(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    words = np.random.default_rng(1).permutation(FINNISH * 12).tolist()
    training = [i for i in range(700_000, 700_400) if zlib.crc32(str(i).encode()) % 5][:1]
    held = [i for i in range(700_000, 700_400) if zlib.crc32(str(i).encode()) % 5 == 0][:20]
    rows = [(i, " ".join(words[n % 40:n % 40 + 100]), "en") for n, i in enumerate(training + held)]
    got = {r.doc_id: r for r in lid.identify(docs.union(spark.createDataFrame(rows, docs.schema))).collect()}
    assert all(got[i].rejected for i in training + held)
    assert not any(r.rejected for i, r in got.items() if i < 700_000)


def test_copies_do_not_take_the_sample_from_other_languages(spark):
    texts = [f"the cat number {i} sat on the mat" for i in range(400)]
    own = spark.createDataFrame([(t, "en") for t in texts], "text string, lang string").selectExpr("text", "xxhash64(text, lang) as pos")
    first = min(own.collect(), key=lambda r: r.pos).text  # its copies come before all other rows
    rows = [(t, "en") for t in texts] + [(first, "en")] * 500
    rows += [(f"der hund {i} liegt im garten", "de") for i in range(30)] + [("le chat dort dans la maison", "fr"), ("el perro duerme", "es")]
    model = lid.fit(spark.createDataFrame(rows, "text string, lang string").repartition(4), 40)
    assert model["langs"] == ["de", "en", "es", "fr"]
    assert np.bincount(model["owner"]).tolist() == [3, 3, 1, 1]
    picked = lid._last_picked(spark.createDataFrame(rows, "text string, lang string").selectExpr("lang", "xxhash64(text, lang) as pos").distinct(), 40)
    assert sum(r.pos <= picked["en"] for r in own.collect()) == 10
