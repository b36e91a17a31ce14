"""Language ID by nearest centroid: TF-IDF byte trigrams, several centroids per language, cosine.

Fit. Document frequencies of the hashed trigrams are counted over *all* training rows (a map-side
combined aggregate of at most ``DIMS`` rows). The centroids are fitted on at most ``SAMPLE_ROWS``
training rows (the bound is a parameter; of the distinct rows of each language those with the
smallest content hash, up to a fair share, so copies count once and no language is left out) by spherical k-means, ``PER_LANGUAGE`` centroids for each language.

Prediction. A text gets the language of the nearest centroid and, as score, the cosine to it
(0 to 1). ``und`` with score 0: null or empty text, text without a letter, or nothing learned.

Rejection by distance. Over all training rows the cosines are counted in a histogram for each length
class (bit length of the number of trigrams); a text is rejected if it is ``und`` or its cosine is
under ``REJECT`` times the ``LOW`` quantile of its class (a class that no training row has rejects
nothing but ``und``), so a few training rows in another language under a known label are rejected
themselves and do not move the floor. In a class of under ``FEW`` rows that quantile is its smallest
cosine; as cosines grow with length, its floor is at least the smallest one of the shorter classes
with ``FEW`` rows, if there are any. For the same reason k-means does not start at the farthest rows,
but leaves out the ``OUTLIERS`` share of them. Repeated rows get equal results; ties between centroids go to the language first in
code point order; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from driftsweep.llm.common import SLICE_BYTES, cut, ready, slices

DIMS = 4096
PER_LANGUAGE = 3
SAMPLE_ROWS = 3000
REJECT = 0.5
#: Quantile of the cosines of a length class, the bins they are counted in, rows that a quantile needs.
LOW, BINS, FEW = 0.01, 1000, 100
#: Share of a language's rows farthest from the starts so far that are no start of k-means.
OUTLIERS = 0.05
UND = "und"

_FOLD = np.full(256, 32, np.uint8)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def trigram_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Counts (rows x DIMS) of the hashed trigrams of each row's letters, words set apart by a space."""
    rows = len(offsets) - 1
    out = np.zeros((rows, DIMS), np.float32)
    folded = _FOLD[data]
    row_of = np.repeat(np.arange(rows), np.diff(offsets))
    step = SLICE_BYTES  # a text longer than a slice is counted piece by piece
    for at in range(0, max(0, len(folded) - 2), step):
        b = folded[at:at + step + 2].astype(np.uint32)
        r = row_of[at:at + step + 2]
        ok = (r[:-2] == r[2:]) & ~((b[1:-1] == 32) & ((b[:-2] == 32) | (b[2:] == 32)))
        code = ((b[:-2] << 16 | b[1:-1] << 8 | b[2:]) * np.uint32(2654435761)) >> np.uint32(20)
        first = int(r[0])
        seen = np.bincount((r[:-2][ok] - first) * DIMS + code[ok], minlength=(int(r[-1]) - first + 1) * DIMS)
        out[first:int(r[-1]) + 1] += seen.reshape(-1, DIMS)[:int(r[-1]) - first + 1]
    return out


def _blocks(batches: Iterator[pa.RecordBatch]):
    """Steps of bounded text and at most 512 rows, so that the dense counts stay small."""
    for rows, data, offsets in slices(batches):
        for i in range(0, rows.num_rows, 512):
            off = offsets[i:i + 513]
            yield rows.slice(i, 512), trigram_counts(data[off[0]:off[-1]], off - off[0])


def unit_vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.where(counts > 0, 1 + np.log(np.maximum(counts, 1)), 0) * idf
    return (v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)).astype(np.float32)


def _centroids(x: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means from far-apart starts; deterministic."""
    c = [x.mean(0)]
    while len(c) < min(k, len(x)):
        near = np.max(x @ (np.array(c) / np.linalg.norm(c, axis=1, keepdims=True)).T, axis=1)
        c.append(x[np.argsort(near, kind="stable")[int(OUTLIERS * len(x))]])
    c = np.array(c)
    for _ in range(12):
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
        near = np.argmax(x @ c.T, axis=1)
        c = np.array([x[near == i].mean(0) if (near == i).any() else c[i] for i in range(len(c))])
    return c / np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)


def _df_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    df, n = np.zeros(DIMS, np.int64), 0
    for rows, counts in _blocks(batches):
        df += (counts > 0).sum(0)
        n += rows.num_rows
    if n:
        yield pa.record_batch({"dim": pa.array(range(-1, DIMS), pa.int32()),
                               "n": pa.array([n, *df.tolist()], pa.int64())})


def _sample_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sent: set[tuple] = set()  # a task sends copies once; at most the sample's rows
    for rows, counts in _blocks(batches):
        keys = list(zip(rows.column("lang").to_pylist(), rows.column("pos").to_pylist(), strict=True))
        fresh = [i for i, k in enumerate(keys) if not (k in sent or sent.add(k))]
        if not fresh:
            continue
        rows, counts = rows.take(pa.array(fresh)), counts[fresh]
        yield pa.record_batch({"lang": rows.column("lang"), "pos": rows.column("pos"),
                               "dims": pa.array([np.flatnonzero(c).astype(np.int16).tobytes() for c in counts], pa.binary()),
                               "counts": pa.array([c[c > 0].astype(np.float32).tobytes() for c in counts], pa.binary())})


def _last_picked(keys: DataFrame, sample_rows: int) -> dict[str, int]:
    """For each language the largest hash of its share of the sample, from distinct (lang, pos)."""
    keys = cut(keys)
    counts = keys.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(sample_rows).collect()
    if not counts:
        return {}
    share = max(1, sample_rows // len(counts))
    # hashes are even: a range with half as many again and some more holds the share, and bounds the window
    wide = {c["lang"]: min(2**63 - 1, int(min(1.0, (1.5 * share + 50) / c["n"]) * 2**64) - 2**63) for c in counts}
    limit = F.create_map(*[x for k, v in wide.items() for x in (F.lit(k), F.lit(v))])
    place = F.row_number().over(Window.partitionBy("lang").orderBy("pos"))
    few = keys.filter(F.col("pos") <= limit[F.col("lang")]).withColumn("place", place).filter(F.col("place") <= share)
    return {r["lang"]: r["last"] for r in few.groupBy("lang").agg(F.max("pos").alias("last")).collect()}


def fit(train: DataFrame, sample_rows: int = SAMPLE_ROWS) -> dict:
    """Learn from rows (text, lang); see the module docstring. No usable row: a model that knows nothing."""
    train = train.filter("lang is not null and text rlike '\\\\p{L}'").select("text", "lang")
    got = {r["dim"]: r["n"] for r in train.select("text").mapInArrow(_df_rows, "dim int, n long")
           .groupBy("dim").agg(F.sum("n").alias("n")).collect()}  # DIMS + 1 rows at most
    n = got.get(-1, 0)
    df = np.array([got.get(i, 0) for i in range(DIMS)], float)
    idf = np.log((1 + n) / (1 + df)) + 1
    train = train.withColumn("pos", F.xxhash64("text", "lang"))
    last = _last_picked(train.select("lang", "pos").distinct(), sample_rows)
    if not last:
        return {"langs": [], "idf": idf.astype(np.float32), "owner": [], "centroids": np.zeros((0, DIMS), np.float32)}
    limit = F.create_map(*[x for k, v in last.items() for x in (F.lit(k), F.lit(v))])
    picked = (train.filter(F.col("pos") <= limit[F.col("lang")])
              .mapInArrow(_sample_rows, "lang string, pos long, dims binary, counts binary")
              .dropDuplicates(["lang", "pos"]).orderBy("pos", "lang").collect())  # sample_rows at most
    x = np.zeros((len(picked), DIMS), np.float32)
    for i, r in enumerate(picked):
        x[i, np.frombuffer(r["dims"], np.int16)] = np.frombuffer(r["counts"], np.float32)
    x, langs = unit_vectors(x, idf), sorted({r["lang"] for r in picked})
    of = np.array([r["lang"] for r in picked])
    groups = [_centroids(x[of == g], PER_LANGUAGE) for g in langs]
    return {"langs": langs, "idf": idf.astype(np.float32), "owner": [i for i, g in enumerate(groups) for _ in g],
            "centroids": np.vstack(groups).astype(np.float32) if groups else np.zeros((0, DIMS), np.float32)}


def _judge(model: dict, counts: np.ndarray, letters: np.ndarray):
    """Language, score and length class of each row."""
    cls = np.ceil(np.log2(counts.sum(1) + 1)).astype(np.int32)
    if not model["langs"]:
        return [UND] * len(counts), np.zeros(len(counts)), cls
    sim = unit_vectors(counts, model["idf"]) @ model["centroids"].T
    best = np.argmax(sim, axis=1)
    score = np.where(letters, np.clip(sim[np.arange(len(best)), best], 0, 1).astype(float), 0.0)
    names = [model["langs"][model["owner"][b]] if ok else UND for b, ok in zip(best, letters, strict=True)]
    return names, score, cls


def _with_letters(docs: DataFrame, name: str) -> DataFrame:
    return docs.withColumn(name, F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))


def predict(docs: DataFrame, model: dict) -> DataFrame:
    """(doc_id, text, any 'kept' column) to doc_id, kept, lang_pred, score, size_class."""
    def run(batches):
        for rows, counts in _blocks(batches):
            names, score, cls = _judge(model, counts, np.array(rows.column("letters").to_pylist(), bool))
            yield pa.record_batch({"doc_id": rows.column("doc_id").cast(pa.int64()), "kept": rows.column("kept"),
                                   "lang_pred": pa.array(names, pa.string()), "score": pa.array(score, pa.float64()),
                                   "size_class": pa.array(cls, pa.int32())})
    return _with_letters(docs.select("doc_id", "text", "kept"), "letters").mapInArrow(
        run, "doc_id long, kept boolean, lang_pred string, score double, size_class int")


def floors(predicted: DataFrame) -> dict[int, float]:
    """Smallest accepted cosine per length class, from all training rows (kept = false).

    At most BINS + 1 counts for each of 64 classes come to the driver.
    """
    rows = (predicted.filter("not kept and lang_pred <> 'und'")
            .groupBy("size_class", F.floor(F.col("score") * BINS).alias("bin")).count().collect())
    counts: dict[int, dict[int, int]] = {}
    for r in rows:
        counts.setdefault(r["size_class"], {})[r["bin"]] = r["count"]
    low = {}
    for cls, own in counts.items():
        skip, seen = int(LOW * sum(own.values())), 0
        for b in sorted(own):
            seen += own[b]
            if seen > skip:
                low[cls] = REJECT * b / BINS
                break
    large = {cls: low[cls] for cls, own in counts.items() if cls in low and sum(own.values()) >= FEW}
    return {cls: f if cls in large else max(f, min((g for c, g in large.items() if c < cls), default=0.0))
            for cls, f in low.items()}


def held_out(doc_id: str = "doc_id"):
    """crc32 of the id as text leaves 0 when divided by 5; a null id is a training row."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def identify(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected for every row of ``docs`` (doc_id, text, lang)."""
    ready(docs.sparkSession)
    rows = docs.select("doc_id", "text", "lang").withColumn("kept", held_out())
    model = fit(rows.filter("not kept"), sample_rows)
    out = cut(predict(rows.withColumn("kept", F.col("kept") | F.col("lang").isNull()), model))
    low = floors(out)
    floor = F.coalesce(F.create_map(*[x for k, v in low.items() for x in (F.lit(k), F.lit(v))])[F.col("size_class")],
                       F.lit(0.0)) if low else F.lit(0.0)
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score",
                      ((F.col("lang_pred") == UND) | (F.col("score") < floor)).alias("rejected"))


def accepted(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of ``docs``, all columns as they are, that the classifier does not reject."""
    ready(docs.sparkSession)
    rows = docs.select("doc_id", "text", "lang").withColumn("kept", held_out())
    model = fit(rows.filter("not kept"), sample_rows)
    low = floors(predict(rows.filter("not kept and lang is not null"), model))

    def run(batches):
        for part, counts in _blocks(batches):
            letters = np.array(part.column(part.num_columns - 1).to_pylist(), bool)
            names, score, cls = _judge(model, counts, letters)
            ok = np.array([a != UND and s >= low.get(int(c), 0.0) for a, s, c in zip(names, score, cls, strict=True)], bool)
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(ok)) for c in part.columns[:-1]], schema=schema_of(part))

    def schema_of(part):
        return pa.schema(list(part.schema)[:-1])

    return _with_letters(docs, "__lid_letters").mapInArrow(run, docs.schema)


