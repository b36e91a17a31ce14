"""Vector code compression: a product quantiser fitted by dual-tree Lloyd rounds, exact on integers.

Result. Rows whose vector is null or holds a null or non-finite component are dropped. Components become
integers, floor(1024 x); vectors are cut into ``PARTS`` equal consecutive parts. Each part position has a
codebook that starts as that part of the ``ENTRIES`` smallest kept vec_ids and is moved by ``ROUNDS`` Lloyd
rounds (nearest entry by squared Euclidean distance, ties to the lower index; an entry becomes the
componentwise floor of the mean of its parts, an unused one stays). Then all parts are assigned once more.

Trees. The kept vectors are written once to the shared folder in blocks of at most ``BLOCK`` rows. For each
part position a block is stored in the order of a balanced k-d tree (node i of level l holds the rows
n*i >> l to n*(i+1) >> l, so the tree needs no pointers); boxes and sums of its nodes follow from the
stored rows by pairwise minima, maxima and sums. The distinct entries of a codebook form the second tree,
built in each task. Both trees are descended together, level by level: of a node pair the boxes give the
least and the greatest distance, a pair goes when its least distance is above the smallest greatest
distance of its node (equal stays, as ties go by index). A node that is left with one entry is assigned
as a whole by its cached sums; leaves that keep several entries compare them by integer distances.

Distribution. A task adds up its blocks and sends (part, entry, limb, count, sums) with sums cut into limbs of
40 bits, so that Spark's long sums cannot overflow; the driver gets at most PARTS * ENTRIES rows a limb in a
round, whatever the input, and sends codebooks of that size back. Label sums are a grouped sum joined
back by a size-checked join, so a label of many rows is no single task.

Defined results. Values too large for 64-bit distances take the same steps on Python integers; an ``error`` or
``label_error`` beyond a long is null. Vectors shorter than the longest (rounded up to a multiple of PARTS)
are padded by zeros. Null vec_ids come last in the initial codebook, ties in vec_id go by the vector;
repeated rows count as often as they occur and are returned as often. Empty vectors have distance 0. An empty
table gives no rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftsweep.llm.common import cut, ready
from driftsweep.operators.joins import join_checked
from driftsweep.session import scratch_path

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Most rows and bytes of a block; rows of a leaf of its trees.
BLOCK, BLOCK_BYTES, LEAF = 8192, 16 << 20, 32
#: Bits of a limb of a sum.
_LIMB = 40
_LONG = 2**63 - 1


def kept_vectors(vectors: DataFrame) -> DataFrame:
    """vec_id, label (as text) and embedding of the rows that take part."""
    fine = F.forall("embedding", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e.cast("double")) != float("inf")))
    return (vectors.filter(F.col("embedding").isNotNull() & fine)
            .select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"),
                    F.col("embedding").cast("array<double>").alias("embedding")))


def integers(x: np.ndarray) -> np.ndarray:
    """floor(1024 x); 64-bit, or Python integers where they do not fit."""
    if not x.size or np.abs(x).max() < 2.0**52:
        return np.floor(x * SCALE).astype(np.int64)
    big = np.array([math.floor(v * SCALE) if abs(v) < 2.0**52 else int(v) * SCALE for v in x.ravel().tolist()], object)
    return big.reshape(x.shape)


def _fits(d: int, *arrays: np.ndarray) -> bool:
    """Whether squared distances of ``d`` components fit 64 bits."""
    top = max((max(abs(int(a.max())), abs(int(a.min()))) for a in arrays if a.size), default=0)
    return max(d, 1) * (2 * top) ** 2 < 2**62


def _common(d: int, *arrays: np.ndarray) -> list[np.ndarray]:
    """The arrays as 64-bit integers if distances between them fit, else as Python integers."""
    return [a.astype(np.int64 if _fits(d, *arrays) else object) for a in arrays]


class Tree:
    """Balanced k-d tree over the rows of ``x``: rows in tree order, and for each level the nodes' boxes and sums."""

    def __init__(self, x: np.ndarray, leaf: int, ordered: bool = False) -> None:
        self.n = n = len(x)
        self.depth = max(0, (n // leaf).bit_length() - 1)
        self.order = np.arange(n) if ordered else self._order(x)
        self.x = x[self.order]
        edges = self.edges(self.depth)[:-1]
        lo, hi = (f.reduceat(self.x, edges, axis=0) for f in (np.minimum, np.maximum))
        total = np.add.reduceat(self.x, edges, axis=0)
        self.lo, self.hi, self.total = [lo], [hi], [total]
        for _ in range(self.depth):
            lo, hi = np.minimum(lo[::2], lo[1::2]), np.maximum(hi[::2], hi[1::2])
            total = total[::2] + total[1::2]
            for level, rows in ((self.lo, lo), (self.hi, hi), (self.total, total)):
                level.insert(0, rows)

    def edges(self, level: int) -> np.ndarray:
        """Borders of the nodes of a level, in rows."""
        return np.arange((1 << level) + 1) * self.n >> level

    def _order(self, x: np.ndarray) -> np.ndarray:
        order = np.arange(len(x))
        if not x.shape[1]:
            return order
        for level in range(self.depth):
            edge, below = self.edges(level), self.edges(level + 1)
            for i in range(1 << level):
                a, b, mid = edge[i], edge[i + 1], below[2 * i + 1]
                rows = x[order[a:b]]
                widest = rows[:, int(np.argmax(rows.max(axis=0) - rows.min(axis=0)))]
                by = np.argsort(widest, kind="stable") if x.dtype == object else np.argpartition(widest, mid - a)
                order[a:b] = order[a:b][by]
        return order


class Codebook:
    """Tree over the distinct entries of one part position; equal entries stand for the lowest index."""

    def __init__(self, entries: np.ndarray) -> None:
        first: dict[tuple, int] = {}
        for i, e in enumerate(map(tuple, entries.tolist())):
            first.setdefault(e, i)
        self.index = np.array(list(first.values()), np.int64)
        self.raw = entries[self.index]

    def assign(self, points: np.ndarray, want_codes: bool) -> tuple[np.ndarray, ...]:
        """Assign rows that are stored in tree order: (entries used, counts, sums), or with ``want_codes``
        (entry of each row, squared distance of each row)."""
        d = points.shape[1]
        x, entries = _common(d, points, self.raw)
        rows, tree = Tree(x, LEAF, ordered=True), Tree(entries, 1)
        entries, index = tree.x, self.index[tree.order]   # in tree order
        code = np.empty(len(x), np.int64)
        whole: list[tuple[int, int, int]] = []   # level, node, entry (tree order)
        p, e, lp, le = np.zeros(1, np.int64), np.zeros(1, np.int64), 0, 0
        entry_edges = tree.edges(tree.depth)
        while True:
            plo, phi, elo, ehi = rows.lo[lp][p], rows.hi[lp][p], tree.lo[le][e], tree.hi[le][e]
            gap = np.maximum(np.maximum(plo - ehi, elo - phi), 0)
            far = np.maximum(ehi - plo, phi - elo)
            least, most = (gap * gap).sum(axis=1), (far * far).sum(axis=1)
            new = np.flatnonzero(np.concatenate(([True], p[1:] != p[:-1])))   # pairs stay sorted by node
            bound = np.minimum.reduceat(most, new)
            size = np.diff(np.concatenate((new, [len(p)])))
            near = (least <= np.repeat(bound, size)).astype(bool)
            p, e = p[near], e[near]
            if le == tree.depth:
                new = np.flatnonzero(np.concatenate(([True], p[1:] != p[:-1])))
                size = np.diff(np.concatenate((new, [len(p)])))
                lone = new[(size == 1) & (entry_edges[e[new] + 1] - entry_edges[e[new]] == 1)]
                whole += [(lp, int(p[i]), int(entry_edges[e[i]])) for i in lone]
                stay = np.ones(len(p), bool)
                stay[lone] = False
                p, e = p[stay], e[stay]
                if lp == rows.depth or not len(p):
                    break
            if lp < rows.depth:
                p, e, lp = (2 * p[:, None] + [0, 1]).ravel(), np.repeat(e, 2), lp + 1
                by = np.argsort(p, kind="stable")
                p, e = p[by], e[by]
            if le < tree.depth:
                p, e, le = np.repeat(p, 2), (2 * e[:, None] + [0, 1]).ravel(), le + 1
        counts, sums = np.zeros(len(entries), np.int64), np.zeros((len(entries), d), x.dtype)
        for level, node, c in whole:
            a, b = rows.edges(level)[node:node + 2]
            code[a:b] = index[c]
            counts[c] += b - a
            sums[c] += rows.total[level][node]
        leaf_edges = rows.edges(rows.depth)
        norm = (entries * entries).sum(axis=1)
        by_index = np.argsort(index)
        place = np.empty_like(by_index)
        place[by_index] = np.arange(len(by_index))
        borders = np.concatenate((np.flatnonzero(np.diff(p, prepend=-1)), [len(p)]))   # leaves that keep several entries
        for s, t in zip(borders[:-1], borders[1:], strict=True):
            a, b = leaf_edges[p[s]:p[s] + 2]
            some = np.concatenate([np.arange(entry_edges[k], entry_edges[k + 1]) for k in e[s:t]])
            some = by_index[np.sort(place[some])]   # by index, so that the first least distance wins
            best = some[np.argmin(norm[some] - 2 * (x[a:b] @ entries[some].T), axis=1)]
            code[a:b] = index[best]
            np.add.at(counts, best, 1)
            np.add.at(sums, best, x[a:b])
        if want_codes:
            back = np.empty(int(self.index.max()) + 1, np.int64)
            back[index] = np.arange(len(index))
            off = x - entries[back[code]]
            return code, (off * off).sum(axis=1)
        used = np.flatnonzero(counts)
        return index[used], counts[used], sums[used]


# ---- blocks


def _pack(x: np.ndarray) -> tuple[str, bytes]:
    """Integers as bytes of the narrowest type, or as text."""
    if x.dtype != object:
        for t in ("<i2", "<i4", "<i8"):
            if not x.size or (x.max() <= np.iinfo(t).max and x.min() >= np.iinfo(t).min):
                return t, x.astype(t).tobytes()
    return "text", ",".join(map(str, x.ravel().tolist())).encode()


def _unpack(kind: str, data: bytes, n: int, d: int) -> np.ndarray:
    if kind == "text":
        return np.array([int(v) for v in data.split(b",")], object).reshape(n, d)
    return np.frombuffer(data, kind).astype(np.int64).reshape(n, d)


_BLOCK = "ids array<long>, labels array<string>, kinds array<string>, orders array<binary>, points array<binary>"


def _blocks(dim: int, size: int):
    """Arrow batches of vectors to blocks, each part position in its tree's order."""
    d = dim // PARTS

    def block(ids: list, labels: list, rows: list[np.ndarray]) -> pa.RecordBatch:
        x = integers(np.concatenate(rows))
        kinds, orders, points = [], [], []
        for k in range(PARTS):
            part = x[:, k * d:(k + 1) * d]
            tree = Tree(part, LEAF)
            kind, data = _pack(tree.x)
            kinds.append(kind)
            orders.append(tree.order.astype("<i4").tobytes())
            points.append(data)
        return pa.RecordBatch.from_arrays(
            [pa.array([ids], pa.list_(pa.int64())), pa.array([labels], pa.list_(pa.string())), pa.array([kinds]),
             pa.array([orders], pa.list_(pa.binary())), pa.array([points], pa.list_(pa.binary()))],
            ["ids", "labels", "kinds", "orders", "points"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, rows = [], [], []
        for b in batches:
            col = b.column(2)
            lens = np.asarray(col.value_lengths().to_numpy(zero_copy_only=False), np.int64)
            flat = np.asarray(col.flatten().to_numpy(zero_copy_only=False), np.float64)
            x = np.zeros((b.num_rows, dim))
            x[np.arange(dim) < lens[:, None]] = flat
            own, tags, at = b.column(0).to_pylist(), b.column(1).to_pylist(), 0
            while at < b.num_rows:
                to = min(b.num_rows, at + size - len(ids))
                ids += own[at:to]
                labels += tags[at:to]
                rows.append(x[at:to])
                at = to
                if len(ids) == size:
                    yield block(ids, labels, rows)
                    ids, labels, rows = [], [], []
        if ids:
            yield block(ids, labels, rows)
    return run


def _parts(batch: pa.RecordBatch, d: int) -> Iterator[tuple[list, list, list[np.ndarray], list[np.ndarray]]]:
    for r in batch.to_pylist():
        n = len(r["ids"])
        yield (r["ids"], r["labels"], [np.frombuffer(o, "<i4") for o in r["orders"]],
               [_unpack(k, p, n, d) for k, p in zip(r["kinds"], r["points"], strict=True)])


# ---- Lloyd rounds


def _limbs(v: int) -> list[int]:
    """|v| in limbs of 40 bits, lowest first, each with v's sign."""
    sign, v, out = (-1, -v, []) if v < 0 else (1, v, [])
    while v:
        out.append(sign * (v & ((1 << _LIMB) - 1)))
        v >>= _LIMB
    return out


def _partial(books: list[np.ndarray], d: int):
    """Blocks to (part, entry, limb, n, s): a task's counts and sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [Codebook(b) for b in books]
        held = [{} for _ in books]   # entry -> [count, sums as Python integers]
        for batch in batches:
            for _, _, _, points in _parts(batch, d):
                for book, own, x in zip(trees, held, points, strict=True):
                    for e, n, s in zip(*(a.tolist() for a in book.assign(x, False)), strict=True):
                        old = own.get(e)
                        own[e] = [n, s] if old is None else [old[0] + n, [a + b for a, b in zip(old[1], s, strict=True)]]
        rows = []
        for part, own in enumerate(held):
            for e, (n, s) in own.items():
                limbs = [_limbs(v) for v in s]
                for k in range(max(1, max(map(len, limbs), default=1))):
                    rows.append((part, e, k, n if k == 0 else 0, [x[k] if k < len(x) else 0 for x in limbs]))
        if rows:
            part, entry, limb, n, s = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(limb, pa.int32()),
                                              pa.array(n, pa.int64()), pa.array(s, pa.list_(pa.int64()))],
                                             ["part", "entry", "limb", "n", "s"])
    return run


def _moved(blocks: DataFrame, books: list[np.ndarray], d: int) -> list[np.ndarray]:
    """Codebooks after one round: at most PARTS * ENTRIES rows a limb come to the driver."""
    sums = (blocks.mapInArrow(_partial(books, d), "part int, entry int, limb int, n long, s array<long>")
            .groupBy("part", "entry", "limb")
            .agg(F.sum("n").alias("n"), F.array(*[F.sum(F.get("s", F.lit(i))) for i in range(d)]).cast("array<long>").alias("s")))
    total: dict[tuple[int, int], list] = {}
    for r in sums.collect():
        own = total.setdefault((r.part, r.entry), [0, [0] * d])
        own[0] += r.n
        own[1] = [a + (b << (_LIMB * r.limb)) for a, b in zip(own[1], r.s, strict=True)]
    out = []
    for part, book in enumerate(books):
        rows = book.tolist()
        for e in range(len(rows)):
            n, s = total.get((part, e), (0, []))
            if n:
                rows[e] = [v // n for v in s]
        out.append(_book(rows, d))
    return out


def _book(rows: list[list[int]], d: int) -> np.ndarray:
    big = any(abs(v) > _LONG for r in rows for v in r)
    return np.array(rows, object if big else np.int64).reshape(len(rows), d)


def _encode(books: list[np.ndarray], d: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [Codebook(b) for b in books]
        for batch in batches:
            for ids, labels, orders, points in _parts(batch, d):
                codes = np.empty((len(ids), PARTS), np.uint8)
                error = [0] * len(ids)
                for k, (book, order, x) in enumerate(zip(trees, orders, points, strict=True)):
                    code, off = book.assign(x, True)
                    codes[order, k] = code
                    for i, v in zip(order.tolist(), off.tolist(), strict=True):
                        error[i] += v
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(labels, pa.string()), pa.array([c.tobytes().hex() for c in codes], pa.string()),
                     pa.array([v if v <= _LONG else None for v in error], pa.int64())], ["vec_id", "label", "code", "error"])
    return run


def fit_and_encode(vectors: DataFrame, entries: int = ENTRIES, rounds: int = ROUNDS,
                   block: int = BLOCK) -> tuple[DataFrame, list[np.ndarray]]:
    """(vec_id, label, code, error) of every kept row, and the fitted codebooks, one array for each part position."""
    if not 0 < entries <= 256:
        raise ValueError("a code holds two hex digits for each part: 1 to 256 entries")
    spark = ready(vectors.sparkSession)
    kept = kept_vectors(vectors)
    longest = kept.agg(F.max(F.size("embedding"))).first()[0] or 0
    dim = -(-longest // PARTS) * PARTS
    d = dim // PARTS
    first = kept.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(entries).select("embedding").collect()
    start = np.zeros((len(first), dim))
    for i, r in enumerate(first):
        start[i, :len(r.embedding)] = r.embedding
    start = integers(start)
    books = [start[:, k * d:(k + 1) * d] for k in range(PARTS)]
    size = max(64, min(block, BLOCK_BYTES // (8 * max(dim, 1))))
    path = scratch_path(spark, "vector-blocks")
    kept.select("vec_id", "label", "embedding").mapInArrow(_blocks(dim, size), _BLOCK).write.parquet(path)
    blocks = spark.read.schema(_BLOCK).parquet(path)
    for _ in range(rounds if first else 0):
        books = _moved(blocks, books, d)
    return blocks.mapInArrow(_encode(books, d), "vec_id long, label string, code string, error long"), books


def digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all entries' decimal components by part, entry and position, comma-joined."""
    return hashlib.sha256(",".join(str(v) for b in books for v in b.ravel().tolist()).encode()).hexdigest()


def compress(vectors: DataFrame) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 for every kept row."""
    rows, books = fit_and_encode(vectors)
    key = F.coalesce(F.concat(F.lit("="), "label"), F.lit("")).alias("key")   # null labels are one group
    rows = cut(rows.select("vec_id", "code", "error", key))
    unknown = F.count_if(F.col("error").isNull()) > 0
    total = F.sum(F.col("error").cast("decimal(38,0)"))
    sums = rows.groupBy("key").agg(F.when(~unknown & (total <= _LONG), total.cast("long")).alias("label_error"))
    return (join_checked(rows, sums, ["key"], salt_from=["vec_id"])
            .select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256")))


def sql() -> str:
    """The same rows in DuckDB SQL, the rounds written out one after the other."""
    step = """
a{n} AS (SELECT k, part, arg_min(entry, dist * 256 + entry) AS entry, min(dist) AS dist
         FROM (SELECT p.k, p.part, b.entry, sum((p.v - b.w) * (p.v - b.w)) AS dist
               FROM p JOIN b{n} b ON b.part = p.part AND b.pos = p.pos GROUP BY ALL) GROUP BY ALL)"""
    move = """,
s{n} AS (SELECT a.part, a.entry, p.pos, sum(p.v) AS s, count(*) AS n
         FROM a{n} a JOIN p ON p.k = a.k AND p.part = a.part GROUP BY ALL),
b{m} AS (SELECT b.part, b.entry, b.pos, CASE WHEN s.n IS NULL THEN b.w ELSE (s.s - ((s.s % s.n) + s.n) % s.n) // s.n END AS w
         FROM b{n} b LEFT JOIN s{n} s ON s.part = b.part AND s.entry = b.entry AND s.pos = b.pos),"""
    rounds = "".join(step.format(n=i) + move.format(n=i, m=i + 1) for i in range(ROUNDS)) + step.format(n=ROUNDS)
    return f"""
WITH kept AS (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS k, vec_id, label, embedding FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
d AS (SELECT max(len(embedding)) // {PARTS} AS d FROM kept),
c AS (SELECT k, unnest(range(len(embedding))) AS i, unnest(embedding) AS x FROM kept),
p AS (SELECT k, i // d AS part, i % d AS pos, CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT) AS v FROM c, d),
b0 AS (SELECT part, k - 1 AS entry, pos, v AS w FROM p WHERE k <= {ENTRIES}),{rounds},
h AS (SELECT sha256(string_agg(CAST(w AS VARCHAR), ',' ORDER BY part, entry, pos)) AS codebooks_sha256 FROM b{ROUNDS}),
r AS (SELECT k, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(dist) AS BIGINT) AS error
      FROM a{ROUNDS} GROUP BY k)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM r JOIN kept USING (k), h
"""
