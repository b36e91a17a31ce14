"""Benchmark decontamination: size-partitioned MinHash containment search, verified by exact shingles.

Words are runs of ASCII letters, digits and all non-ASCII characters of the lower-cased text;
shingles are five words. A document is contaminated by an item if it holds at least ``CONTAINMENT`` = 0.8 of
the item's distinct shingles. An item of 1 to 4 words is its own only shingle, and contaminates a document that
holds its words in a row anywhere; an item without a word or null matches nothing.

Search. Containment of a short item in a long document is a tiny Jaccard similarity, so both sides
are partitioned by size. Items with 2^k to 2^(k+1)-1 shingles form class k; for each class that
has items, a document is read as overlapping windows of 2^(k+2) shingles, each half a window after
the last. A window that holds the item has a Jaccard similarity of at least 0.19 to it, and with
``PERMUTATIONS`` = 64 bands of one MinHash each the chance to miss it is under 0.81^64 = 1.4e-6 (for
an unchanged item 1e-8). Window minima of a class are minima over those of the next smaller one.
Items of 1 to 4 words need no sketch: runs of that many words are looked up by hash.

Verification. Each candidate's shingles are compared as strings over the whole document.

The documents are read once for each block of items, without a shuffle; a block holds about
``ITEM_BYTES`` of item text, which bounds what is broadcast at any size of the benchmark table.
Equal (item_id, text) rows count once; items without a word match nothing; ids may be null or
repeat (each document row gives its own pairs); empty tables give no pairs.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftsweep.llm.common import buffers, ready, slices

WORDS, CONTAINMENT, PERMUTATIONS = 5, 0.8, 64
ITEM_BYTES = 8 << 20
_BITMAP = 1 << 20

_rng = np.random.default_rng(20)
_odd = lambda n: _rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE, _PLACE, _MUL, _XOR = _odd(256), _odd(WORDS), _odd(PERMUTATIONS), _odd(PERMUTATIONS)
_BASE = 0x9E3779B97F4A7C15
_IS_WORD = np.zeros(256, bool)
_IS_WORD[48:58] = _IS_WORD[97:123] = _IS_WORD[128:] = True
_powers: list[np.ndarray] = []


def _power_tables(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse (modulo 2^64), at least n of them."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, 1 << 21)
        make = lambda b: np.concatenate(([np.uint64(1)], np.cumprod(np.full(size, b, np.uint64))))
        _powers[:] = [make(np.uint64(_BASE)), make(np.uint64(pow(_BASE, -1, 2**64)))]
    return _powers


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


class Shingles:
    """Hashed shingles of a slice of rows (lower-cased UTF-8 ``data``), in row order."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray) -> None:
        rows = len(offsets) - 1
        word = np.concatenate(([False], _IS_WORD[data], [False]))
        inner = offsets[1:-1]
        begins = word[1:-1] & ~word[:-2]
        ends = word[1:-1] & ~word[2:]
        cut = inner[(inner > 0) & (inner < len(data))]  # a row's edge parts words
        begins[cut] |= word[1:-1][cut]
        ends[cut - 1] |= word[1:-1][cut - 1]
        self.data, self.begin, self.end = data, np.flatnonzero(begins), np.flatnonzero(ends) + 1  # words
        up, down = _power_tables(len(data) + 1)
        total = np.concatenate(([np.uint64(0)], np.cumsum(_BYTE[data] * up[:len(data)])))
        w = _mix((total[self.end] - total[self.begin]) * down[self.begin])
        self.word_hash, self.word_row = w, np.searchsorted(offsets, self.begin, "right") - 1
        row = self.word_row
        count = np.bincount(row, minlength=rows)
        h, ok = np.zeros(0, np.uint64), np.zeros(0, bool)
        if len(w) >= WORDS:
            h = sum(w[j:len(w) - WORDS + 1 + j] * _PLACE[j] for j in range(WORDS))
            ok = row[:len(h)] == row[WORDS - 1:]
        first = np.flatnonzero(ok)
        short = np.flatnonzero((count > 0) & (count < WORDS))
        at = np.concatenate(([0], np.cumsum(count)))
        extra = np.array([(w[at[r]:at[r + 1]] * _PLACE[:count[r]]).sum() for r in short], np.uint64)
        where = np.concatenate((first, at[short]))
        order = np.argsort(where, kind="stable")
        self.hash = _mix(np.concatenate((h[first], extra)))[order]
        self.word = where[order]
        per_row = np.maximum(count - WORDS + 1, (count > 0).astype(np.int64))
        self.words, self.offsets = count, np.concatenate(([0], np.cumsum(per_row)))

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """First word and hash of every run of ``n`` words of a row."""
        w, row = self.word_hash, self.word_row
        if len(w) < n:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        h = _mix(sum(w[j:len(w) - n + 1 + j] * _PLACE[j] for j in range(n)))
        at = np.flatnonzero(row[:len(h)] == row[n - 1:])
        return at, h[at]

    def text(self, i: int) -> bytes:
        """Words of shingle ``i``, joined by a space."""
        row = np.searchsorted(self.offsets, i, "right") - 1
        return self.run(self.word[i], min(WORDS, self.words[row]))

    def run(self, k: int, n: int) -> bytes:
        """``n`` words from word ``k`` on, joined by a space."""
        return b" ".join(self.data[b:e].tobytes() for b, e in zip(self.begin[k:k + n], self.end[k:k + n], strict=True))


def _minima(h: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """MinHash values (permutations x blocks) of the blocks of ``h`` that begin at ``starts``."""
    return np.stack([np.minimum.reduceat((h ^ x) * m, starts) for x, m in zip(_XOR, _MUL, strict=True)])


def _block_starts(counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of blocks of ``size`` within rows of ``counts`` entries, and blocks for each row."""
    blocks = -(-counts // size)
    first = np.concatenate(([0], np.cumsum(counts)))[:-1]
    row = np.repeat(np.arange(len(counts)), blocks)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    return first[row] + nth * size, blocks


class ItemIndex:
    """MinHash index of one block of items, by size class."""

    def __init__(self, items: list[tuple]) -> None:
        data, offsets = buffers(pa.array([t for _, t in items], pa.string()))
        s = Shingles(data, offsets)
        self.ids, self.texts, self.hashes, self.lengths = [], [], [], []
        for i, (item, _) in enumerate(items):
            lo, hi = s.offsets[i], s.offsets[i + 1]
            if hi > lo:
                self.ids.append(item)
                self.texts.append({s.text(k) for k in range(lo, hi)})
                self.hashes.append(np.unique(s.hash[lo:hi]))
                self.lengths.append(int(s.words[i]))
        self.classes: dict[int, tuple[np.ndarray, dict]] = {}
        by = defaultdict(list)
        # items of fewer words than a shingle has: by length, hash -> items
        self.short: dict[int, dict[int, list[int]]] = {}
        for i, t in enumerate(self.texts):
            n = self.lengths[i]
            if n < WORDS:
                self.short.setdefault(n, {}).setdefault(int(self.hashes[i][0]), []).append(i)
            else:
                by[len(t).bit_length() - 1].append(i)
        for k, members in by.items():
            found, bitmap = defaultdict(list), np.zeros(_BITMAP, bool)
            for i in members:
                for p, v in enumerate(_minima(self.hashes[i], np.array([0]))[:, 0].tolist()):
                    found[p, v].append(i)
                    bitmap[v >> 30 & _BITMAP - 1] = True
            self.classes[k] = (bitmap, dict(found))

    def candidates(self, s: Shingles) -> set[tuple[int, int]]:
        """(row, item) pairs with an equal MinHash value in some window of the item's class."""
        out: set[tuple[int, int]] = set()
        counts = np.diff(s.offsets)
        mins, blocks, level = None, None, None
        for k in sorted(self.classes):
            if not len(s.hash):
                break
            if mins is None:
                starts, blocks = _block_starts(counts, 2 << k)
                mins = _minima(s.hash, starts)
            else:
                starts, blocks = _block_starts(blocks, 1 << (k - level))
                mins = np.minimum.reduceat(mins, starts, axis=1)
            level = k
            row = np.repeat(np.arange(len(blocks)), blocks)
            paired = np.flatnonzero(row[1:] == row[:-1])
            alone = np.flatnonzero(blocks == 1)
            at = np.cumsum(blocks) - blocks
            windows = np.concatenate((np.minimum(mins[:, paired], mins[:, paired + 1]), mins[:, at[alone]]), axis=1)
            of = np.concatenate((row[paired], alone))
            bitmap, found = self.classes[k]
            for p, x in zip(*np.nonzero(bitmap[(windows >> np.uint64(30)) & np.uint64(_BITMAP - 1)]), strict=True):
                out.update((int(of[x]), i) for i in found.get((int(p), int(windows[p, x])), ()))
        return out

    def matches(self, data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int]]:
        """(row, item, shared distinct shingles) of the pairs that pass the exact check."""
        s = Shingles(data, offsets)
        found: set[tuple[int, int]] = set()   # items of fewer words than a shingle has, anywhere in a row
        for n, items in self.short.items():
            at, h = s.grams(n)
            keys = np.array(list(items), np.uint64)
            for k in np.flatnonzero(np.isin(h, keys)).tolist():
                word = int(at[k])
                found.update((int(s.word_row[word]), i) for i in items[int(h[k])] if s.run(word, n) in self.texts[i])
        out = [(row, i, 1) for row, i in found]
        for row, i in sorted(self.candidates(s)):
            lo, hi = s.offsets[row], s.offsets[row + 1]
            at = np.flatnonzero(np.isin(s.hash[lo:hi], self.hashes[i]))
            need = math.ceil(CONTAINMENT * len(self.texts[i]) - 1e-9)
            if len(np.unique(s.hash[lo:hi][at])) >= need:
                shared = len({s.text(lo + int(j)) for j in at} & self.texts[i])
                if shared >= need:
                    out.append((row, i, shared))
        return sorted(out)


def item_blocks(items: DataFrame) -> Iterator[ItemIndex]:
    """Indexes over blocks of items of about ITEM_BYTES of text each; one at a time on the driver."""
    rows = items.select("item_id", F.lower("text").alias("text")).filter("text is not null").distinct()
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-total // ITEM_BYTES)
    for b in range(blocks):
        yield ItemIndex([tuple(r) for r in rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect()])


def contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Pairs doc_id, item_id, shared, item_shingles, containment; docs (doc_id, text), items (item_id, text)."""
    spark = ready(docs.sparkSession)
    schema = (f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, item_id "
              f"{items.schema['item_id'].dataType.simpleString()}, shared long, item_shingles long, containment double")
    rows = docs.select("doc_id", F.lower("text").alias("text"))
    out = spark.createDataFrame([], schema)
    for index in item_blocks(items):
        sent = spark.sparkContext.broadcast(index)

        def run(batches, sent=sent):
            ix = sent.value
            for part, data, offsets in slices(batches):
                got = ix.matches(data, offsets)
                if got:
                    n = [len(ix.texts[i]) for _, i, _ in got]
                    yield pa.RecordBatch.from_arrays([
                        part.column("doc_id").take(pa.array([r for r, _, _ in got], pa.int64())),
                        pa.array([ix.ids[i] for _, i, _ in got]), pa.array([s for _, _, s in got], pa.int64()),
                        pa.array(n, pa.int64()), pa.array([s / m for (_, _, s), m in zip(got, n, strict=True)])],
                        ["doc_id", "item_id", "shared", "item_shingles", "containment"])
        out = out.union(rows.mapInArrow(run, schema))
    return out


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns as they are, that no item contaminates."""
    spark = ready(docs.sparkSession)
    for index in item_blocks(items):
        sent = spark.sparkContext.broadcast(index)

        def run(batches, sent=sent):
            for part, data, offsets in slices(batches, "__dc_text"):
                hit = np.ones(part.num_rows, bool)
                hit[[r for r, _, _ in sent.value.matches(data, offsets)]] = False
                kept = [c.filter(pa.array(hit)) for c in part.columns[:-1]]
                yield pa.RecordBatch.from_arrays(kept, schema=pa.schema(list(part.schema)[:-1]))
        docs = docs.withColumn("__dc_text", F.lower("text")).mapInArrow(run, docs.schema)
    return docs


SQL = f"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(lower(text), '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS w
           FROM documents WHERE text IS NOT NULL),
i AS (SELECT row_number() OVER () AS n, item_id, regexp_extract_all(t, '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS w
      FROM (SELECT DISTINCT item_id, lower(text) AS t FROM benchmark WHERE text IS NOT NULL)),
size AS (SELECT n, item_id, w, least(len(w), {WORDS}) AS z FROM i WHERE len(w) > 0),
want AS (SELECT DISTINCT n, z, unnest(list_transform(range(1, len(w) - z + 2), lambda j: array_to_string(w[j:j + z - 1], ' '))) AS s FROM size),
need AS (SELECT n, z, count(*) AS total FROM want GROUP BY ALL),
have AS (SELECT DISTINCT k, z, unnest(list_transform(range(1, greatest(len(w) - z + 2, 1)), lambda j: array_to_string(w[j:j + z - 1], ' '))) AS s
         FROM d, (SELECT DISTINCT z FROM size)),
hits AS (SELECT have.k, want.n, count(*) AS shared FROM have JOIN want ON have.z = want.z AND have.s = want.s GROUP BY ALL)
SELECT d.doc_id, i.item_id, shared, total AS item_shingles, CAST(shared AS DOUBLE) / total AS containment
FROM hits JOIN need USING (n) JOIN d USING (k) JOIN i USING (n)
WHERE shared >= ceil({CONTAINMENT} * total - 1e-9)
"""
