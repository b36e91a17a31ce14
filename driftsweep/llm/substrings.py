"""Exact removal of repeated 35-word windows by compressed FM-indexes, one for each shard of content.

Result. Words are the runs of bytes other than 0x20 and 0x09-0x0D. A window is ``LENGTH`` = 35 consecutive words
of one document; a word goes if some window that covers it has its word sequence at any other place of the
corpus, the same document included. Windows are judged on the input. Null texts have no words, texts of
fewer than 35 words lose none; every row is a document, whatever its doc_id, so repeated rows empty each
other; an empty table gives no rows; other columns are ignored, whatever their names.

Shards. Streaming every document against the index of every shard of documents would cost the square of
the corpus, so shards hold content: a window's trigger is the smallest hash among its 12-word grams (the
first of equal ones), equal windows have equal triggers wherever they stand, and a shard is a range of trigger
hashes. Documents are written once in batches of bounded bytes, bucketed by batch, so that later rounds
join them without a shuffle of texts. Batches and ranges exchange packed arrays:
  1. triggers of each batch and how often they occur there; back comes a bit for those that occur at
     more than one place (no window of the others can repeat), and one for those at over ``HOT`` places;
  2. for each window of these triggers a hash of its trigger, first and last gram; back comes a bit for those
     that more than one window has. This lets go of the windows that run over the edge of a shared passage,
     of which there may be as many as documents;
  3. runs of the remaining windows with one trigger, as text, each once for each batch. A shard's index
     holds each distinct run, twice if it occurs more than once, and the runs are streamed through
     it: the matching statistics of a run reach 35 at each of its windows, and a window repeats
     if its suffix interval there holds two rows or more. Back comes a bit for each window.
The windows of a trigger at over ``HOT`` places are not kept together: each goes by itself to a shard of its own hash.
Rounds 1 and 2 only let go of windows that occur once; every window that is removed was found in an index.

Index. Suffixes are sorted to depth 35, which is what backward search of 35 words needs; the Burrows-Wheeler
transform of the word ids is kept as a wavelet tree of bit vectors (64-bit words with running counts). All
runs are searched together, last word first: an interval of depth 35 is widened to its depth-34
group and then extended by the next word, one step for each word.

A batch (8 MB of text, or one longer document) and a shard (the repeated text of ``RANGE_BYTES`` of text) must fit in
a task's memory.
"""

from __future__ import annotations

import hashlib
import uuid
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftsweep.llm.common import buffers, cut, ready
from driftsweep.session import scratch_path

LENGTH, GRAM = 35, 12
SPAN = LENGTH - GRAM + 1
BATCH_BYTES = 8 << 20
#: Text bytes for each range of triggers, of window hashes and of runs; the most ranges.
KEY_BYTES, RANGE_BYTES, MAX_RANGES = 32 << 20, 4 << 20, 1 << 16
#: Windows of a trigger at more places are dealt by their own hash.
HOT = 2048
#: Shards of single windows are numbered from here.
_OWN_RANGE = 1 << 30
_PIECE = 1 << 20   # bytes that one hashing step works on
_BLOCK = 100_000   # words that one joining step works on

_rng = np.random.default_rng(12)
_BYTE = _rng.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_powers: list[np.ndarray] = []


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xFF51AFD7ED558CCD)
    return h ^ (h >> np.uint64(32))


def _word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each word. Long words are hashed in steps and combined."""
    if not _powers:
        for b in (_BASE, pow(_BASE, -1, 2**64)):
            _powers.append(np.concatenate(([np.uint64(1)], np.cumprod(np.full(_PIECE, b, np.uint64)))))
    up, down = _powers
    out = np.zeros(len(start), np.uint64)
    for a in range(0, len(data), _PIECE):
        piece = data[a:a + _PIECE]
        total = np.concatenate(([np.uint64(0)], np.cumsum(_BYTE[piece] * up[:len(piece)])))
        i, j = np.searchsorted(end, a, "right"), np.searchsorted(start, a + len(piece), "left")
        s, e = np.maximum(start[i:j] - a, 0), np.minimum(end[i:j] - a, len(piece))
        part = (total[e] - total[s]) * down[s]
        # a word that began in an earlier piece goes on from its hash so far
        out[i:j] = _mix(out[i:j]) * (start[i:j] < a).astype(np.uint64) + part
    return _mix(out + (end - start).astype(np.uint64))


class Parse:
    """Words of a batch of texts, and its windows: start word, trigger and the trigger's place."""

    def __init__(self, text: pa.Array) -> None:
        texts = [t or b"" for t in text.to_pylist()]
        self.raw = b" ".join(texts)
        self.data = data = np.frombuffer(self.raw, np.uint8)
        blank = np.concatenate(([True], (data == 32) | ((data >= 9) & (data <= 13)), [True]))
        edge = np.flatnonzero(blank[1:] != blank[:-1])
        self.start, self.end = edge[::2], edge[1::2]   # word borders
        lens = np.array([len(t) for t in texts], np.int64)
        self.doc = np.searchsorted(np.cumsum(lens + 1), self.start, "right")   # document of each word
        self.n_docs = len(texts)
        h = _word_hashes(data, self.start, self.end)
        self.at = self.first = np.zeros(0, np.int64)
        self.gram = self.key = np.zeros(0, np.uint64)
        if len(h) < LENGTH:
            return
        g = h[:len(h) - GRAM + 1].copy()
        for i in range(1, GRAM):
            g = g * np.uint64(_BASE) + h[i:len(h) - GRAM + 1 + i]
        self.gram = g = _mix(g)
        low = (g >> np.uint64(32) << np.uint64(32)) | np.arange(len(g), dtype=np.uint64)
        width = 1
        while width * 2 <= SPAN:
            low = np.minimum(low[:-width], low[width:])
            width *= 2
        low = np.minimum(low[:len(low) - (SPAN - width)], low[SPAN - width:])
        self.first = np.flatnonzero(self.doc[:len(low)] == self.doc[LENGTH - 1:])   # windows within one document
        self.at = (low[self.first] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        self.key = _mix(g[self.at])   # mixed anew: smallest hashes are small, ranges need even ones

    def triggers(self) -> np.ndarray:
        """Trigger of each place that has one, as often as it occurs."""
        return self.key[np.flatnonzero(np.diff(self.at, prepend=-1))]

    def edges(self, some: np.ndarray) -> np.ndarray:
        """Hash of trigger, first and last gram of windows ``some``."""
        f, g = self.first[some], self.gram
        return _mix(self.key[some] + g[f] * np.uint64(0x9FB21C651E98DF25) + g[f + SPAN - 1] * np.uint64(_BASE))

    def whole(self, some: np.ndarray) -> np.ndarray:
        """Hash of all words of windows ``some``: their grams at three places leave out none."""
        f, g = self.first[some], self.gram
        return _mix(g[f] + g[f + GRAM] * np.uint64(0x9FB21C651E98DF25) + g[f + SPAN - 1] * np.uint64(_BASE))

    def text(self, word: int, words: int) -> bytes:
        """``words`` words from ``word`` on, joined by single spaces."""
        return b" ".join(self.raw[self.start[word]:self.end[word + words - 1]].split())


# ---- packed rows between batches and ranges


def _bits(total: int, size: int) -> int:
    return max(0, min(MAX_RANGES, -(-total // size)) - 1).bit_length()


def _range(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)


_SENT = pa.schema([("batch", pa.int64()), ("kind", pa.int32()), ("range", pa.int32()), ("blob", pa.binary())])
SENT = "batch long, kind int, range int, blob binary"


def _rows(rows: list[tuple]) -> pa.Table:
    cols = list(zip(*rows, strict=True)) if rows else [[]] * 4
    return pa.table([pa.array(c, f.type) for c, f in zip(cols, _SENT, strict=True)], schema=_SENT)


def _by_range(keys: np.ndarray, bits: int):
    """Slices of sorted keys, with their ranges."""
    r = _range(keys, bits)
    new = np.flatnonzero(np.diff(r, prepend=-1))
    for a, b in zip(new, [*new[1:], len(r)], strict=False):
        yield int(r[a]), slice(a, b)


def _send(batch: int, kind: int, keys: np.ndarray, bits: int) -> list[tuple]:
    """Distinct keys of a batch and how often they occur (255 for more), a row for each range."""
    own, n = np.unique(keys, return_counts=True)
    n = np.minimum(n, 255).astype(np.uint8)
    return [(batch, kind, r, own[s].tobytes() + n[s].tobytes()) for r, s in _by_range(own, bits)]


def _repeated(hot: int):
    """Keys that occur at several places: a bit for each key sent, then a bit for those at over ``hot`` places."""

    def run(rows: pa.Table) -> pa.Table:
        blobs = rows.column("blob").to_pylist()
        sizes = [len(b) // 9 for b in blobs]
        keys = np.concatenate([np.frombuffer(b, np.uint64, n) for b, n in zip(blobs, sizes, strict=True)])
        n = np.concatenate([np.frombuffer(b, np.uint8, k, 8 * k) for b, k in zip(blobs, sizes, strict=True)])
        _, of = np.unique(keys, return_inverse=True)
        total = np.bincount(of, n)[of]
        out, at = [], 0
        for batch, kind, r, k in zip(*(rows.column(c).to_pylist() for c in ("batch", "kind", "range")), sizes, strict=True):
            own = total[at:at + k]
            out.append((batch, kind, r, np.packbits(own > 1).tobytes() + np.packbits(own > hot).tobytes()))
            at += k
        return _rows(out)
    return run


def _told(told: pa.Table, kind: int) -> dict[int, bytes]:
    return {r: b for k, r, b in zip(*(told.column(c).to_pylist() for c in ("kind", "range", "blob")), strict=True) if k == kind}


def _flags(keys: np.ndarray, bits: int, told: dict[int, bytes], which: int) -> np.ndarray:
    """For each of the keys sent whether its bit came back set."""
    own, of = np.unique(keys, return_inverse=True)
    flag = np.zeros(len(own), bool)
    for r, s in _by_range(own, bits):
        n = s.stop - s.start
        bytes_ = -(-n // 8)
        flag[s] = np.unpackbits(np.frombuffer(told[r], np.uint8, bytes_, which * bytes_), count=n)
    return flag[of]


class Runs:
    """The runs of a batch that rounds 1 and 2 leave: distinct texts by shard, and where they stand."""

    def __init__(self, p: Parse, told: pa.Table, bits: int, run_bits: int) -> None:
        one, two = _told(told, 1), _told(told, 2)
        some = np.flatnonzero(_flags(p.key, bits, one, 0)) if len(p.key) else np.zeros(0, np.int64)
        some = some[_flags(p.edges(some), bits, two, 0)] if len(some) else some
        own = _flags(p.key, bits, one, 1)[some] if len(some) else np.zeros(0, bool)
        # a run: neighbouring windows with one trigger; a window of a hot trigger is a run of its own
        new = np.flatnonzero((np.diff(p.first[some], prepend=-2) != 1) | (np.diff(p.at[some], prepend=-1) != 0) | own)
        self.word, self.size = p.first[some[new]], np.diff(np.append(new, len(some)))   # first word, windows
        shard = _range(p.key[some[new]], run_bits)
        shard[own[new]] = _OWN_RANGE + _range(p.whole(some[new][own[new]]), run_bits)
        self.texts: dict[int, dict[bytes, list[int]]] = {}   # shard -> text -> its runs
        for i, (r, word, size) in enumerate(zip(shard.tolist(), self.word.tolist(), self.size.tolist(), strict=True)):
            self.texts.setdefault(r, {}).setdefault(p.text(word, size + LENGTH - 1), []).append(i)


# ---- the index


class Bits:
    """A bit vector: 64-bit words with running counts, for counts of ones before any place."""

    def __init__(self, bits: np.ndarray) -> None:
        padded = np.zeros(-(-(len(bits) + 1) // 64) * 64, np.uint8)
        padded[:len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        ones = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.cumsum(ones) - ones
        self.zeros = len(bits) - int(ones.sum())

    def ones(self, place: np.ndarray) -> np.ndarray:
        w = place >> 6
        low = (np.uint64(1) << (place & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[w] + np.bitwise_count(self.words[w] & low)


class FmIndex:
    """FM-index of a sequence of symbols (0: separator), for patterns of up to ``depth`` symbols."""

    def __init__(self, seq: np.ndarray, depth: int = LENGTH) -> None:
        self.n = n = len(seq)
        self.depth = depth
        rank, reach = np.unique(seq, return_inverse=True)[1].astype(np.int64) + 1, 1

        def pair(step: int) -> np.ndarray:
            """Rank of each place and of the place ``step`` on, as one number."""
            later = np.zeros(n, np.int64)
            later[:max(n - step, 0)] = rank[step:]
            return (rank << 32) | later
        while reach * 2 < depth:
            rank = np.unique(pair(reach), return_inverse=True)[1].astype(np.int64) + 1
            reach *= 2
        full, near = pair(depth - reach), pair(depth - 1 - reach) if depth > 1 else np.zeros(n, np.int64)
        order = np.argsort(full, kind="stable")   # suffixes, sorted to the depth
        near = near[order]                          # depth - 1 (its order is the same)
        new = np.flatnonzero(np.diff(near, prepend=-1))
        group = np.repeat(np.arange(len(new)), np.diff(np.append(new, n)))
        self.low, self.high = new[group], np.append(new[1:], n)[group]
        last = seq[order - 1]                       # Burrows-Wheeler transform; the text is taken as a circle
        top = int(seq.max()) + 1 if n else 1
        self.levels: list[Bits] = []
        for b in reversed(range(max(1, (top - 1).bit_length()))):
            bit = (last >> b) & 1
            self.levels.append(Bits(bit.astype(np.uint8)))
            last = np.concatenate((last[bit == 0], last[bit == 1]))
        symbols = np.arange(top)
        smaller = np.concatenate(([0], np.cumsum(np.bincount(seq, minlength=top))[:-1]))
        self.shift = smaller - self._down(symbols, np.zeros(top, np.int64))

    def _down(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        for b, level in zip(reversed(range(len(self.levels))), self.levels, strict=True):
            ones = level.ones(place)
            place = np.where((symbol >> b) & 1, level.zeros + ones, place - ones)
        return place

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the patterns with ``symbol`` put in front."""
        both = self._down(np.concatenate((symbol, symbol)), np.concatenate((low, high)))
        shift = self.shift[symbol]
        return both[:len(low)] + shift, both[len(low):] + shift

    def matches(self, text: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Rows of the index that match at each place of the indexed strings text[begin:begin + size]: the size of the
        interval where the matching statistic reaches the depth, else 0. Longer strings first."""
        out = np.zeros(len(text), np.int64)
        low, high = np.zeros(len(begin), np.int64), np.full(len(begin), self.n, np.int64)
        for step in range(1, int(size[0]) + 1 if len(size) else 0):
            k = int(np.searchsorted(-size, -step, "right"))   # strings that are long enough
            a, b = low[:k], high[:k]
            if step > self.depth:
                a, b = self.low[a], self.high[a]
            place = begin[:k] + size[:k] - step
            a, b = self.extend(text[place], a, b)
            low[:k], high[:k] = a, b
            if step >= self.depth:
                out[place] = b - a
        return out


def _search(rows: pa.Table) -> pa.Table:
    """One shard: index of its distinct runs, a bit for each window of each run that was sent."""
    sent, texts, times = [], {}, []
    for blob in rows.column("blob").to_pylist():
        n = int.from_bytes(blob[:8], "little")
        lens, several = np.frombuffer(blob, np.int64, n, 8), np.frombuffer(blob, np.uint8, n, 8 + 8 * n)
        at, own = 8 + 9 * n, []
        for k, more in zip(lens.tolist(), several.tolist(), strict=True):
            i = texts.setdefault(blob[at:at + k], len(texts))
            at += k
            if i == len(times):
                times.append(0)
            times[i] += 1 + more
            own.append(i)
        sent.append(own)
    ids: dict[bytes, int] = {}
    word = lambda w: ids.setdefault(w, len(ids) + 1)
    runs = [np.fromiter(map(word, t.split(b" ")), np.int64) for t in texts]
    apart = np.zeros(1, np.int64)
    seq = np.concatenate([x for r, n in zip(runs, times, strict=True) for x in (r, apart) * min(n, 2)])
    size = np.array([len(r) for r in runs])
    order = np.argsort(-size, kind="stable")
    text = np.concatenate(runs)
    begin = np.cumsum(size) - size
    found = FmIndex(seq).matches(text, begin[order], size[order]) > 1
    windows = [found[a:a + n - LENGTH + 1] for a, n in zip(begin.tolist(), size.tolist(), strict=True)]
    out = [(batch, 3, r, np.packbits(np.concatenate([windows[i] for i in own])).tobytes())
           for batch, r, own in zip(rows.column("batch").to_pylist(), rows.column("range").to_pylist(), sent, strict=True)]
    return _rows(out)


# ---- rounds


def _texts(docs: pa.Table) -> pa.Array:
    col = docs.column("text").combine_chunks()
    return pa.concat_arrays(col.chunks) if isinstance(col, pa.ChunkedArray) else col


def _send_triggers(bits: int):
    def run(docs: pa.Table) -> pa.Table:
        return _rows(_send(docs.column("batch")[0].as_py(), 1, Parse(_texts(docs)).triggers(), bits))
    return run


def _send_windows(bits: int):
    def run(docs: pa.Table, told: pa.Table) -> pa.Table:
        p = Parse(_texts(docs))
        if not len(p.key):
            return _rows([])
        some = np.flatnonzero(_flags(p.key, bits, _told(told, 1), 0))
        return _rows(_send(docs.column("batch")[0].as_py(), 2, p.edges(some), bits))
    return run


def _send_runs(bits: int, run_bits: int):
    def run(docs: pa.Table, told: pa.Table) -> pa.Table:
        batch, out = docs.column("batch")[0].as_py(), []
        for r, texts in Runs(Parse(_texts(docs)), told, bits, run_bits).texts.items():
            lens = np.array([len(t) for t in texts], np.int64)
            several = np.array([len(places) > 1 for places in texts.values()], np.uint8)
            out.append((batch, 3, r, len(texts).to_bytes(8, "little") + lens.tobytes() + several.tobytes() + b"".join(texts)))
        return _rows(out)
    return run


def _remove(bits: int, run_bits: int):
    def run(docs: pa.Table, told: pa.Table) -> pa.Table:
        p = Parse(_texts(docs))
        runs, answers = Runs(p, told, bits, run_bits), _told(told, 3)
        edge = np.zeros(len(p.start) + 1, np.int64)
        for r, texts in runs.texts.items():
            n = [int(runs.size[places[0]]) for places in texts.values()]
            hit, at = np.unpackbits(np.frombuffer(answers[r], np.uint8)), 0
            for k, places in zip(n, texts.values(), strict=True):
                own = np.flatnonzero(hit[at:at + k])
                at += k
                for i in places:
                    np.add.at(edge, runs.word[i] + own, 1)
                    np.add.at(edge, runs.word[i] + own + LENGTH, -1)
        kept = np.cumsum(edge[:-1]) == 0
        border = np.searchsorted(p.doc, np.arange(p.n_docs + 1))
        out = []
        for a, b in zip(border[:-1].tolist(), border[1:].tolist(), strict=True):
            sha, joint = hashlib.sha256(), b""
            for i in range(a, b, _BLOCK):
                j = min(b, i + _BLOCK)
                text = b" ".join(compress(p.raw[p.start[i]:p.end[j - 1]].split(), kept[i:j].tolist()))
                if text:   # no word is empty
                    sha.update(joint + text)
                    joint = b" "
            out.append((b - a, b - a - int(kept[a:b].sum()), sha.hexdigest()))
        return pa.table({"doc_id": docs.column("doc_id"), "n_words": pa.array([o[0] for o in out], pa.int64()),
                         "n_removed": pa.array([o[1] for o in out], pa.int64()),
                         "kept_sha256": pa.array([o[2] for o in out], pa.string())})
    return run


def _stage(docs: DataFrame, total: int, size: int) -> DataFrame:
    """The documents in batches, written once to the shared folder, bucketed by batch."""
    spark = docs.sparkSession

    def number(batches):
        task, batch, held = TaskContext.get().partitionId(), 0, 0
        for b in batches:
            ids = np.empty(b.num_rows, np.int64)
            for i, n in enumerate(np.diff(buffers(b.column("text"))[1]).tolist()):
                if held and held + n > size:
                    batch, held = batch + 1, 0
                held += n
                ids[i] = (task << 32) + batch
            yield pa.RecordBatch.from_arrays([pa.array(ids), *b.columns], ["batch", *b.schema.names])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    name = f"substrings_{uuid.uuid4().hex[:12]}"
    buckets = min(100_000, max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // (4 * size))))
    (rows.mapInArrow(number, "batch long, doc_id long, text binary").write.format("parquet")
     .bucketBy(buckets, "batch").option("path", scratch_path(spark, name)).option("compression", "zstd").saveAsTable(name))
    staged = spark.table(name)
    spark.sql(f"DROP TABLE {name}")   # the entry in the catalog only: the files are the scratch folder's
    return staged


def remove_repeated(docs: DataFrame, batch_bytes: int = BATCH_BYTES, key_bytes: int = KEY_BYTES,
                    range_bytes: int = RANGE_BYTES, hot: int = HOT) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 for every row of docs (doc_id, text)."""
    spark = ready(docs.sparkSession)
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits, run_bits = _bits(total, key_bytes), _bits(total, range_bytes)
    staged = _stage(docs, total, max(batch_bytes, total >> 19))
    answer = _repeated(hot)
    batches = lambda told: staged.groupBy("batch").cogroup(told.groupBy("batch"))
    one = cut(staged.groupBy("batch").applyInArrow(_send_triggers(bits), SENT).groupBy("range").applyInArrow(answer, SENT))
    two = cut(batches(one).applyInArrow(_send_windows(bits), SENT).groupBy("range").applyInArrow(answer, SENT))
    three = batches(one.union(two)).applyInArrow(_send_runs(bits, run_bits), SENT).groupBy("range").applyInArrow(_search, SENT)
    return batches(one.union(two).union(three)).applyInArrow(
        _remove(bits, run_bits), "doc_id long, n_words long, n_removed long, kept_sha256 string")


SQL = f"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT k, unnest(list_transform(range(1, len(w) - {LENGTH - 2}), lambda i: [CAST(i AS VARCHAR), array_to_string(w[i:i + {LENGTH - 1}], ' ')])) AS x
      FROM d WHERE len(w) >= {LENGTH}),
r AS (SELECT k, CAST(x[1] AS BIGINT) AS i, count(*) OVER (PARTITION BY x[2]) > 1 AS twice FROM s),
words AS (SELECT k, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM d),
c AS (SELECT words.k, words.i, word, coalesce(max(twice::INTEGER) OVER (PARTITION BY words.k ORDER BY words.i
             ROWS BETWEEN {LENGTH - 1} PRECEDING AND CURRENT ROW), 0) AS gone
      FROM words LEFT JOIN r ON r.k = words.k AND r.i = words.i),
o AS (SELECT k, count(*) AS n, sum(gone) AS g, string_agg(word, ' ' ORDER BY i) FILTER (WHERE gone = 0) AS kept FROM c GROUP BY k)
SELECT d.doc_id, coalesce(n, 0) AS n_words, CAST(coalesce(g, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN o USING (k)
"""
