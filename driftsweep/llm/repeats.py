"""Exact removal of repeated 50-byte strings by prefix-free parsing.

Result. A byte is removed if a string of ``LENGTH`` = 50 bytes that covers it also starts in a document
with a smaller doc_id (overlaps count; strings are judged on the input; none crosses documents).
Null and empty texts have no bytes. A null doc_id is larger than all others; rows with equal
doc_id are not smaller than each other, so copies under one id stay. An empty table gives no rows.
Other columns are ignored.

Parsing. A rolling hash runs over all 25-byte strings; the trigger of a 50-byte string is the
smallest hash in it (the first of equal ones), and a phrase is a run of 50-byte strings with one
trigger. Neighbouring phrases overlap by 49 bytes, so every 50-byte string lies in exactly one phrase,
equal strings have equal triggers wherever they stand, and the corpus order of 50-byte strings needs
the suffix array of the dictionary (the distinct phrases, each with its smallest doc_id) only; the
parse (a document's row of phrases) tells where its entries apply.

Distribution. Documents are written once to the shared folder in batches of bounded bytes, as a
table bucketed by batch, so later rounds join it without a shuffle of texts. Batches and ranges of
trigger hashes exchange packed arrays in three rounds:
  1. trigger hashes of each batch (5 bytes each); back come those that some other batch has too;
  2. of each of these triggers at most two phrases (hash, smallest doc_id in the batch) and the number
     of its phrases; back comes the smallest doc_id of all for triggers with one phrase, and a request
     for the text of the others;
  3. those phrases' texts: distinct ones form the dictionary of the range, its suffix array (to depth
     50) brings equal strings together; back comes the smallest doc_id for each string of a phrase.
     At the edges of a shared passage a trigger has as many phrases as documents hold it. The strings of
     triggers with over ``HOT`` phrases are not kept together: each goes, as bytes, to a range of
     its own hash.
Every exchange holds an entry once for each batch, however often it repeats there, so a passage that
a third of all documents share adds one entry for each batch, not one for each document. Phrases are
told apart by 64-bit hashes within one trigger (48 bits sent less would do), and so are the strings of a hot
trigger within one batch; strings of different batches are compared as bytes.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftsweep.llm.common import buffers, cut, ready
from driftsweep.session import scratch_path

LENGTH, TRIGGER = 50, 25
WINDOW = LENGTH - TRIGGER + 1
BATCH_BYTES = 8 << 20
#: Text bytes for each range of trigger hashes, and the most ranges.
RANGE_BYTES, MAX_RANGES = 4 << 20, 1 << 16
#: A trigger with more phrases, summed over the batches, has its strings dealt by their own hash.
HOT = 2048
#: Ranges of strings of hot triggers are numbered from here.
_OWN_RANGE = 1 << 30
_PIECE = 1 << 20
_LAST = np.int64(2**63 - 1)

_rng = np.random.default_rng(8)
_BYTE = _rng.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_tables: list[np.ndarray] = []


def _powers() -> list[np.ndarray]:
    """Powers of the base and its inverse modulo 2^64, for a piece."""
    if not _tables:
        for b in (_BASE, pow(_BASE, -1, 2**64)):
            _tables.append(np.concatenate(([np.uint64(1)], np.cumprod(np.full(2 * _PIECE, b, np.uint64)))))
    return _tables


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xFF51AFD7ED558CCD)
    return h ^ (h >> np.uint64(32))


def _piece_phrases(data: np.ndarray, row: np.ndarray):
    """First and last string start of each phrase, its trigger's hash, its own hash."""
    n = len(data)
    up, down = _powers()
    total = np.concatenate(([np.uint64(0)], np.cumsum(_BYTE[data] * up[:n])))
    g = _mix((total[TRIGGER:] - total[:-TRIGGER]) * down[:n - TRIGGER + 1])
    low = (g >> np.uint64(32) << np.uint64(32)) | np.arange(len(g), dtype=np.uint64)
    width = 1
    while width * 2 <= WINDOW:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    low = np.minimum(low[:len(low) - (WINDOW - width)], low[WINDOW - width:])
    start = np.flatnonzero(row[:len(low)] == row[LENGTH - 1:])  # strings within one document
    if not len(start):
        z = np.zeros(0, np.int64)
        return z, z, z.astype(np.uint64), z.astype(np.uint64)
    at = (low[start] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1]) | (start[1:] != start[:-1] + 1))))
    first, last = start[new], start[np.concatenate((new[1:] - 1, [len(start) - 1]))]
    own = _mix((total[last + LENGTH] - total[first]) * down[first] + (last - first).astype(np.uint64))
    return first, last, _mix(g[at[new]]), own  # mixed anew: smallest hashes are small, ranges need even ones


class Parse:
    """Phrases of a batch: ``first`` and ``last`` string start (in the batch's bytes), row, trigger, hash."""

    def __init__(self, docs: pa.Table) -> None:
        docs = docs.combine_chunks()
        text = docs.column("text").combine_chunks()
        if isinstance(text, pa.ChunkedArray):
            text = pa.concat_arrays(text.chunks) if text.num_chunks else pa.array([], text.type)
        self.data, self.offsets = buffers(text)
        ids = docs.column("doc_id")
        self.ids = np.array([_LAST if x is None else x for x in ids.to_pylist()], np.int64)
        parts = []
        # pieces of bounded size; a cut inside a document only cuts a phrase in two
        row_of = lambda a, b: np.searchsorted(self.offsets, np.arange(a, b), "right") - 1
        for a in range(0, len(self.data), _PIECE):
            b = min(len(self.data), a + _PIECE + LENGTH - 1)
            if b - a < LENGTH:
                continue
            row = row_of(a, b)
            f, e, g, u = _piece_phrases(self.data[a:b], row)
            parts.append((f + a, e + a, row[f], g, u))
        cat = lambda i, t: np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, t)
        self.first, self.last, self.row = cat(0, np.int64), cat(1, np.int64), cat(2, np.int64)
        self.trigger, self.own = cat(3, np.uint64), cat(4, np.uint64)
        self.doc = self.ids[self.row] if len(self.row) else np.zeros(0, np.int64)

    def text(self, k: np.ndarray) -> tuple[bytes, np.ndarray]:
        """Bytes of phrases ``k`` end to end, and their lengths."""
        n = self.last[k] + LENGTH - self.first[k]
        at = np.repeat(self.first[k] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return self.data[at].tobytes(), n

    def strings(self, k: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts of the strings of phrases ``k``, each string's phrase and hash."""
        n = self.last[k] - self.first[k] + 1
        of = np.repeat(k, n)
        start = self.first[of] + np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
        up, h = _powers()[0], np.zeros(len(of), np.uint64)
        for j in range(LENGTH):
            h += _BYTE[self.data[start + j]] * up[j]
        return start, of, _mix(h)


def pack(*arrays: np.ndarray) -> bytes:
    raw = [np.ascontiguousarray(a).tobytes() for a in arrays]
    return np.array([len(r) for r in raw], np.int64).tobytes() + b"".join(raw)


def unpack(blob: bytes, *types) -> list[np.ndarray]:
    sizes, at, out = np.frombuffer(blob, np.int64, len(types)), 8 * len(types), []
    for t, n in zip(types, sizes, strict=True):
        out.append(np.frombuffer(blob, t, n // np.dtype(t).itemsize, at))
        at += n
    return out


def _squeeze(a: np.ndarray) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(a).tobytes()), np.uint8)


def _stretch(a: np.ndarray, t) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(a.tobytes()), t)


def _five(keys: np.ndarray) -> np.ndarray:
    return keys.view(np.uint8).reshape(-1, 8)[:, :5].copy()


def _eight(raw: np.ndarray) -> np.ndarray:
    out = np.zeros((len(raw) // 5, 8), np.uint8)
    out[:, :5] = raw.reshape(-1, 5)
    return out.view(np.uint64).ravel()


def _rows(**cols) -> pa.Table:
    types = {"batch": pa.int64(), "range": pa.int32(), "kind": pa.int32(), "blob": pa.binary()}
    return pa.table({k: pa.array(v, types[k]) for k, v in cols.items()})


def _by_range(keys: np.ndarray, bits: int):
    """Order by trigger hash, and (range, slice) of each range that has keys; 40 bits of a key are sent."""
    order = np.argsort(keys, kind="stable")
    rng = (keys[order] >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
    cuts = np.flatnonzero(np.diff(rng, prepend=-1, append=1 << 40))
    return order, [(int(rng[a]), slice(a, b)) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def _sent(keys: np.ndarray, bits: int) -> np.ndarray:
    """The 40 bits below the range's own, as the low bits."""
    return keys << np.uint64(bits) >> np.uint64(24)


def _lookup(sorted_keys: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key its place in ``sorted_keys`` and whether it is there."""
    if not len(sorted_keys):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return at, sorted_keys[at] == keys


def _once(keys: np.ndarray, doc: np.ndarray):
    """Distinct keys: a place of each, its smallest doc, whether other docs have it."""
    order = np.lexsort((doc, keys))
    if not len(order):
        return order, doc, np.zeros(0, bool)
    new = np.flatnonzero(np.concatenate(([True], keys[order][1:] != keys[order][:-1])))
    low = doc[order[new]]
    return order[new], low, np.maximum.reduceat(doc[order], new) > low


def _distinct(parse: Parse, chosen: np.ndarray):
    """Distinct phrases among ``chosen``: a place of each, its smallest doc, whether other docs have it."""
    at, low, more = _once(parse.own[chosen], parse.doc[chosen])
    return chosen[at], low, more


def _send_triggers(bits: int):
    def run(docs: pa.Table) -> pa.Table:
        p = Parse(docs)
        keys = np.unique(p.trigger)
        order, ranges = _by_range(keys, bits)
        batch = docs.column("batch")[0].as_py()
        return _rows(batch=[batch] * len(ranges), range=[r for r, _ in ranges],
                     blob=[pack(_five(_sent(keys[s], bits))) for _, s in ranges])
    return run


def _shared_triggers(rows: pa.Table) -> pa.Table:
    each = [_eight(unpack(b, np.uint8)[0]) for b in rows.column("blob").to_pylist()]
    every = np.sort(np.concatenate(each))
    dup = every[1:][every[1:] == every[:-1]]
    out = []
    for batch, keys in zip(rows.column("batch").to_pylist(), each, strict=True):
        got = keys[_lookup(dup, keys)[1]]
        if len(got):
            out.append((batch, pack(_five(got))))
    r = rows.column("range")[0].as_py()
    return _rows(batch=[b for b, _ in out], range=[r] * len(out), blob=[x for _, x in out])


def _send_phrases(bits: int):
    def run(docs: pa.Table, told: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return _rows(batch=[], range=[], blob=[])
        p = Parse(docs)
        known = [(np.uint64(r) << np.uint64(40)) | _eight(unpack(b, np.uint8)[0])
                 for r, b in zip(told.column("range").to_pylist(), told.column("blob").to_pylist(), strict=True)]
        known = np.sort(np.concatenate(known)) if known else np.zeros(0, np.uint64)
        full = p.trigger >> np.uint64(24 - bits)
        shared = _lookup(known, full)[1]
        order = np.lexsort((p.doc, p.trigger))  # triggers that two documents of this batch have
        t, d = p.trigger[order], p.doc[order]
        two = np.unique(t[1:][(t[1:] == t[:-1]) & (d[1:] != d[:-1])])
        shared |= _lookup(two, p.trigger)[1]
        k, low, more = _distinct(p, np.flatnonzero(shared))
        order = np.argsort(p.trigger[k], kind="stable")
        k, low, more = k[order], low[order], more[order]
        head = np.flatnonzero(np.diff(p.trigger[k], prepend=~p.trigger[k[:1]]))  # first phrase of each trigger
        size = np.diff(head, append=len(k))
        number = np.zeros(len(k), np.uint32)
        number[head] = size
        two = np.sort(np.concatenate((head, head[size > 1] + 1)))  # a second one tells that there are several
        k, low, more, number = k[two], low[two], more[two], number[two]
        _, ranges = _by_range(p.trigger[k], bits)
        ids = np.unique(p.ids)
        doc = (np.searchsorted(ids, low).astype(np.uint32) << np.uint32(1)) | more.astype(np.uint32)
        batch, out = docs.column("batch")[0].as_py(), []
        for r, s in ranges:
            used = np.unique(doc[s] >> np.uint32(1))
            place = np.searchsorted(used, doc[s] >> np.uint32(1)).astype(np.uint32) << np.uint32(1) | doc[s] & np.uint32(1)
            out.append((r, pack(_five(_sent(p.trigger[k[s]], bits)), p.own[k[s]], place, ids[used], number[s])))
        return _rows(batch=[batch] * len(out), range=[r for r, _ in out], blob=[b for _, b in out])
    return run


def _smallest(rows: pa.Table, hot: int) -> pa.Table:
    """Kind 0: phrase to smallest doc_id (triggers with one phrase). A request for all phrases of a
    phrase's trigger: kind 1, kind 3 for a trigger of over ``hot`` phrases."""
    got = [unpack(b, np.uint8, np.uint64, np.uint32, np.int64, np.uint32) for b in rows.column("blob").to_pylist()]
    n = [len(g[1]) for g in got]
    trigger, own = np.concatenate([_eight(g[0]) for g in got]), np.concatenate([g[1] for g in got])
    doc = np.concatenate([g[3][g[2] >> np.uint32(1)] for g in got])
    more = np.concatenate([(g[2] & np.uint32(1)).astype(bool) for g in got])
    order = np.lexsort((own, trigger))
    t, u = trigger[order], own[order]
    starts = np.flatnonzero(np.concatenate(([True], t[1:] != t[:-1])))
    group = np.cumsum(np.concatenate(([False], t[1:] != t[:-1])))
    low = np.minimum.reduceat(doc[order], starts)[group]
    several = (np.minimum.reduceat(u, starts) != np.maximum.reduceat(u, starts))[group]
    number = np.concatenate([g[4] for g in got]).astype(np.int64)
    many = (np.add.reduceat(number[order], starts) > hot)[group]
    smallest, ask, deal = np.empty(len(doc), np.int64), np.empty(len(doc), bool), np.empty(len(doc), bool)
    smallest[order], ask[order], deal[order] = low, several, several & many
    tell = ~ask & ((smallest < doc) | more)
    out, at = [], 0
    for batch, m in zip(rows.column("batch").to_pylist(), n, strict=True):
        s = slice(at, at + m)
        at += m
        if tell[s].any():
            out.append((batch, 0, pack(own[s][tell[s]], _squeeze(smallest[s][tell[s]]))))
        for kind, want in ((1, ask[s] & ~deal[s]), (3, deal[s])):
            if want.any():
                out.append((batch, kind, pack(own[s][want])))
    return _rows(batch=[o[0] for o in out], kind=[o[1] for o in out], blob=[o[2] for o in out])


def _send_texts(bits: int):
    def run(docs: pa.Table, told: pa.Table) -> pa.Table:
        asked: dict[int, list[np.ndarray]] = {1: [], 3: []}
        for b, k in zip(told.column("blob").to_pylist(), told.column("kind").to_pylist(), strict=True):
            asked[k].append(unpack(b, np.uint64)[0])
        if not told.num_rows or not docs.num_rows:
            return _rows(batch=[], range=[], blob=[])
        p = Parse(docs)

        def phrases_of(kind):  # all phrases of the asked ones' triggers
            own = np.sort(np.concatenate(asked[kind])) if asked[kind] else np.zeros(0, np.uint64)
            return np.flatnonzero(_lookup(np.unique(p.trigger[_lookup(own, p.own)[1]]), p.trigger)[1])

        k, low, _ = _distinct(p, phrases_of(1))
        order, ranges = _by_range(p.trigger[k], bits)
        k, low = k[order], low[order]
        batch, out = docs.column("batch")[0].as_py(), []
        for r, s in ranges:
            text, n = p.text(k[s])
            out.append((r, pack(p.own[k[s]], low[s], n, _squeeze(np.frombuffer(text, np.uint8)))))
        start, of, h = p.strings(phrases_of(3))
        at, low, more = _once(h, p.doc[of])
        start, of, h = start[at], of[at], h[at]
        order, ranges = _by_range(h, bits)
        for r, s in ranges:
            i = order[s]
            out.append((_OWN_RANGE + r, pack(h[i], _squeeze(low[i]), _squeeze(more[i]), _squeeze(p.trigger[of[i]]),
                                             _squeeze(p.data[start[i][:, None] + np.arange(LENGTH)]))))
        return _rows(batch=[batch] * len(out), range=[r for r, _ in out], blob=[b for _, b in out])
    return run


def string_order(dictionary: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array, to depth LENGTH, of the strings at ``starts``; where a string differs from the one before."""
    padded = np.concatenate((dictionary, np.zeros(8, np.uint8)))
    words = []
    for at in range(0, LENGTH, 8):
        w = np.zeros(len(starts), np.uint64)
        for j in range(min(8, LENGTH - at)):
            w = w << np.uint64(8) | padded[starts + at + j].astype(np.uint64)
        words.append(w)
    order = np.lexsort(words[::-1])
    new = np.ones(len(order), bool)
    new[1:] = np.any([w[order][1:] != w[order][:-1] for w in words], axis=0) if len(order) else False
    return order, new


def _dealt(rows: pa.Table) -> pa.Table:
    """Smallest doc_id of each string of a hot trigger dealt to this range, where it matters to the batch."""
    got = [unpack(b, np.uint64, *[np.uint8] * 4) for b in rows.column("blob").to_pylist()]
    n = [len(g[0]) for g in got]
    doc = np.concatenate([_stretch(g[1], np.int64) for g in got])
    order, new = string_order(np.concatenate([_stretch(g[4], np.uint8) for g in got]), np.arange(len(doc)) * LENGTH)
    smallest = np.empty(len(doc), np.int64)
    smallest[order] = np.minimum.reduceat(doc[order], np.flatnonzero(new))[np.cumsum(new) - 1]
    out, at = [], 0
    for batch, g, m in zip(rows.column("batch").to_pylist(), got, n, strict=True):
        low = smallest[at:at + m]
        tell = (low < doc[at:at + m]) | _stretch(g[2], bool)
        at += m
        if tell.any():
            out.append((batch, pack(g[0][tell], _squeeze(low[tell]), np.unique(_stretch(g[3], np.uint64)[tell]))))
    return _rows(batch=[b for b, _ in out], kind=[3] * len(out), blob=[x for _, x in out])


def _strings(rows: pa.Table) -> pa.Table:
    """Smallest doc_id of every 50-byte string of the phrases, or of the strings, sent to this range."""
    if rows.column("range")[0].as_py() >= _OWN_RANGE:
        return _dealt(rows)
    got = [unpack(b, np.uint64, np.int64, np.int64, np.uint8) for b in rows.column("blob").to_pylist()]
    texts = [_stretch(g[3], np.uint8) for g in got]
    found: dict[bytes, int] = {}  # the dictionary: distinct phrases
    low: list[int] = []
    places = []
    for g, text in zip(got, texts, strict=True):
        raw, at, own = text.tobytes(), 0, []
        for n, d in zip(g[2].tolist(), g[1].tolist(), strict=True):
            phrase = raw[at:at + n]
            at += n
            i = found.setdefault(phrase, len(found))
            if i == len(low):
                low.append(d)
            elif d < low[i]:
                low[i] = d
            own.append(i)
        places.append(np.array(own, np.int64))
    dictionary = np.frombuffer(b"".join(found), np.uint8)
    n = np.array([len(x) for x in found], np.int64)
    begin = np.cumsum(n) - n
    count = n - LENGTH + 1
    of = np.repeat(np.arange(len(n)), count)
    string0 = np.cumsum(count) - count
    starts = begin[of] + np.arange(len(of)) - string0[of]
    order, new = string_order(dictionary, starts)
    least = np.minimum.reduceat(np.array(low, np.int64)[of[order]], np.flatnonzero(new))
    smallest = np.empty(len(of), np.int64)
    smallest[order] = least[np.cumsum(new) - 1]
    out = []
    for batch, g, own in zip(rows.column("batch").to_pylist(), got, places, strict=True):
        c = count[own]
        at = np.repeat(string0[own] - (np.cumsum(c) - c), c) + np.arange(c.sum())
        out.append((batch, pack(g[0], c, _squeeze(smallest[at]))))
    return _rows(batch=[b for b, _ in out], kind=[2] * len(out), blob=[x for _, x in out])


def _remove(docs: pa.Table, told: pa.Table) -> pa.Table:
    p = Parse(docs)
    hit = np.zeros(len(p.data) + 1, bool)  # starts of repeated strings
    simple, strings, dealt = [], [], []
    for kind, blob in zip(told.column("kind").to_pylist(), told.column("blob").to_pylist(), strict=True):
        if kind == 0:
            own, d = unpack(blob, np.uint64, np.uint8)
            simple.append((own, _stretch(d, np.int64)))
        elif kind == 2:
            own, c, d = unpack(blob, np.uint64, np.int64, np.uint8)
            strings.append((own, c, _stretch(d, np.int64)))
        else:
            h, d, trigger = unpack(blob, np.uint64, np.uint8, np.uint64)
            dealt.append((h, _stretch(d, np.int64), trigger))
    edge = np.zeros(len(p.data) + 2, np.int32)
    if simple:
        own, low = np.concatenate([s[0] for s in simple]), np.concatenate([s[1] for s in simple])
        order = np.argsort(own)
        at, ok = _lookup(own[order], p.own)
        ok &= low[order][at] < p.doc
        np.add.at(edge, p.first[ok], 1)
        np.add.at(edge, p.last[ok] + 1, -1)
    hit = np.cumsum(edge[:-1]) > 0
    if strings:
        own, c = np.concatenate([s[0] for s in strings]), np.concatenate([s[1] for s in strings])
        low = np.concatenate([s[2] for s in strings])
        order, at0 = np.argsort(own), np.cumsum(c) - c
        at, ok = _lookup(own[order], p.own)
        k = np.flatnonzero(ok)
        n = p.last[k] - p.first[k] + 1
        nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        low = low[np.repeat(at0[order[at[k]]], n) + nth]
        where = np.repeat(p.first[k], n) + nth
        hit[where[low < np.repeat(p.doc[k], n)]] = True
    if dealt:
        h, low = np.concatenate([s[0] for s in dealt]), np.concatenate([s[1] for s in dealt])
        hot = np.unique(np.concatenate([s[2] for s in dealt]))
        order = np.argsort(h)
        where, of, own = p.strings(np.flatnonzero(_lookup(hot, p.trigger)[1]))
        at, ok = _lookup(h[order], own)
        hit[where[ok & (low[order][at] < p.doc[of])]] = True
    edge[:] = 0
    starts = np.flatnonzero(hit[:len(p.data)])
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + LENGTH, -1)
    gone = np.cumsum(edge)[:len(p.data)] > 0
    out = []
    for i in range(docs.num_rows):
        a, b = p.offsets[i], p.offsets[i + 1]
        own = gone[a:b]
        out.append((int(b - a), int(own.sum()), int((own & ~np.concatenate(([False], own[:-1]))).sum()) if b > a else 0,
                    hashlib.sha256(p.data[a:b][~own].tobytes()).hexdigest()))
    return pa.table({"doc_id": docs.column("doc_id"), "n_bytes": pa.array([o[0] for o in out], pa.int64()),
                     "n_removed": pa.array([o[1] for o in out], pa.int64()),
                     "n_spans": pa.array([o[2] for o in out], pa.int64()),
                     "kept_sha256": pa.array([o[3] for o in out], pa.string())})


def _stage(docs: DataFrame, total: int, size: int) -> DataFrame:
    """The documents in batches, written once to the shared folder, bucketed by batch."""
    spark = docs.sparkSession

    def number(batches):
        task, batch, held = TaskContext.get().partitionId(), 0, 0
        for b in batches:
            lens = np.diff(buffers(b.column("text"))[1])
            ids = np.empty(b.num_rows, np.int64)
            for i, n in enumerate(lens.tolist()):
                if held and held + n > size:
                    batch, held = batch + 1, 0
                held += n
                ids[i] = (task << 32) + batch
            yield pa.RecordBatch.from_arrays([pa.array(ids), *b.columns], ["batch", *b.schema.names])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    name = f"repeats_{uuid.uuid4().hex[:12]}"
    buckets = min(100_000, max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // (4 * size))))
    (rows.mapInArrow(number, "batch long, doc_id long, text binary").write.format("parquet")
     .bucketBy(buckets, "batch").option("path", scratch_path(spark, name)).option("compression", "zstd").saveAsTable(name))
    return spark.table(name)


def remove_repeats(docs: DataFrame, batch_bytes: int = BATCH_BYTES, range_bytes: int = RANGE_BYTES,
                   hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for every row of docs (doc_id, text)."""
    spark = ready(docs.sparkSession)
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = max(0, min(MAX_RANGES, -(-total // range_bytes)) - 1).bit_length()
    staged = _stage(docs, total, max(batch_bytes, total >> 19))
    by = "batch long, range int, blob binary"
    asked = "batch long, kind int, blob binary"
    triggers = staged.groupBy("batch").applyInArrow(_send_triggers(bits), by)
    shared = triggers.groupBy("range").applyInArrow(_shared_triggers, by)
    phrases = staged.groupBy("batch").cogroup(shared.groupBy("batch")).applyInArrow(_send_phrases(bits), by)
    smallest = cut(phrases.groupBy("range").applyInArrow(lambda rows: _smallest(rows, hot), asked))
    texts = (staged.groupBy("batch").cogroup(smallest.filter("kind <> 0").groupBy("batch"))
             .applyInArrow(_send_texts(bits), by))
    strings = texts.groupBy("range").applyInArrow(_strings, asked)
    told = smallest.filter("kind = 0").union(strings)
    return (staged.groupBy("batch").cogroup(told.groupBy("batch"))
            .applyInArrow(_remove, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"))
