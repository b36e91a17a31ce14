"""SimHash near-duplicates: fingerprints, links at few differing bits found in BK-trees, components.

Fingerprint. Text is lower-cased in A-Z, words are ``[^\\x20\\x09-\\x0D]+``, shingles are three
words joined by a space (fewer words: the whole sequence; no word, or a null text: fingerprint 0).
A bit is 1 if it is set in over half of the shingles' XXH64 (seed 42), repeats included.

Links. Fingerprints are linked at ``RADIUS`` = 3 or fewer differing bits. The 64 bits are cut into
five blocks: two fingerprints that close agree on at least two blocks, so every distinct
fingerprint goes to ten shards, one for each pair of blocks, keyed by the values of the two blocks.
Each shard is searched by a BK-tree: children are keyed by their integer Hamming distance to the
parent, and a query follows only edges whose distance is within the radius of its own distance.
The published layout broadcasts the shard trees to the queries; together they grow with the corpus,
so here each shard's queries are shuffled to its tree instead. A shard of over ``TREE_LIMIT``
fingerprints is dealt into sub-shards and every pair of sub-shards is a group of its own, so no
group grows with the data and no link is lost. A group gives only links that join two of its
fingerprints not yet joined (a spanning forest), never all pairs.

Groups. Connected components over the distinct fingerprints; a component's id is its smallest
doc_id (null ids count only if there is no other). Repeated rows are kept as rows; equal texts have
equal fingerprints. An empty table gives no rows. Other columns are ignored or passed on unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftsweep.llm.common import components, cut, ready
from driftsweep.operators.joins import join_checked

SHINGLE, RADIUS, SEED = 3, 3, 42
BLOCKS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))
TREE_LIMIT = 4096
LEAF = 24
#: Rows of one fingerprint that go to one task; more are dealt.
HOT_ROWS = 1 << 20
_STEP = 1 << 18


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of one text (see the module docstring), as an unsigned number."""
    words = text.lower().split()  # of bytes: A-Z only, and the six white-space bytes
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    n = max(1, len(words) - shingle + 1)
    starts = np.concatenate(([0], ends[:-1] + 1))[:n]
    ends = ends[shingle - 1:] if len(words) >= shingle else ends[-1:]
    ones = np.zeros(64, np.int64)
    for i in range(0, n, _STEP):
        parts = map(joined.__getitem__, map(slice, starts[i:i + _STEP].tolist(), ends[i:i + _STEP].tolist()))
        m = min(_STEP, n - i)
        h = np.fromiter(map(xxhash.xxh64_intdigest, parts, repeat(SEED)), np.uint64, m)
        bits = np.unpackbits(h.view(np.uint8).reshape(m, 8), axis=1, bitorder="little")
        for j in range(0, m, 255):  # sums of at most 255 bits fit a byte
            ones += bits[j:j + 255].sum(axis=0, dtype=np.uint8)
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.uint64)[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = b.column("text").cast(pa.large_binary())
        got = [fingerprint(t.as_py() or b"") for t in texts]
        yield pa.record_batch({"doc_id": b.column("doc_id"), "text_key": b.column("text_key"),
                               "fp": pa.array(np.array(got, np.uint64).view(np.int64), pa.int64())})


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, text_key (hash of the text), fp (the 64 bits as a long) for every row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")
    return rows.mapInArrow(_fingerprints, "doc_id long, text_key long, fp long")


def tree_links(fps: np.ndarray, radius: int = RADIUS) -> list[tuple[int, int]]:
    """Links (positions in ``fps``, distinct uint64) that span the groups at ``radius`` bits or fewer.

    The BK-tree is walked while it is built: a node parts its subtree by distance to itself, and
    the queries that reach it go down only the edges within the radius of their own distance.
    Queries already joined with all of a subtree leave it.
    """
    label = np.arange(len(fps))
    links: list[tuple[int, int]] = []

    def join(node: int, near: np.ndarray) -> None:
        old = np.unique(label[near])
        for k in old[old != label[node]]:
            links.append((node, int(near[label[near] == k][0])))
        if len(old) > 1 or old[0] != label[node]:
            members = np.isin(label, np.append(old, label[node]))
            label[members] = label[members].min()

    stack = [(np.arange(len(fps)), np.arange(len(fps)))]
    while stack:
        tree, asking = stack.pop()
        first = label[tree[0]]
        if (label[tree] == first).all():
            asking = asking[label[asking] != first]
        if not len(asking):
            continue
        if len(tree) <= LEAF:
            for node in tree:
                near = asking[np.bitwise_count(fps[asking] ^ fps[node]) <= radius]
                if len(near):
                    join(int(node), near)
            continue
        root, rest = int(tree[0]), tree[1:]
        asked = np.bitwise_count(fps[asking] ^ fps[root]).astype(np.int16)
        if (asked <= radius).any():
            join(root, asking[asked <= radius])
        edge = np.bitwise_count(fps[rest] ^ fps[root]).astype(np.int16)
        for d in np.unique(edge):
            stack.append((rest[edge == d], asking[np.abs(asked - d) <= radius]))
    return links


def _shard_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows (shard, lo, hi, fp) to spanning links of each run with two or more fingerprints."""
    held: list[np.ndarray] = []

    def emit(rows: np.ndarray) -> pa.RecordBatch:
        change = np.flatnonzero((rows[1:, :3] != rows[:-1, :3]).any(axis=1)) + 1
        starts, stops = np.concatenate(([0], change)), np.concatenate((change, [len(rows)]))
        found = []
        for s, e in zip(starts[stops - starts > 1], stops[stops - starts > 1], strict=True):
            own = rows[s:e, 3]
            found += [(own[a], own[b]) for a, b in tree_links(own.view(np.uint64))]
        both = np.array(found, np.int64).reshape(-1, 2)
        return pa.record_batch({"a": pa.array(both[:, 0], pa.int64()), "b": pa.array(both[:, 1], pa.int64())})

    for batch in batches:
        if not batch.num_rows:
            continue
        rows = np.column_stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns])
        held.append(rows)
        last = np.flatnonzero((rows[:, :3] != rows[-1, :3]).any(axis=1))
        if len(last):  # the run that the batch ends in may go on
            all_rows = np.concatenate(held)
            keep = len(rows) - 1 - last[-1]
            yield emit(np.ascontiguousarray(all_rows[:-keep]))
            held = [rows[-keep:]]
    if held:
        yield emit(np.ascontiguousarray(np.concatenate(held)))


def links(fps: DataFrame, limit: int = TREE_LIMIT) -> DataFrame:
    """Spanning links (a, b) between distinct fingerprints ``fp`` at RADIUS bits or fewer."""
    def block(at: int, width: int):
        return F.shiftrightunsigned("fp", at).bitwiseAND(F.lit((1 << width) - 1))

    keys = [F.shiftleft(F.lit(i).cast("long"), 26).bitwiseOR(F.shiftleft(block(*x), 13)).bitwiseOR(block(*y))
            for i, (x, y) in enumerate(combinations(BLOCKS, 2))]
    entries = fps.select("fp", F.explode(F.array(*keys)).alias("shard"))
    hot = (entries.groupBy("shard").agg(F.count("*").alias("n")).filter(F.col("n") > limit)
           .select("shard", F.ceil(F.col("n") / limit).cast("long").alias("parts")))
    entries = (join_checked(entries, hot, ["shard"], "left", salt_from=["fp"]).withColumn("parts", F.coalesce("parts", F.lit(1).cast("long")))
               .withColumn("own", F.pmod(F.xxhash64("fp"), F.col("parts")))
               .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))))
    groups = entries.select("shard", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "fp")
    return (groups.repartition("shard", "lo", "hi").sortWithinPartitions("shard", "lo", "hi")
            .mapInArrow(_shard_links, "a long, b long"))


def groups(marked: DataFrame) -> DataFrame:
    """fp, component_id, first_key, n_rows: one row for each distinct fingerprint of (doc_id, text_key, fp).

    ``first_key`` is the text_key of the row that the component is named after.
    """
    first = F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "text_key"))
    own = cut(marked.groupBy("fp").agg(first.alias("first"), F.count("*").alias("n_rows")))
    parts = components(links(own.select("fp")))
    own = own.join(parts, own["fp"] == parts["node"], "left").select(
        "fp", "first", "n_rows", F.coalesce("root", "fp").alias("root"))
    best = own.groupBy("root").agg(F.min("first").alias("best"))
    return own.join(best, "root").select("fp", F.col("best.doc_id").alias("component_id"),
                                         F.col("best.text_key").alias("first_key"), "n_rows")


def near_duplicates(docs: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id for every row of docs (doc_id, text).

    Rows of a fingerprint with over ``hot_rows`` are dealt over as many tasks as they need.
    """
    ready(docs.sparkSession)
    deal = F.pmod(F.monotonically_increasing_id(), F.lit(1 << 15)).cast("int")
    marked = cut(fingerprints(docs).withColumn("deal", deal))  # stored, so a task that runs again deals alike
    found = cut(groups(marked))
    parts = F.ceil(F.col("n_rows") / hot_rows).cast("long")
    hot = found.filter(F.col("n_rows") > hot_rows).select("fp", parts.alias("parts"))
    salt = F.pmod(F.col("deal").cast("long"), F.coalesce("parts", F.lit(1).cast("long")))
    marked = join_checked(marked, hot, ["fp"], "left", salt_from=["deal"]).withColumn("salt", salt)
    found = found.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
    return marked.join(found, ["fp", "salt"]).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, columns as they are: from each group the row with its smallest doc_id.

    Of rows that share that doc_id the one with the smallest text hash stays, of wholly equal rows one.
    """
    ready(docs.sparkSession)
    marked = cut(fingerprints(docs))
    name = lambda c, key: [c.isNull().alias("__sd_none"), F.coalesce(c.cast("long"), F.lit(0)).alias("__sd_id"), key.alias("__sd_row")]
    keep = groups(marked).select(*name(F.col("component_id"), F.col("first_key"))).distinct()
    rows = docs.select("*", *name(F.col("doc_id"), F.xxhash64("text")))
    on = ["__sd_none", "__sd_id", "__sd_row"]  # keys of the join and of dropDuplicates: texts are shuffled once
    return rows.join(keep, on, "left_semi").dropDuplicates(on).select(*docs.columns)
