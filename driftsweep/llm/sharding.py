"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

Each shard has ``VIRTUAL`` points on a 64-bit ring; a key (doc_id) belongs to the first point
clockwise of its hash, and the keys between two points form an arc. Shards have a bound on their
rows; keys that find a shard full go on clockwise to the next point. All arcs offer their rows to
their own point first, then all that are left to the next one, and so on, in ring order.

With ``slack`` = 0 the bounds are floor(rows / shards), plus one for the first rows % shards shards:
law ``rows``, counts at most one apart. With slack > 0 the bound is ceil((1 + slack) * rows / shards);
fewer rows then overflow, and fewer move when a shard is added.

Rows do not decide one after the other. One aggregate counts the rows of each arc; an arc is cut by a
hash of the row into ARC_CELLS cells, more where a cell would hold over ``CELL_ROWS`` rows (all rows of one
doc_id lie in one arc, however many they are). A second aggregate counts the cells: a few numbers a
point of the ring, at most CELLS_MOST more. The flow of the arcs' counts over the ring is followed on
the driver with those numbers, and gives ranges of ranks to shards. A row's rank comes from sorting its cell. Only (doc_id, size, checksum) is shuffled, never the text. Equal rows
are counted together before the shuffle and dealt out again at the end, in pieces of bounded
length, so a group of copies of any size does not meet in one task.

A null doc_id is a key like any other; null and empty texts have size 16; equal rows differ in slot
only; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from driftsweep.llm.common import cut, ready

SHARDS, VIRTUAL, ARC_CELLS = 40, 64, 16
PIECE = 100_000
#: Rows of a cell, and the cells that the arcs of many rows are given at most beyond ARC_CELLS each.
CELL_ROWS, CELLS_MOST = 1 << 20, 1 << 18


def ring(shards: int, virtual: int = VIRTUAL) -> tuple[np.ndarray, np.ndarray]:
    """Positions (sorted, signed 64 bits) of all virtual nodes and the shard of each."""
    points = sorted((xxhash.xxh64_intdigest(f"{s}/{v}", 7) - 2**63, s) for s in range(shards) for v in range(virtual))
    return np.array([p for p, _ in points], np.int64), np.array([s for _, s in points])


def flow(counts: np.ndarray, owner: np.ndarray, free: list[int]) -> list[tuple[int, int, int, int]]:
    """(arc, rows, shard, slot of the first) pieces: how each arc's rows overflow clockwise."""
    left, used, out = counts.tolist(), [0] * len(free), []
    todo = [a for a, n in enumerate(left) if n]
    for step in range(len(owner)):
        if not todo:
            break
        for a in todo:
            s = int(owner[(a + step) % len(owner)])
            take = min(left[a], free[s] - used[s])
            if take:
                out.append((a, take, s, used[s]))
                used[s] += take
                left[a] -= take
        todo = [a for a in todo if left[a]]
    return out


def bounds(rows: int, shards: int, slack: float = 0.0) -> list[int]:
    if slack > 0:
        return [int(np.ceil((1 + slack) * rows / shards))] * shards
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def arc_cells(rows: np.ndarray, cell_rows: int = CELL_ROWS) -> np.ndarray:
    """Cells of each arc of ``rows`` different rows."""
    size = max(cell_rows, -(-int(rows.sum()) // CELLS_MOST))
    return np.maximum(ARC_CELLS, -(-rows // size))


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32 and n, one row for equal ones."""
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"),
                        F.crc32(F.col("text").cast("binary")).alias("text_crc32"))
            .groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("n")))


def assign(docs: DataFrame, shards: int = SHARDS, slack: float = 0.0, virtual: int = VIRTUAL,
           cell_rows: int = CELL_ROWS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row of docs (doc_id, text)."""
    ready(docs.sparkSession)
    points, owner = ring(shards, virtual)

    def locate(batches):
        for b in batches:
            at = np.searchsorted(points, b.column("pos").to_numpy(), "left") % len(points)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(at, pa.int32())], [*b.schema.names, "arc"])

    own = keyed(docs).withColumn("pos", F.xxhash64("doc_id")).withColumn("mix", F.xxhash64("size", "text_crc32", "doc_id"))
    own = own.mapInArrow(locate, "doc_id long, size long, text_crc32 long, n long, pos long, mix long, arc int")
    own = cut(own.drop("pos"))
    per_arc = np.zeros(len(points), np.int64)
    for r in own.groupBy("arc").agg(F.count("*").alias("rows")).collect():  # ring-sized
        per_arc[r["arc"]] = r["rows"]
    n_cells = arc_cells(per_arc, cell_rows)
    begin = np.cumsum(n_cells) - n_cells
    layout = docs.sparkSession.createDataFrame(list(zip(range(len(points)), begin.tolist(), n_cells.tolist(), strict=True)),
                                               "arc int, begin long, n_cells long")  # one row a point of the ring
    own = own.join(F.broadcast(layout), "arc").select(
        "doc_id", "size", "text_crc32", "n", "mix", (F.col("begin") + F.pmod("mix", "n_cells")).cast("int").alias("cell"))
    sums = own.groupBy("cell").agg(F.sum("n").alias("n"), F.max("n").alias("most")).collect()
    cells = np.zeros(int(n_cells.sum()), np.int64)
    for r in sums:
        cells[r["cell"]] = r["n"]
    first = np.cumsum(cells) - cells
    arcs = np.add.reduceat(cells, begin)
    pieces = sorted(flow(arcs, owner, bounds(int(arcs.sum()), shards, slack)), key=lambda p: p[0])
    took = np.array([p[1] for p in pieces], np.int64)
    begins, shard_of, slot_of = np.cumsum(took) - took, np.array([p[2] for p in pieces]), np.array([p[3] for p in pieces])

    order = Window.partitionBy("cell").orderBy("mix", "doc_id", "size", "text_crc32")
    rows = own.withColumn("rank", F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n"))
    rows = rows.withColumn("lo", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(PIECE).cast("long"))))
    if any(r["most"] > PIECE for r in sums):
        rows = rows.repartition("cell", "lo")
    rows = rows.select("doc_id", "size", "text_crc32", "cell", (F.col("rank") + F.col("lo")).alias("rank"),
                       F.least(F.col("n") - F.col("lo"), F.lit(PIECE)).alias("n"))

    def place(batches):
        for b in batches:
            n = b.column("n").to_numpy()
            for i in range(0, b.num_rows, max(1, min(b.num_rows, int(PIECE // max(1, n.max(initial=1)))))):
                step = max(1, min(b.num_rows, int(PIECE // max(1, n.max(initial=1)))))
                part, m = b.slice(i, step), n[i:i + step]
                take = np.repeat(np.arange(len(m)), m)
                nth = np.arange(len(take)) - np.repeat(np.cumsum(m) - m, m)
                at = (first[part.column("cell").to_numpy()] + part.column("rank").to_numpy())[take] + nth
                k = np.searchsorted(begins, at, "right") - 1
                rep = pa.array(take)
                yield pa.record_batch({
                    "doc_id": part.column("doc_id").take(rep), "size": part.column("size").take(rep),
                    "text_crc32": part.column("text_crc32").take(rep), "law": pa.array(["rows" if slack <= 0 else "bound"] * len(at)),
                    "shard": pa.array(shard_of[k], pa.int32()), "slot": pa.array(slot_of[k] + at - begins[k], pa.int64()),
                    "grown_shard": pa.nulls(len(at), pa.int32())})

    return rows.mapInArrow(place, "doc_id long, size long, text_crc32 long, law string, shard int, slot long, grown_shard int")
