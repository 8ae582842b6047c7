"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns ``vnodes`` points of a 32-bit ring; a key belongs to the next
point clockwise.  A shard holds no more than its share (N / shards, rounded
up for the first N mod shards); keys of a full shard continue clockwise to
the next point whose shard has room.  So counts differ by at most one, and
only overflowing keys leave their home.

Spark ranks all rows along the ring (one range shuffle of ids and sizes, no
texts).  The walk itself needs one number for each arc only: at most
``shards * vnodes`` counts reach the driver, whatever the size of the table.
Its outcome, stretches of ranks and their shards, is as small and goes back
as an array that each row searches by its rank.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow
from .ranks import dense_rank


def ring(shards: int, vnodes: int) -> list[tuple[int, int]]:
    """(point, shard), ascending; of equal points the smaller shard's stays."""
    points: dict[int, int] = {}
    for s in range(shards):
        for v in range(vnodes):
            p = int.from_bytes(hashlib.md5(f"{s}/{v}".encode()).digest()[:4], "big")
            points.setdefault(p, s)
    return sorted(points.items())


def walk(counts: list[int], owners: list[int], shards: int) -> list[tuple[int, int, int, int]]:
    """Places ``counts[i]`` ring-ordered keys of each arc; (rank from, rank to, shard, slot of the first).

    Keys stay at home up to the shard's share, in ring order; what is left of
    an arc goes on clockwise, after those already waiting, to the first point
    whose shard has room.
    """
    total = sum(counts)
    room = [total // shards + (1 if s < total % shards else 0) for s in range(shards)]
    used = [0] * shards
    out, waiting = [], []

    def place(lo: int, hi: int, s: int) -> None:
        out.append((lo, hi, s, used[s]))
        used[s] += hi - lo
        room[s] -= hi - lo

    rank, left = 0, []
    for n, s in zip(counts, owners):
        stay = min(n, room[s])
        if stay:
            place(rank, rank + stay, s)
        left.append((rank + stay, rank + n))
        rank += n
    for turn in range(2):  # all have room somewhere on one turn; the second takes those before the first arc
        for i, s in enumerate(owners):
            if turn == 0 and left[i][0] < left[i][1]:
                waiting.append(left[i])
            while waiting and room[s]:
                lo, hi = waiting.pop(0)
                take = min(hi - lo, room[s])
                place(lo, lo + take, s)
                if lo + take < hi:
                    waiting.insert(0, (lo + take, hi))
    return sorted(out)


def _arc_counts(places: list[int]):
    """Rows of ring places -> (arc, rows); a key's arc is the number of ring points below it."""
    points = np.array(places, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(points) + 1, np.int64)
        for batch in batches:
            at = np.searchsorted(points, batch.column(0).to_numpy(zero_copy_only=False), side="left")
            total += np.bincount(at, minlength=len(total))
        full = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(full.astype(np.int32)), pa.array(total[full])], ["arc", "n"])
    return run


def _assign(plan: list[tuple[int, int, int, int]]):
    start = np.array([p[0] for p in plan], np.int64)
    shard = np.array([p[2] for p in plan], np.int32)
    slot = np.array([p[3] for p in plan], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rank = batch.column(1).to_numpy(zero_copy_only=False)
            i = np.searchsorted(start, rank, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(shard[i]), pa.array(slot[i] + rank - start[i])], ["row", "shard", "slot"])
    return run


def shard_rows(df: DataFrame, key: str, shards: int = 40, vnodes: int = 64) -> DataFrame:
    """``df`` plus ``shard`` (0 to shards - 1) and ``slot`` (gapless from 0 in each shard).

    Counts differ by at most one.  A null key has its own place on the ring;
    rows with equal keys are neighbours there and are dealt like any others.
    Columns named ``shard`` or ``slot`` are replaced.  Empty input: an empty
    result.
    """
    points = ring(shards, vnodes)
    places = [p for p, _ in points]
    kept = [c for c in df.columns if c not in ("shard", "slot")]
    text = F.coalesce(F.col(key).cast("string"), F.lit("\u0000null"))
    rows = df.select(F.struct(*kept).alias("row"),
                     F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long").alias("h"),
                     text.alias("k"))
    ranked = dense_rank(rows, ["h", "k"], "rank")
    counted: dict[int, int] = {}
    arcs = map_arrow(ranked.select("h"), _arc_counts(places), "arc int, n long")
    for r in arcs.groupBy("arc").agg(F.sum("n").alias("n")).collect():  # one row for each arc
        counted[r.arc] = r.n
    n = len(points)
    counts = [counted.get(i, 0) for i in range(n + 1)]
    # beyond the last point the ring closes: those keys belong to the first point
    owners = [s for _, s in points] + [points[0][1]]
    plan = walk(counts, owners, shards)
    row_type = ranked.schema["row"].dataType.simpleString()
    return map_arrow(ranked.select("row", "rank"), _assign(plan),
                     f"row {row_type}, shard int, slot long").select("row.*", "shard", "slot")


def owner(points: list[tuple[int, int]], h: int) -> int:
    """The home shard of ring place ``h`` (used by tests and by single look-ups)."""
    i = bisect.bisect_left([p for p, _ in points], h)
    return points[i % len(points)][1]
