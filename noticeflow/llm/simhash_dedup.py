"""SimHash near-duplicates by segment popcounts.

Every text becomes a 64-bit SimHash of its word shingles.  A fingerprint is
embedded as its bit counts over two-bit segments; the Manhattan distance of
two such vectors never exceeds the Hamming distance of the fingerprints.  The
vector is dealt into ``groups`` parts: if the whole distance is at most
``radius``, one part differs by at most ``radius // groups``, so a unit-width
grid over each part, with one side replicated to all cells within that
distance (upwards only: every unordered pair meets once from below), is a
complete range join.  Within a cell the Hamming distance is checked exactly
and only a spanning forest of the links leaves the task, never all pairs.

Scale: exact copies collapse to one fingerprint before the join, so a group
of copies costs one row.  Cells with more rows than ``cell_rows`` are dealt
into block pairs over several tasks.  The work in a cell is quadratic in its
*distinct* fingerprints; with more data take fewer ``groups`` (finer cells,
more replicas).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_broadcast, cut, map_arrow, runs
from .components import components, forest

#: Hot cells that may be broadcast; with more, Spark joins them by shuffle.
HOT_CELLS = 100_000


def shingle_hashes(text: str | None, words: int) -> list[int]:
    """XXH64 (seed 42) of every ``words``-word shingle; A-Z lower-cased, ASCII white space splits."""
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return []
    digest = xxhash.xxh64_intdigest
    line = b" ".join(parts)
    if len(parts) <= words:
        return [digest(line, 42)]
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1)
    starts = np.concatenate(([0], ends[:-1]))[:len(parts) - words + 1].tolist()
    return [digest(line[s:e], 42) for s, e in zip(starts, (ends[words - 1:] - 1).tolist())]


def fingerprint(text: str | None, words: int = 4) -> int:
    hashes = shingle_hashes(text, words)
    if not hashes:
        return 0
    bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1,
                         bitorder="little")
    count = np.zeros(64, np.int64)
    for i in range(0, len(bits), 1 << 16):
        count += bits[i:i + (1 << 16)].sum(axis=0, dtype=np.int64)
    return int(np.packbits(count * 2 > len(hashes), bitorder="little").view("<u8")[0])


def _fingerprints(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t.as_py(), words) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.array(fps, np.uint64).view(np.int64))], ["doc_id", "fp"])
    return run


def segments(radius: int, groups: int) -> list[list[list[int]]]:
    """Bits of each two-bit segment, dealt into ``groups`` parts of nearly equal size."""
    edges = np.linspace(0, 64, groups + 1).round().astype(int)
    return [[list(range(i, min(i + 2, hi))) for i in range(lo, hi, 2)]
            for lo, hi in zip(edges[:-1], edges[1:])]


def cells(fps: np.ndarray, radius: int, groups: int):
    """Yields (key, index of fingerprint, role): role 0 its own cell, 1 a cell to look into."""
    reach = radius // groups
    for g, part in enumerate(segments(radius, groups)):
        counts = np.stack([sum((fps >> np.uint64(b)) & np.uint64(1) for b in seg) for seg in part])
        room = np.array([len(seg) for seg in part], np.uint64)
        # two bits hold a count of 0 to 2; the group's number goes on top
        key = np.full(len(fps), g, np.uint64) << np.uint64(60)
        for i in range(len(part)):
            key |= counts[i].astype(np.uint64) << np.uint64(2 * i)
        every = np.arange(len(fps))
        yield key, every, 0
        # all displacements of Manhattan length <= reach; (d, -d) meet from either side,
        # so only those whose first non-zero entry is positive are emitted
        for moves in displacements(len(part), reach):
            ok = np.ones(len(fps), bool)
            at = key.copy()
            for i, d in moves:
                after = counts[i].astype(np.int64) + d
                ok &= (after >= 0) & (after <= int(room[i]))
                at = (at.astype(np.int64) + (d << (2 * i))).astype(np.uint64)
            yield at[ok], every[ok], 1


def displacements(n: int, reach: int) -> list[list[tuple[int, int]]]:
    found = {(): None}
    for size in range(1, reach + 1):
        for axes in combinations_with_replacement(range(n), size):
            signs = [()]
            for _ in set(axes):
                signs = [s + (x,) for s in signs for x in (1, -1)]
            for sign in signs:
                move = [(axis, s * axes.count(axis)) for axis, s in zip(sorted(set(axes)), sign)]
                if move[0][1] > 0:
                    found[tuple(move)] = None
    return [list(m) for m in found]


def _cell_rows(radius: int, groups: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for key, at, role in cells(fps, radius, groups):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), pa.array(fps[at].view(np.int64)),
                     pa.array(np.full(len(at), role, np.int32))], ["cell", "fp", "role"])
    return run


def _links(radius: int, step: int = 1 << 20):
    """Rows sorted by (cell, bx, by, role, fp) -> spanning forest of the links in each stretch."""

    def within(key: np.ndarray, fp: np.ndarray, role: np.ndarray):
        start = runs(key)
        stop = np.append(start[1:], len(key))
        own = np.add.reduceat((role == 0).astype(np.int64), start) if len(start) else start
        size = stop - start
        keep = (own > 0) & (size > 1)
        start, own, size = start[keep], own[keep], size[keep]
        work = own * size
        i = 0
        while i < len(start):
            if work[i] > step:  # a large cell alone, row block by row block
                rows = max(1, step // int(size[i]))
                s, o, n = int(start[i]), int(own[i]), int(size[i])
                for r in range(s, s + o, rows):
                    left = np.arange(r, min(r + rows, s + o))
                    a = np.repeat(left, n)
                    b = np.tile(np.arange(s, s + n), len(left))
                    yield from near(fp[a], fp[b])
                i += 1
                continue
            j = i + max(1, int(np.searchsorted(np.cumsum(work[i:]), step, side="right")))
            s, o, n = start[i:j], own[i:j], size[i:j]
            w = o * n
            cell = np.repeat(np.arange(len(s)), w)
            within_cell = np.arange(int(w.sum())) - np.repeat(np.cumsum(w) - w, w)
            a = s[cell] + within_cell // n[cell]
            b = s[cell] + within_cell % n[cell]
            yield from near(fp[a], fp[b])
            i = j

    def near(x: np.ndarray, y: np.ndarray):
        hit = (np.bitwise_count(x ^ y) <= radius) & (x != y)
        if hit.any():
            node, root = forest(x[hit], y[hit])
            yield pa.RecordBatch.from_arrays(
                [pa.array(node.view(np.int64)), pa.array(root.view(np.int64))], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[np.ndarray] | None = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(5)]
            if rest is not None:
                cols = [np.concatenate([r, c]) for r, c in zip(rest, cols)]
            change = np.any([c[1:] != c[:-1] for c in cols[:3]], axis=0) if len(cols[0]) > 1 else np.zeros(0, bool)
            group = np.concatenate(([0], np.cumsum(change)))
            last = int(np.searchsorted(group, group[-1]))
            if last:
                yield from within(group[:last], cols[4][:last].view(np.uint64), cols[3][:last])
            rest = [c[last:] for c in cols]
        if rest is not None:
            yield from within(np.zeros(len(rest[0]), np.int64), rest[4].view(np.uint64), rest[3])
    return run


def fingerprints(docs: DataFrame, words: int = 4) -> DataFrame:
    """(doc_id, fp): one row for each row of ``docs``; fp is the SimHash as a signed long."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(docs.select("doc_id", F.col("text").cast("string").alias("text")),
                     _fingerprints(words), f"doc_id {kind}, fp long")


def fingerprint_links(fps: DataFrame, radius: int = 4, groups: int = 3,
                      cell_rows: int = 50_000) -> DataFrame:
    """(a, b): links whose components are those of all pairs within ``radius``; ``fps(fp)`` is distinct."""
    rows = map_arrow(fps.select("fp"), _cell_rows(radius, groups), "cell long, fp long, role int")
    hot = cut(rows.groupBy("cell").count().where(F.col("count") > cell_rows)
              .select("cell", F.ceil(F.col("count") / cell_rows).cast("int").alias("n")))
    hot_cells = hot.count()
    if hot_cells:
        mine = F.pmod(F.xxhash64("fp"), F.coalesce("n", F.lit(1))).cast("int")
        every = F.sequence(F.lit(0), F.coalesce("n", F.lit(1)) - 1)
        dealt = rows.join(bounded_broadcast(hot, hot_cells, HOT_CELLS), "cell", "left")
        # a row of the cell's own stands in block row bx; every row, own ones too, in block column by
        left = dealt.where("role = 0").select("cell", mine.alias("bx"), F.explode(every).alias("by"),
                                              F.lit(0).alias("role"), "fp")
        right = dealt.where("n is not null").select("cell", F.explode(every).alias("bx"), mine.alias("by"),
                                                    F.lit(1).alias("role"), "fp")
        plain = dealt.where("n is null and role = 1").select("cell", F.lit(0).alias("bx"), F.lit(0).alias("by"),
                                                             "role", "fp")
        rows = left.unionByName(right).unionByName(plain)
    else:
        rows = rows.select("cell", F.lit(0).alias("bx"), F.lit(0).alias("by"), "role", "fp")
    sort = ["cell", "bx", "by", "role", "fp"]
    return (rows.repartition("cell", "bx", "by").sortWithinPartitions(*sort).select(*sort)
            .mapInArrow(_links(radius), "a long, b long"))


def near_duplicates(docs: DataFrame, words: int = 4, radius: int = 4, groups: int = 3,
                    cell_rows: int = 50_000) -> DataFrame:
    """(doc_id, fp, fingerprint, component_id) for every row of ``docs``.

    ``component_id`` is the least doc_id reachable over links of at most
    ``radius`` bits, the row's own included.  Null or wordless text has
    fingerprint zero and is linked like any other; a null doc_id stays a row
    and is never a component's id unless all ids of the component are null.
    Repeated rows are kept; an empty table gives an empty result.
    """
    rows = cut(fingerprints(docs, words))
    fps = rows.groupBy("fp").agg(F.min("doc_id").alias("first"))
    links = fingerprint_links(fps, radius, groups, cell_rows)
    root = components(links)
    placed = fps.join(root.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    least = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    ids = placed.join(least, "root").select("fp", "component_id")
    return rows.join(ids, "fp").select(
        "doc_id", "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")

