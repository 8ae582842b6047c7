"""Packing token sequences: shortest-pack-first over the histogram of lengths.

Each text is tokenized once, in its own task, and cut into pieces of at most
``size`` ids.  The histogram of piece lengths (``size`` numbers) is all the
driver sees: lengths are placed longest first, each into the shortest packs
it fits (whole counts of equal packs at a time), which gives patterns with
counts.  A piece finds its pattern by its rank among the pieces of its
length: Spark ranks them in one range shuffle of (length, id), and each
pattern slot is a stretch of ranks.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, map_arrow
from .ranks import dense_rank
from .tokens import byte_pairs

LENGTH_SIZE = 2048


def _pieces(path: str, size: int, end_id: int):
    end = np.uint32(end_id).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = byte_pairs(path)
        for batch in batches:
            row, start, length, crc, total = [], [], [], [], []
            for i, text in enumerate(batch.column(1)):
                ids = pairs.ids(text.as_py() or "") + end
                n = len(ids) // 4
                for s in range(0, n, size):
                    part = ids[4 * s:4 * (s + size)]
                    row.append(i)
                    start.append(s)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    total.append(n)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row, pa.int64())), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(crc, pa.int64()), pa.array(total, pa.int64())],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])
    return run


def token_pieces(docs: DataFrame, path: str, size: int = LENGTH_SIZE, end_id: int = 1) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens): consecutive pieces of each text's ids and the end id."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(docs.select("doc_id", F.col("text").cast("string").alias("text")), _pieces(path, size, end_id),
                     f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long")


def shortest_pack_first(histogram: dict[int, int], size: int) -> list[tuple[int, tuple[int, ...]]]:
    """[(packs, lengths in each)] that place all of the histogram; every pack's lengths sum to ``size`` at most."""
    packs: dict[int, list[list]] = {}  # by free space: [count, lengths]
    for length in sorted((n for n, c in histogram.items() if c), reverse=True):
        left = histogram[length]
        moved: dict[int, list[list]] = {}
        for free in sorted((f for f in packs if f >= length), reverse=True):
            group = packs[free]
            while group and left:
                count, lengths = group.pop()
                take = min(count, left)
                if take < count:
                    group.append([count - take, lengths])
                moved.setdefault(free - length, []).append([take, lengths + (length,)])
                left -= take
            if not group:
                del packs[free]
            if not left:
                break
        # packs just made may take more of the same length, again the shortest first
        while left:
            free = max((f for f in moved if f >= length), default=None)
            if free is None:
                per = size // length
                full, rest = divmod(left, per)
                if full:
                    moved.setdefault(size - per * length, []).append([full, (length,) * per])
                if rest:
                    moved.setdefault(size - rest * length, []).append([1, (length,) * rest])
                left = 0
                break
            count, lengths = moved[free].pop()
            if not moved[free]:
                del moved[free]
            take = min(count, left)
            if take < count:
                moved.setdefault(free, []).append([count - take, lengths])
            moved.setdefault(free - length, []).append([take, lengths + (length,)])
            left -= take
        for free, group in moved.items():
            packs.setdefault(free, []).extend(group)
    return [(count, lengths) for free in sorted(packs) for count, lengths in packs[free]]


def stretches(patterns: list[tuple[int, tuple[int, ...]]], first_rank: dict[int, int]):
    """Rows (rank from, sequence of that rank, offset), ascending: where the pieces of a stretch of ranks go."""
    at = dict(first_rank)
    out, sequence = [], 0
    for count, lengths in patterns:
        offset = 0
        for n in lengths:
            out.append((at[n], sequence, offset))
            at[n] += count
            offset += n
        sequence += count
    return sorted(out)


def _place(rows: list[tuple[int, int, int]]):
    begin, sequence, offset = (np.array([r[i] for r in rows], np.int64) for i in range(3))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rank = batch.column(1).to_numpy(zero_copy_only=False)
            i = np.searchsorted(begin, rank, side="right") - 1
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sequence[i] + rank - begin[i]),
                                              pa.array(offset[i])], ["row", "sequence_id", "offset"])
    return run


def pack(pieces: DataFrame, size: int = LENGTH_SIZE) -> DataFrame:
    """``pieces`` (with ``length``, 1 to size) plus ``sequence_id`` (gapless from 0) and ``offset``."""
    kept = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    rows = dense_rank(pieces.select(F.struct(*kept).alias("row"), "length", "doc_id", "start"),
                      ["length", "doc_id", "start"], "rank")
    histogram = {r.length: r["count"] for r in rows.groupBy("length").count().collect()}  # at most ``size`` rows
    first, total = {}, 0
    for n in sorted(histogram):
        first[n] = total
        total += histogram[n]
    patterns = shortest_pack_first(histogram, size)
    row_type = rows.schema["row"].dataType.simpleString()
    return map_arrow(rows.select("row", "rank"), _place(stretches(patterns, first)),
                     f"row {row_type}, sequence_id long, offset long").select("row.*", "sequence_id", "offset")


def packed_documents(docs: DataFrame, path: str, size: int = LENGTH_SIZE, end_id: int = 1) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A null text is empty and gives the end id alone; repeated rows and null
    ids are packed like any others; an empty table gives an empty result.
    """
    return pack(cut(token_pieces(docs, path, size, end_id)), size)
