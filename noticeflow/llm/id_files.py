"""Token-id files: ids of all documents in order, range-coded in checksummed blocks.

Documents are range-partitioned by doc_id and each task writes one file of
segments, each some million ids of whole documents:

    "NTID" version, then eight unsigned 64-bit numbers (documents, ids, block
    length, blocks, distinct ids, bytes of the three parts that follow) and the
    CRC-32 of all of the header and index; index: an Arrow stream (doc_id,
    n_tokens), zstd; symbols: distinct ids by falling count and the counts;
    blocks: words and CRC-32 of each; then the words of all blocks.

A block is decoded on its own from its segment's symbols (``range_coder``).
Files are written under a name of the task attempt and take part once the
manifest, written after them, names them; a retried or speculative task leaves
a file that nothing names.  The manifest has one row per segment, so segments
are read in parallel; the place of a document in the whole is its place in the
segment plus the ids before it, from one sum per file.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import range_coder
from .common import map_arrow, packs, ship
from .tokens import array_ids

MAGIC = b"NTID\x01"
HEAD = struct.Struct("<8QI")
#: Ids of a segment, about; a segment holds whole documents, one at least.
SEGMENT = 1 << 22
#: Bytes of text that one file is made from, about.
FILE_BYTES = 48 << 20
#: Bytes of text whose ids are found at a time, about.
PACK = 6 << 20
MANIFEST = "part long, seq long, path string, at long, size long, ids long, documents long"


# ---------------------------------------------------------------- bytes of a segment
def pack_segment(doc_ids: pa.Array, lengths: np.ndarray, ids: np.ndarray, block: int = range_coder.BLOCK) -> bytes:
    """A segment of whole documents; ``lengths`` are their ids each."""
    block = range_coder.block_length(len(ids), block)
    if len(ids):
        symbols, count, words, sizes = range_coder.encode(ids, block)
    else:
        symbols = count = sizes = np.zeros(0, np.int64)
        words = np.zeros(0, np.uint16)
    ends = np.cumsum(sizes)
    crc = [zlib.crc32(words[e - s:e].tobytes()) for s, e in zip(sizes.tolist(), ends.tolist())]
    sink = pa.BufferOutputStream()
    index = pa.record_batch([doc_ids, pa.array(lengths, pa.int64())], names=["doc_id", "n_tokens"])
    with pa.ipc.new_stream(sink, index.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(index)
    parts = [sink.getvalue().to_pybytes(),
             symbols.astype("<u4").tobytes() + count.astype("<u8").tobytes(),
             sizes.astype("<u4").tobytes() + np.array(crc, "<u4").tobytes()]
    head = (len(lengths), len(ids), block, len(sizes), len(symbols), *map(len, parts))
    check = zlib.crc32(b"".join([struct.pack("<8Q", *head), *parts]))
    return b"".join([MAGIC, HEAD.pack(*head, check), *parts, words.astype("<u2").tobytes()])


def unpack_segment(data: bytes, name: str = "segment") -> tuple[pa.RecordBatch, np.ndarray]:
    """(doc_id and n_tokens of the documents; their ids end to end); ValueError where a checksum fails."""
    if data[:len(MAGIC)] != MAGIC or len(data) < len(MAGIC) + HEAD.size:
        raise ValueError(f"{name}: not a token-id segment")
    *head, check = HEAD.unpack_from(data, len(MAGIC))
    _, n_ids, block, n_blocks, kinds, *sizes = head
    at, parts = len(MAGIC) + HEAD.size, []
    for size in sizes:
        parts.append(data[at:at + size])
        at += size
    if zlib.crc32(b"".join([struct.pack("<8Q", *head), *parts])) != check:
        raise ValueError(f"{name}: header checksum")
    index = pa.ipc.open_stream(parts[0]).read_next_batch()
    symbols = np.frombuffer(parts[1], "<u4", kinds)
    count = np.frombuffer(parts[1], "<u8", kinds, 4 * kinds).astype(np.int64)
    words_in = np.frombuffer(parts[2], "<u4", n_blocks).astype(np.int64)
    crc = np.frombuffer(parts[2], "<u4", n_blocks, 4 * n_blocks).tolist()
    words = np.frombuffer(data, "<u2", int(words_in.sum()), at) if len(data) >= at + 2 * int(words_in.sum()) else None
    if words is None:
        raise ValueError(f"{name}: cut short")
    ends = np.cumsum(words_in)
    for i, (s, e) in enumerate(zip((ends - words_in).tolist(), ends.tolist())):
        if zlib.crc32(words[s:e].tobytes()) != crc[i]:
            raise ValueError(f"{name}: block {i} checksum")
    if not n_ids:
        return index, np.zeros(0, np.uint32)
    return index, range_coder.decode(symbols, count, words, words_in, n_ids, block)


# ---------------------------------------------------------------- tasks
def _open(folder: str):
    """(file system, path) of a folder by its URI or path."""
    if "://" not in folder and not folder.startswith("file:"):
        return pafs.LocalFileSystem(), folder
    if folder.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + folder[5:].lstrip("/")
    return pafs.FileSystem.from_uri(folder)


def _write(folder: str, path: str, end_id: int, segment: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        part = context.partitionId()
        files, base = _open(folder)
        name = f"{part:06d}-{context.taskAttemptId()}-{uuid.uuid4().hex}.ntid"
        out, at, rows = None, 0, []
        docs, lengths, ids, held = [], [], [], 0
        find = array_ids(path)

        def close():
            nonlocal out, at, docs, lengths, ids, held
            if out is None:
                files.create_dir(base, recursive=True)
                out = files.open_output_stream(f"{base}/{name}")
            size, flat, names = np.concatenate(lengths), np.concatenate(ids), pa.concat_arrays(docs)
            docs, lengths, ids = [], [], []
            data = pack_segment(names, size, flat)
            out.write(data)
            rows.append((part, len(rows), f"{folder}/{name}", at, len(data), int(size.sum()), len(size)))
            at += len(data)
            held = 0

        for batch in batches:
            for start, stop in packs(batch.column(1), PACK):
                piece = batch.slice(start, stop - start)
                flat, size = find(piece.column(1), end_id)
                docs.append(piece.column(0))
                lengths.append(size)
                ids.append(flat)
                held += len(flat)
                if held >= segment:
                    close()
        if docs:
            close()
        if out is not None:
            out.close()
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], pa.string() if i == 2 else pa.int64()) for i in range(7)],
            ["part", "seq", "path", "at", "size", "ids", "documents"])
    return run


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Manifest rows with ``before`` (ids before the segment) -> doc_id, start, n_tokens, ids."""
    for batch in batches:
        for path, at, size, before in zip(*(c.to_pylist() for c in batch.columns)):
            files, name = _open(path)
            with files.open_input_file(name) as f:
                f.seek(at)
                index, ids = unpack_segment(f.read(size), f"{path} at {at}")
            n = index.column(1).to_numpy()
            ends = np.cumsum(n)
            raw = ids.astype("<u4").view(np.uint8)
            step = 1 << 22  # ids in a batch, about
            first = 0
            while first < len(n):
                done = int(ends[first - 1]) if first else 0
                last = max(first + 1, int(np.searchsorted(ends, done + step, side="right")))
                offsets = np.concatenate(([0], ends[first:last] - done)) * 4
                binary = pa.Array.from_buffers(pa.binary(), last - first, [
                    None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(raw[4 * done:4 * int(ends[last - 1])])])
                yield pa.RecordBatch.from_arrays(
                    [index.column(0).slice(first, last - first), pa.array(before + ends[first:last] - n[first:last]),
                     pa.array(n[first:last]), binary], ["doc_id", "start", "n_tokens", "ids"])
                first = last


# ---------------------------------------------------------------- Spark
def write_ids(docs: DataFrame, folder: str, path: str, end_id: int = 0, segment: int = SEGMENT,
              file_bytes: int = FILE_BYTES) -> None:
    """Writes the ids of all texts, in ascending doc_id order, as id files under ``folder`` (new).

    A null text is empty and has the end id alone.  Rows of one doc_id keep the
    order in which they are read, so that many can be spread; a null doc_id
    comes last.  An empty table writes a manifest without rows.
    """
    spark = docs.sparkSession
    ship(spark)
    text = F.col("text").cast("string")
    rows = docs.select("doc_id", text.alias("text"), F.monotonically_increasing_id().alias("_tie"))
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    n = max(1, -(-total // file_bytes))
    order = [F.col("doc_id").asc_nulls_last(), F.col("_tie")]
    placed = rows.repartitionByRange(n, *order).sortWithinPartitions(*order).select("doc_id", "text")
    map_arrow(placed, _write(f"{folder}/ids", path, end_id, segment), MANIFEST).write.parquet(f"{folder}/manifest")


def read_ids(spark: SparkSession, folder: str, id_type: str = "bigint") -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids (little-endian unsigned 32-bit)."""
    ship(spark)
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    total, before = 0, []
    for r in manifest.groupBy("part").agg(F.sum("ids").alias("ids")).orderBy("part").collect():  # one row per file
        before.append((r.part, total))
        total += r.ids
    files = spark.createDataFrame(before, "part long, _before long")
    from pyspark.sql import Window

    within = F.sum("ids").over(Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1))
    segments = manifest.withColumn("_within", F.coalesce(within, F.lit(0))).join(files, "part")
    n = max(2, manifest.count())  # a segment is a task's work
    spread = segments.select("path", "at", "size", (F.col("_before") + F.col("_within")).alias("before")).repartition(n)
    return map_arrow(spread, _read, f"doc_id {id_type}, start long, n_tokens long, ids binary")


def folder_for(spark: SparkSession, shared: str) -> str:
    """A new folder of the shared one."""
    return os.path.join(shared, f"ids-{uuid.uuid4().hex}")
