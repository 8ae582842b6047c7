"""Suffix-array dedup of repeated passages through a content-defined parse.

Every byte string of ``length`` bytes that starts in a document with a smaller
doc_id is covered and removed, byte-exact.

* **Parse.**  A rolling hash over ``gram`` bytes marks triggers: in each window
  of ``length`` bytes the leftmost least hash is the trigger, so every string
  of ``length`` bytes holds exactly one that depends on its content only.  The
  starts that share a trigger form a phrase: their bytes plus the
  ``length - 1`` that follow.  Equal strings lie in phrases with equal
  triggers, at equal places.
* **Which phrases matter.**  A phrase whose trigger bytes occur in one document
  only holds no repeated string.  The trigger hashes of all documents are
  shuffled once as sorted blocks of four bytes per trigger; hashes met in two
  documents set bits in a filter of a fixed size (``filter_bits``), the only
  thing that is broadcast.  A wrong bit costs work, never a wrong result.
* **Dictionary and suffix order.**  The remaining phrases go to buckets by
  trigger hash.  A bucket keeps every distinct phrase once, with the least
  doc_id it occurs in; all starts of its other occurrences are repeats.  The
  suffixes of the distinct phrases are put in corpus order by their first
  ``length`` bytes (eight bytes at a time, refining ties), so equal strings of
  different phrases become neighbours and the least document keeps them.
  Because a phrase carries the bytes that follow, no order of the parse beyond
  the phrase is needed.

Repeats of one phrase within a task are folded before the shuffle, so a text
with thousands of copies sends one phrase per task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import joined_bytes, map_arrow, packs, partitions, pow2_at_least, runs

#: Bits of the fixed-size filter of trigger hashes that occur in several documents (16 MiB).
FILTER_BITS = 1 << 27
#: Starts gathered in a task before blocks are sent on.
FLUSH = 2_000_000
LOW = np.uint64(32)
MIX = np.uint64(0x9E3779B97F4A7C15)
MULT = [np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93,
                               0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * MIX
    return h ^ (h >> np.uint64(29))


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A hash of the ``gram`` bytes from each position on, by doubling; length n - gram + 1."""
    byte = mix(np.arange(1, 257, dtype=np.uint64) * MULT[0])
    level = byte[data]
    size, out, have = 1, None, 0
    bit = 0
    while size <= gram:
        if gram & size:
            if out is None:
                out, have = level, size
            else:
                n = len(data) - have - size + 1
                out = out[:n] * MULT[(bit + 1) % 5] + level[have:have + n]
                have += size
        if size * 2 <= gram:
            n = len(data) - 2 * size + 1
            level = level[:n] * MULT[bit % 5] + level[size:size + n]
        size *= 2
        bit += 1
    return out


def phrases(data: np.ndarray, offsets: np.ndarray, length: int, gram: int):
    """Phrases of the texts laid end to end: (document, first start, starts, trigger's hash)."""
    none = np.zeros(0, np.int64)
    n = len(data) - length + 1
    if n <= 0:
        return none, none, none, np.zeros(0, np.uint64)
    h = gram_hashes(data, gram)
    window = length - gram + 1
    place = np.uint64((1 << 26) - 1)  # a pack holds far fewer bytes, unless one text alone is larger
    if len(h) > int(place):
        place = np.uint64((1 << 33) - 1)
    best = (h & ~place) | np.arange(len(h), dtype=np.uint64)
    size = 1
    while size * 2 <= window:
        m = len(best) - size
        best = np.minimum(best[:m], best[size:size + m])
        size *= 2
    best = np.minimum(best[:n], best[window - size:window - size + n])
    trigger = (best & place).astype(np.int64)
    # runs of one trigger, cut where a text begins and where its last start has passed
    ends = np.maximum(offsets[1:] - length + 1, offsets[:-1])
    start = np.unique(np.concatenate([offsets[:-1], ends, np.flatnonzero(trigger[1:] != trigger[:-1]) + 1]))
    start = start[start < n]
    count = np.diff(np.append(start, n))
    doc = np.searchsorted(offsets, start, "right") - 1
    ok = start < ends[doc]
    start = start[ok]
    return doc[ok], start, count[ok], mix(h[trigger[start]])


def _batches(batches: Iterator[pa.RecordBatch], pack: int = 1 << 19):
    """(ids, bytes, offsets, marks) of packs of texts; rows without an id are left out."""
    for batch in batches:
        text = batch.column(1)
        for lo, hi in packs(text, pack):
            data, offs = joined_bytes(text.slice(lo, hi - lo))
            ids = batch.column(0).slice(lo, hi - lo).to_numpy(zero_copy_only=False).astype(np.int64)
            marks = batch.column(2).slice(lo, hi - lo).to_numpy(zero_copy_only=False).astype(np.int64)
            yield ids, data, offs, marks


def _trigger_blocks(length: int, gram: int, bucket_bits: int):
    def run(batches):
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def flush():
            key = np.concatenate([k for k, _ in held])
            ids = np.concatenate([d for _, d in held])
            order = np.argsort(key)
            key, ids = key[order], ids[order]
            start = runs(key)
            several = np.minimum.reduceat(ids, start) != np.maximum.reduceat(ids, start)
            key = key[start]
            bucket = (key >> LOW).astype(np.int64)
            cuts = runs(bucket)
            ends = np.append(cuts[1:], len(bucket))
            low = (key & np.uint64(0xFFFFFFFF)).astype(np.uint32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket[cuts].astype(np.int32)),
                 pa.array([low[s:e].tobytes() for s, e in zip(cuts, ends)], pa.binary()),
                 pa.array([np.packbits(several[s:e]).tobytes() for s, e in zip(cuts, ends)], pa.binary())],
                ["bucket", "hashes", "several"])

        shift = np.uint64(64 - bucket_bits - 32)
        for ids, data, offs, _ in _batches(batches):
            doc, _, _, h = phrases(data, offs, length, gram)
            if len(doc):
                held.append((h >> shift, ids[doc]))
                size += len(doc)
            if size >= FLUSH:
                yield from flush()
                held, size = [], 0
        if held:
            yield from flush()
    return run


def _filter_slice(bits: int):
    """bits: of the filter per bucket."""
    def run(group: pa.Table) -> pa.Table:
        low = np.concatenate([np.frombuffer(x.as_py(), np.uint32) for x in group.column("hashes")])
        several = np.concatenate([np.unpackbits(np.frombuffer(s.as_py(), np.uint8))[:len(x.as_py()) // 4]
                                  for x, s in zip(group.column("hashes"), group.column("several"))])
        order = np.argsort(low, kind="stable")
        low, several = low[order], several[order].astype(bool)
        start = runs(low)
        twice = np.diff(np.append(start, len(low))) > 1
        found = low[start][twice | np.logical_or.reduceat(several, start)]
        mask = np.zeros(bits, np.uint8)
        mask[(found.astype(np.uint64) * np.uint64(bits)) >> LOW] = 1
        return pa.table({"bucket": group.column("bucket").slice(0, 1),
                         "bits": pa.array([zstandard.compress(np.packbits(mask).tobytes(), 1)], pa.binary())})
    return run


def trigger_filter(docs: DataFrame, length: int, gram: int, bucket_bits: int, filter_bits: int) -> bytes:
    """The filter: one bit for each of ``filter_bits`` hash ranges, set if two documents share a trigger in it."""
    per = max(8, filter_bits >> bucket_bits)
    blocks = map_arrow(docs, _trigger_blocks(length, gram, bucket_bits),
                       "bucket int, hashes binary, several binary")
    slices = blocks.groupBy("bucket").applyInArrow(_filter_slice(per), "bucket int, bits binary")
    out = np.zeros((1 << bucket_bits) * per // 8, np.uint8)
    for row in slices.toLocalIterator():  # at most filter_bits / 8 bytes in all, however large the input
        got = np.frombuffer(zstandard.decompress(bytes(row.bits)), np.uint8)
        out[row.bucket * (per // 8):(row.bucket + 1) * (per // 8)] = got
    return out.tobytes()


def _gather(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The bytes of all stretches, end to end."""
    total = int(size.sum())
    at = np.repeat(start - (np.cumsum(size) - size), size) + np.arange(total)
    return data[at]


def _phrase_blocks(length: int, gram: int, bucket_bits: int, filter_bits: int, shared):
    """Rows (bucket, block): distinct phrases of the task, or repeats already decided here (bucket < 0)."""
    per = max(8, filter_bits >> bucket_bits)

    def run(batches):
        bits = np.frombuffer(shared.value, np.uint8)
        held: list[tuple] = []
        size = 0
        flushes = 0

        def flush(k: int):
            bucket = np.concatenate([x[0] for x in held])
            ids = np.concatenate([x[1] for x in held])
            rows = np.concatenate([x[2] for x in held])
            place = np.concatenate([x[3] for x in held])
            count = np.concatenate([x[4] for x in held])
            ends = np.cumsum(count + length - 1)
            text = b"".join(x[5] for x in held)
            starts = (ends - count - length + 1).tolist()
            first: dict[bytes, int] = {}
            order = np.argsort(ids, kind="stable")
            ends = ends.tolist()
            low = np.full(len(ids), -1, np.int64)
            for i in order.tolist():
                low[i] = first.setdefault(text[starts[i]:ends[i]], i)
            again = ids[low] < ids  # a smaller document of this task has the same phrase
            done = np.flatnonzero(again)
            for lo in range(0, len(done), 50_000):
                part = done[lo:lo + 50_000]
                key = (TaskContext.get().partitionId() * 1000 + k) * 1000 + lo // 50_000  # groups of their own
                yield -1 - key % (1 << 30), pack_runs(ids[part], rows[part], place[part], count[part])
            left = np.flatnonzero(~again)
            left = left[np.argsort(bucket[left], kind="stable")]
            cuts = runs(bucket[left])
            for s, e in zip(cuts, np.append(cuts[1:], len(left))):
                part = left[s:e]
                body = b"".join([text[starts[i]:ends[i]] for i in part.tolist()])
                yield int(bucket[part[0]]), zstandard.compress(
                    pack_runs(ids[part], rows[part], place[part], count[part]) + body, 1)

        def out(rows):
            rows = list(rows)
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())],
                    ["bucket", "block"])

        shift = np.uint64(64 - bucket_bits - 32)
        for ids, data, offs, marks in _batches(batches):
            doc, at, count, h = phrases(data, offs, length, gram)
            if len(doc):
                key = h >> shift
                bucket = key >> LOW
                bit = bucket * np.uint64(per) + (((key & np.uint64(0xFFFFFFFF)) * np.uint64(per)) >> LOW)
                hit = (bits[bit >> np.uint64(3)] >> (np.uint64(7) - (bit & np.uint64(7))).astype(np.uint8)) & 1
                doc, at, count, bucket = (x[hit.astype(bool)] for x in (doc, at, count, bucket))
                if len(doc):
                    place = (at - offs[doc]).astype(np.int64)
                    held.append((bucket.astype(np.int32), ids[doc], marks[doc], place,
                                 count.astype(np.int32),
                                 _gather(data, at, count + length - 1).tobytes()))
                    size += int(count.sum())
            if size >= FLUSH:
                yield from out(flush(flushes))
                flushes += 1
                held, size = [], 0
        if held:
            yield from out(flush(flushes))
    return run


def pack_runs(ids: np.ndarray, rows: np.ndarray, place: np.ndarray, count: np.ndarray) -> bytes:
    """Runs of starts: the document's id, its row's number, the place of the first start, how many starts."""
    return b"".join([np.int64(len(ids)).tobytes(), *(x.astype(np.int64).tobytes() for x in (ids, rows, place)),
                     count.astype(np.int32).tobytes()])


def unpack_runs(block: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    n = int(np.frombuffer(block, np.int64, 1)[0])
    ids, rows, place = np.frombuffer(block, np.int64, 3 * n, 8).reshape(3, n)
    return ids, rows, place, np.frombuffer(block, np.int32, n, 8 + 24 * n), 8 + 28 * n


def corpus_order(data: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes at ``starts`` in the order of their first ``length`` bytes; and group numbers of equal ones.

    Sorted by eight bytes, then only what is still tied by the next eight, and
    so on; suffixes that differ from all others leave early.
    """
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    words = np.ndarray((len(data) + 1,), ">u8", padded, strides=(1,))
    order = np.arange(len(starts))
    group = np.zeros(len(starts), np.int64)  # of the sorted suffixes; equal so far
    active = np.arange(len(starts))          # places in the order that are still tied
    for off in range(0, length, 8):
        if len(active) == 0:
            break
        w = words[starts[order[active]] + off].astype(np.uint64)
        if length - off < 8:
            w >>= np.uint64(8 * (8 - (length - off)))
        g = group[active]
        by = np.lexsort((w, g)) if off else np.argsort(w, kind="stable")
        order[active] = order[active][by]
        g, w = g[by], w[by]
        new = np.concatenate(([True], (g[1:] != g[:-1]) | (w[1:] != w[:-1])))
        # a group is named by the place of its first member, so names stay in order
        first = active[np.flatnonzero(new)]
        group[active] = first[np.cumsum(new) - 1]
        size = np.diff(np.append(np.flatnonzero(new), len(active)))
        active = active[np.repeat(size > 1, size)]
    return order, group


def _repeats(length: int):
    """A bucket's blocks -> (mark, run, starts): runs of starts that repeat a smaller document's string."""

    def emit(rows, place, count):
        # number of the row, place of the run's first start, how many starts
        return pa.table({"mark": pa.array(rows), "run": pa.array(place), "starts": pa.array(count.astype(np.int32))})

    def run(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        if int(key[0].as_py()) < 0:
            got = [unpack_runs(x.as_py())[1:4] for x in group.column("block")]
            return emit(*(np.concatenate([g[i] for g in got]) for i in range(3)))
        index: dict[bytes, int] = {}
        which, ids, rows, place, count = [], [], [], [], []
        for block in group.column("block"):
            raw = zstandard.decompress(block.as_py())
            d, r, t, c, at = unpack_runs(raw)
            for n in c.tolist():
                end = at + n + length - 1
                which.append(index.setdefault(raw[at:end], len(index)))
                at = end
            ids.append(d)
            rows.append(r)
            place.append(t)
            count.append(c)
        which = np.array(which, np.int64)
        ids, rows, place, count = (np.concatenate(x) for x in (ids, rows, place, count))
        least = np.full(len(index), np.iinfo(np.int64).max)
        np.minimum.at(least, which, ids)
        whole = ids > least[which]
        out = [(rows[whole], place[whole], count[whole])]
        # the dictionary's suffixes, in corpus order
        size = np.fromiter(map(len, index), np.int64, len(index))
        data = np.frombuffer(b"".join(index), np.uint8)
        begin = np.cumsum(size) - size
        n = size - length + 1
        phrase = np.repeat(np.arange(len(size)), n)
        inside = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        order, same = corpus_order(data, begin[phrase] + inside, length)
        start = runs(same)
        if len(start) < len(same):
            sizes = np.diff(np.append(start, len(same)))
            low = np.repeat(np.minimum.reduceat(least[phrase[order]], start), sizes)
            dup = np.zeros(len(phrase), bool)
            dup[order] = low < least[phrase[order]]
            # runs of repeated starts in each phrase, for its occurrences in the least document
            at = np.flatnonzero(dup)
            if len(at):
                new = np.concatenate(([True], (at[1:] != at[:-1] + 1) | (phrase[at[1:]] != phrase[at[:-1]])))
                s = at[new]
                c = np.diff(np.append(np.flatnonzero(new), len(at)))
                owner = phrase[s]
                mine = np.flatnonzero(~whole)
                mine = mine[np.argsort(which[mine], kind="stable")]
                lo = np.searchsorted(which[mine], owner, "left")
                k = np.searchsorted(which[mine], owner, "right") - lo
                pick = mine[np.repeat(lo, k) + np.arange(int(k.sum())) - np.repeat(np.cumsum(k) - k, k)]
                out.append((rows[pick], place[pick] + np.repeat(inside[s], k), np.repeat(c, k)))
        return emit(*(np.concatenate([o[i] for o in out]) for i in range(3)))
    return run


def _removed(length: int):
    """(doc row, text, runs) -> lengths, spans and the kept bytes."""
    schema = pa.schema([("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                        ("spans", pa.list_(pa.int64())), ("kept", pa.binary())])

    def run(batches):
        for batch in batches:
            got: dict[str, list] = {f.name: [] for f in schema}
            for text, found in zip(batch.column(1), batch.column(2)):
                raw = (text.as_py() or "").encode()
                kept, spans = raw, []
                if found.is_valid and len(found.values):
                    s = found.values.field("run").to_numpy(zero_copy_only=False)
                    count = found.values.field("starts").to_numpy(zero_copy_only=False)
                    e = s + count + length - 1
                    order = np.argsort(s, kind="stable")
                    s, top = s[order], np.maximum.accumulate(e[order]) if len(s) else e
                    if len(s):
                        new = np.concatenate(([True], s[1:] > top[:-1]))
                        begin = s[new].tolist()
                        end = top[np.append(np.flatnonzero(new)[1:] - 1, len(s) - 1)].tolist()
                        spans = [x for pair in zip(begin, end) for x in pair]
                        kept = b"".join([raw[a:b] for a, b in zip([0, *end], [*begin, len(raw)])])
                got["n_bytes"].append(len(raw))
                got["n_removed"].append(len(raw) - len(kept))
                got["n_spans"].append(len(spans) // 2)
                got["spans"].append(spans)
                got["kept"].append(kept)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(got[f.name], f.type) for f in schema)],
                ["row", *schema.names])
    return run


def repeated_passages(docs: DataFrame, length: int = 50, gram: int = 24,
                      filter_bits: int = FILTER_BITS, carry: list[str] | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, spans, kept and ``carry``'s columns.

    ``spans`` lists from, to, from, to, ... of the maximal removed runs (byte
    places); ``kept`` is what is left.  A null text is empty; a text shorter
    than ``length`` keeps all its bytes.  Rows with a null doc_id have no
    place in the order: they lose nothing and take nothing from others.
    Repeated rows with one doc_id don't take from each other.  doc_id must be
    an integer.  Empty input: an empty result.  Rows are told apart by their
    number in the scan, so ``docs`` must be a plan that reads the same rows in
    the same order again, such as a table.
    """
    spark = docs.sparkSession
    carry = [c for c in (carry or []) if c not in ("doc_id", "text")]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.monotonically_increasing_id().alias("mark"),
                       F.struct("doc_id", *carry).alias("row"))
    source = rows.where("doc_id is not null and octet_length(text) >= " + str(int(length))).select(
        "doc_id", "text", "mark")
    bucket_bits = max(10, pow2_at_least(4 * partitions(docs)).bit_length() - 1)
    filter_ = trigger_filter(source, length, gram, bucket_bits, filter_bits)
    shared = spark.sparkContext.broadcast(filter_)
    blocks = map_arrow(source, _phrase_blocks(length, gram, bucket_bits, filter_bits, shared),
                       "bucket int, block binary")
    found = blocks.groupBy("bucket").applyInArrow(_repeats(length), "mark long, run long, starts int")
    by_row = found.groupBy("mark").agg(F.collect_list(F.struct("run", "starts")).alias("found"))
    joined = rows.join(by_row, "mark", "left").select("row", "text", "found")
    row_type = joined.schema["row"].dataType.simpleString()
    out = map_arrow(joined, _removed(length), f"row {row_type}, n_bytes long, n_removed long, n_spans long, "
                                               "spans array<bigint>, kept binary")
    return out.select("row.*", "n_bytes", "n_removed", "n_spans", "spans", "kept")
