"""Language-model scores by online logistic context mixing.

**Model.**  A text is lower-cased (A-Z) and read as symbols: the most frequent
bytes of the training texts, an escape for the others, and an end.  A symbol
is a path of binary decisions through the training texts' Huffman tree.  For
each decision, predictors of several orders look up the decision's training
counts in their hashed context and give a logit.  Weights, chosen by a gate
(the decision's depth and how much the word so far and the longest context
have been seen), mix the logits.  An adaptive correction of the weights, one
for each text, refines them online: after each block of symbols (32 at first,
256 later) it takes a damped Newton step on the text's coding loss.  Every
probability depends on training counts and on earlier blocks of the same text
only, so the sum of logs is the log probability of the text, end included,
whatever else is in its batch.

**Training** counts every training text: each task adds its symbols up in
tables of hashed contexts, sends the filled cells, and groups sum them, first
by slice of a table and lot of tasks, then by slice.  The tables' rows grow
with the training bytes (``BYTES_A_ROW``) up to ``max_rows``, a bound of
memory: tables are collected slice by slice and broadcast.

**Weights.**  Gate weights are fitted on every decision of every training text.
Texts are halved by hash, and each half is looked up in the tables of the
other one, so that a text (and its copies) is as new to the predictors as a
held-out text.  All that the loss depends on is how often each gate saw each
combination of logits: tasks count these, groups add them up, and each gate's
group fits its weights to the sums.  The damping is the information that a
block of training text holds about a weight, from the same sums.

**Base score.**  Word counts of the whole training fold: a task sends each
chunk's distinct words once (hash and count) to word buckets, and the chunk's
(word, text) pairs to the chunk's own group.  Buckets add counts up and answer
each chunk with one number per word.  No group holds more than a chunk's pairs
or a bucket's words, so a word in every text costs one entry per chunk.
"""

from __future__ import annotations

import functools
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import joined_bytes, lower_ascii, map_arrow, packs, partitions, runs, written

#: Symbols of context of each predictor; 0 is the word so far.
ORDERS = (3, 5, 0)
#: Rows of a slice of a table; each table has whole slices.
SLICE = 4096
#: Training bytes for each row of the word's table (and its least rows); that of five symbols has half of its rows.
BYTES_A_ROW, LEAST_ROWS = 1536, 32 * SLICE
COLUMNS, SYMBOLS = 64, 63
END, ESCAPE = 0, 62
PAD = 5
#: First symbols of a text's blocks; from the last one on each block has ``BLOCK``.
STARTS = np.array([0, 32, 64, 128])
BLOCK = 256
#: Training counts of a decision up to which its confidence is 0, 1, 2; beyond, 3.
LEVELS = (0.5, 3.5, 30.5)
GATES = 32
PRIOR = 0.1
#: Steps of a logit; a table of a gate's combinations of them has as many cells as a slice.
STEPS = 64
#: Keys of decisions: how many there are, what turns the steps into the negatives', the mark of a later decision.
KEYS, NEGATIVE, LATER = 1 << 23, np.uint32(0x3F3F3F), np.uint32(1 << 22)
#: Symbols that are looked up, and decisions that are mixed, at a time (arrays that stay in the cache).
LOOKED_UP, MIXED = 4096, 1 << 15
#: Bytes of text whose contexts are found at a time, and whose lookups are told apart at a time.
CODED, TOLD_APART = 1 << 16, 1 << 20
#: Bytes of text that are scored at a time.
SCORED = 1 << 19
END_WORD = b" "
CHUNK = 6 << 20


# ---------------------------------------------------------------- words

def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    """(word and text of each token, the ends last; tokens of each text; the distinct words)."""
    n = len(texts)
    parts = pc.ascii_split_whitespace(pc.ascii_lower(texts.cast(pa.large_string()).fill_null("")))
    doc = pc.list_parent_indices(parts).to_numpy()
    words = parts.flatten()
    full = pc.greater(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)  # none before the first white space
    if not full.all():
        words, doc = words.filter(pa.array(full)), doc[full]
    named = words.dictionary_encode()
    index = [*named.dictionary.cast(pa.large_binary()).to_numpy(zero_copy_only=False).tolist(), END_WORD]
    word = np.concatenate([named.indices.to_numpy().astype(np.int64), np.full(n, len(index) - 1)])
    doc = np.concatenate([doc, np.arange(n)])
    return word, doc, np.bincount(doc, minlength=n), index


def _word_rows(buckets: int):
    """Chunks of texts -> rows (kind, key, chunk, blob): 0 words of a bucket, 1 pairs of a chunk, 2 bytes' counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        n = 0

        def emit(rows):
            return pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int64()),
                 pa.array([r[2] for r in rows], pa.int64()), pa.array([r[3] for r in rows], pa.binary())],
                ["kind", "key", "chunk", "blob"])

        for batch in batches:
            for lo, hi in packs(batch.column(2), CHUNK):
                chunk = (part << 24) | n
                n += 1
                word, doc, size, index = _words(batch.column(2).slice(lo, hi - lo))
                train = ~batch.column(3).slice(lo, hi - lo).to_numpy(zero_copy_only=False).astype(bool)
                count = np.bincount(word[train[doc]], minlength=len(index)).astype(np.uint32)
                pair, tf = np.unique(doc * len(index) + word, return_counts=True)
                hashes = np.array([xxhash.xxh64_intdigest(w) for w in index], np.uint64)
                bucket = (hashes % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                edge = np.searchsorted(bucket[order], np.arange(buckets + 1))
                rows = []
                for b in range(buckets):
                    mine = order[edge[b]:edge[b + 1]]
                    if len(mine):
                        rows.append((0, b, chunk, hashes[mine].tobytes() + count[mine].tobytes()))
                head = np.array([len(size), len(pair), len(index)], np.int64).tobytes()
                keys = [batch.column(c).slice(lo, hi - lo).to_numpy(zero_copy_only=False).astype(np.int64).tobytes()
                        for c in (0, 1)]
                rows.append((1, chunk, chunk, zstandard.compress(b"".join(
                    [head, *keys, size.tobytes(), (pair // len(index)).astype(np.uint32).tobytes(),
                     (pair % len(index)).astype(np.uint32).tobytes(), tf.astype(np.uint32).tobytes(),
                     order.astype(np.uint32).tobytes(), edge.astype(np.int64).tobytes()]), 1)))
                data, _ = joined_bytes(batch.column(2).slice(lo, hi - lo).filter(pa.array(train)))
                rows.append((2, chunk, chunk, np.bincount(lower_ascii(data), minlength=256).astype(np.int64).tobytes()))
                yield emit(rows)
    return run


def _bucket_counts(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
    """Words of a bucket from all chunks -> each chunk's counts over the corpus; chunk -1: distinct words and tokens."""
    hashes, counts = [], []
    for x in group.column("blob"):
        raw = x.as_py()
        n = len(raw) // 12
        hashes.append(np.frombuffer(raw, np.uint64, n))
        counts.append(np.frombuffer(raw, np.uint32, n, 8 * n))
    words, inv = np.unique(np.concatenate(hashes), return_inverse=True)
    total = np.bincount(inv, weights=np.concatenate(counts).astype(np.float64), minlength=len(words)).astype(np.int64)
    ends = np.cumsum([len(h) for h in hashes])
    answer = [zstandard.compress(total[inv[e - len(h):e]].tobytes(), 1) for h, e in zip(hashes, ends)]
    stats = np.array([(total > 0).sum(), total.sum()], np.int64).tobytes()
    return pa.table({"chunk": pa.array([*group.column("chunk").to_pylist(), -1], pa.int64()),
                     "key": pa.array([key[0].as_py()] * (len(answer) + 1), pa.int64()),
                     "kind": pa.array([0] * len(answer) + [3], pa.int32()), "blob": pa.array([*answer, stats], pa.binary())})


def _chunk_scores(distinct: int, tokens: int, buckets: int):
    """A chunk's pairs and the buckets' answers -> (k1, k2, n_tokens, n_known, base_score) of its texts."""
    def run(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        kinds = group.column("kind").to_pylist()
        blobs, keys = group.column("blob"), group.column("key").to_pylist()
        at = kinds.index(1)
        raw = zstandard.decompress(blobs[at].as_py())
        docs, pairs, words = np.frombuffer(raw, np.int64, 3).tolist()
        pos = 24

        def take(kind, n):
            nonlocal pos
            got = np.frombuffer(raw, kind, n, pos)
            pos += got.nbytes
            return got
        k1, k2, size = take(np.int64, docs), take(np.int64, docs), take(np.int64, docs)
        doc, word, tf = take(np.uint32, pairs), take(np.uint32, pairs), take(np.uint32, pairs)
        order, edge = take(np.uint32, words), take(np.int64, buckets + 1)
        count = np.zeros(words, np.int64)
        for i, kind in enumerate(kinds):
            if kind == 0:
                b = keys[i]
                count[order[edge[b]:edge[b + 1]]] = np.frombuffer(zstandard.decompress(blobs[i].as_py()), np.int64)
        c = count[word]
        base = np.bincount(doc, weights=tf * np.log10(c + 1.0), minlength=docs)
        base -= size * np.log10(float(tokens + distinct + 1))
        known = np.bincount(doc, weights=tf * (c > 0), minlength=docs).astype(np.int64)
        return pa.table({"k1": k1, "k2": k2, "n_tokens": size, "n_known": known, "base_score": base})
    return run


# ---------------------------------------------------------------- symbols

class Code:
    """Symbols of bytes and the Huffman tree over them."""

    def __init__(self, histogram: np.ndarray, texts: int):
        top = np.argsort(-histogram, kind="stable")[:SYMBOLS - 2]
        self.symbol = np.full(256, ESCAPE, np.uint8)
        self.symbol[top] = np.arange(1, SYMBOLS - 1)
        self.space = np.zeros(SYMBOLS + 1, bool)  # white space, ends and blanks
        self.space[[END, *self.symbol[[9, 10, 11, 12, 13, 32]]]] = True
        self.space[ESCAPE] = False
        self.coded = self.symbol[lower_ascii(np.arange(256, dtype=np.uint8))].tobytes()  # symbols of bytes of any case
        self.gap = np.pad(self.space, (0, 256 - len(self.space))).tobytes()
        self.raw = np.log(256 - len(top))  # an escaped byte is one of the others
        weight = np.zeros(SYMBOLS)
        weight[1:SYMBOLS - 1] = histogram[top]
        weight[ESCAPE] = histogram.sum() - histogram[top].sum()
        weight[END] = texts
        # Huffman's tree with inner nodes 0 .. SYMBOLS - 2; weights are floored so that no path is long
        heap = [(max(w, weight.sum() * 1e-5) + 1, i, s) for i, (s, w) in enumerate(enumerate(weight))]
        heapq.heapify(heap)
        paths: list[list[tuple[int, int]]] = [[] for _ in range(SYMBOLS)]
        members = {s: [s] for s in range(SYMBOLS)}
        for node in range(SYMBOLS - 1):
            (w0, _, a), (w1, _, b) = heapq.heappop(heap), heapq.heappop(heap)
            for bit, child in ((0, a), (1, b)):
                for s in members[child]:
                    paths[s].append((node, bit))
            members[SYMBOLS + node] = members.pop(a) + members.pop(b)
            heapq.heappush(heap, (w0 + w1, SYMBOLS + node, SYMBOLS + node))
        self.length = np.array([len(p) for p in paths], np.int64)
        self.first = np.cumsum(self.length) - self.length
        flat = [x for p in paths for x in reversed(p)]
        self.node = np.array([x[0] for x in flat], np.int64)
        self.bit = np.array([x[1] for x in flat], np.int8)
        self.through = np.zeros((COLUMNS, COLUMNS))  # symbol, node: on its path
        self.ones = np.zeros((COLUMNS, COLUMNS))
        for s, p in enumerate(paths):
            for node, bit in p:
                self.through[s, node] = 1
                self.ones[s, node] = bit


def symbols(code: Code, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(padded symbols, places of the coded ones, their text): each text is PAD blanks, its symbols, an end."""
    n = len(offs) - 1
    doc = np.repeat(np.arange(n), np.diff(offs) + 1)
    coded = data.tobytes().translate(code.coded)
    edge = offs.tolist()
    between = bytes([END] * (PAD + 1))  # an end and the next text's blanks
    out = between.join([b"", *(coded[a:b] for a, b in zip(edge, edge[1:]))])[1:] + between[:1] if n else b""
    at = doc * PAD
    at += np.arange(PAD, PAD + len(doc))
    return np.frombuffer(out, np.uint8), at, doc


def word_hashes(code: Code, sym: np.ndarray) -> np.ndarray:
    """Before each place, a hash of the symbols since the last white space."""
    power, n = _powers(len(sym)), len(sym)
    value = sym.astype(np.uint64)
    value += np.uint64(1)
    value *= power[0][:n]
    np.cumsum(value, out=value)  # before place i: value[i - 1]
    gap = np.frombuffer(sym.astype(np.uint8).tobytes().translate(code.gap), bool).copy()
    gap[:1] = True
    start = np.flatnonzero(gap)
    size = np.diff(start, append=n)
    out = np.zeros(n, np.uint64)
    after = out[1:]
    np.subtract(value[:-1], np.repeat(value[start], size)[:-1], out=after)
    after *= np.repeat(power[1][start], size)[:-1]
    np.right_shift(out, np.uint64(29), out=value)
    out ^= value
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return out


_table: list[np.ndarray] = []


def _powers(n: int) -> list[np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2 ** 64, at least ``n`` of each."""
    if not _table or len(_table[0]) < n:
        size = 1 << max(20, int(n - 1).bit_length())
        base = 0x9E3779B97F4A7C15
        _table[:] = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            _table.append(np.multiply.accumulate(p))
    return _table


def table_rows(total: int, max_rows: int) -> list[int]:
    """Rows of each order's table for ``total`` bytes of training text."""
    word = min(max(total // BYTES_A_ROW, LEAST_ROWS), max(max_rows, SLICE))
    wanted = (8 * SLICE, word // 2, word)
    return [-(-n // SLICE) * SLICE for n in wanted]


def context_rows(code: Code, sym: np.ndarray, at: np.ndarray, rows: list[int]) -> list[np.ndarray]:
    """Row of each order's table before each place."""
    out = []
    wide = sym.astype(np.uint32)
    for order, size in zip(ORDERS, rows):
        if order == 0:
            c = word_hashes(code, sym)
            c >>= np.uint64(32)
        else:  # of all places but the first blanks, which are shifts of each other
            past = np.zeros(len(sym), np.uint32)
            c = past[PAD:]
            for i in range(order):
                c |= wide[PAD - 1 - i:len(sym) - 1 - i] << np.uint32(6 * i)
            past = (past * np.uint32(0x9E3779B1)) ^ (past >> np.uint32(15))
            past *= np.uint32(0x85EBCA6B)
            c = past.astype(np.uint64)
        c *= np.uint64(size)
        c >>= np.uint64(32)
        out.append(c.view(np.int64).take(at, mode="clip"))
    return out


def stretches(offs: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Slices ``(from, to)`` of texts, each of about ``limit`` bytes (one text at least)."""
    lo, n = 0, len(offs) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + limit, side="right")) - 1)
        yield lo, hi
        lo = hi


def coded(code: Code, data: np.ndarray, offs: np.ndarray, rows: list[int]) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
    """(symbols, rows of their contexts) of some texts at a time."""
    for lo, hi in stretches(offs, CODED):
        sym, at, _ = symbols(code, data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo])
        yield sym.take(at, mode="clip"), context_rows(code, sym, at, rows)


def _pack_cells(places: np.ndarray, counts: np.ndarray) -> bytes:
    """Ascending places and their counts."""
    gaps = np.diff(places, prepend=0).astype(np.uint32)
    return zstandard.compress(gaps.tobytes() + counts.astype(np.uint64).tobytes(), 1)


def _add_cells(total: np.ndarray, blob: bytes) -> None:
    raw = zstandard.decompress(blob)
    n = len(raw) // 12
    total[np.cumsum(np.frombuffer(raw, np.uint32, n), dtype=np.int64)] += np.frombuffer(raw, np.uint64, n, 4 * n)


def _cells_batch(o: int, s: int, lot: int, half: int, places: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [*(pa.array([x], pa.int32()) for x in (o, s, lot, half)), pa.array([_pack_cells(places, counts)], pa.binary())],
        ["ord", "slice", "lot", "half", "cells"])


def _count_cells(shared, rows: list[int], lots: int):
    """Training (text, half), one half in a task -> rows (ord, slice, lot, half, cells): filled cells of the task's tables."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code: Code = shared.value
        lot = TaskContext.get().partitionId() % lots
        total, half = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            total = total or [np.zeros(COLUMNS * n, np.uint32) for n in rows]
            half = batch.column(1)[0].as_py()
            for lo, hi in packs(batch.column(0), 1 << 18):
                for now, where in coded(code, *joined_bytes(batch.column(0).slice(lo, hi - lo)), rows):
                    for o, row in enumerate(where):
                        row *= COLUMNS
                        row += now
                        np.add.at(total[o], row, np.uint32(1))
        for o, t in enumerate(total):
            for s in range(rows[o] // SLICE):
                part = t[s * SLICE * COLUMNS:(s + 1) * SLICE * COLUMNS]
                full = np.flatnonzero(part)
                if len(full):
                    yield _cells_batch(o, s, lot, half, full, part[full])
    return run


def _sum_lot(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
    """Cells of a slice from a lot of tasks -> their sum, one row for each half."""
    out = []
    halves = group.column("half").to_pylist()
    for which in sorted(set(halves)):
        total = np.zeros(SLICE * COLUMNS, np.uint64)
        for x, mine in zip(group.column("cells"), halves):
            if mine == which:
                _add_cells(total, x.as_py())
        full = np.flatnonzero(total)
        out.append((which, _pack_cells(full, total[full])))
    n = len(out)
    return pa.table({"ord": pa.array([key[0].as_py()] * n, pa.int32()), "slice": pa.array([key[1].as_py()] * n, pa.int32()),
                     "half": pa.array([x[0] for x in out], pa.int32()), "cells": pa.array([x[1] for x in out], pa.binary())})


def _lots_summed(cells: DataFrame) -> DataFrame:
    return cells.groupBy("ord", "slice", "lot").applyInArrow(_sum_lot, "ord int, slice int, half int, cells binary")


def _slice_values(shared):
    """All lots' sums of a slice -> its cell values: of all texts, of the first half, of the second."""
    def run(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        code: Code = shared.value
        total = [np.zeros(SLICE * COLUMNS, np.uint64) for _ in range(2)]
        for x, half in zip(group.column("cells"), group.column("half").to_pylist()):
            _add_cells(total[half], x.as_py())
        blobs = []
        for t in (total[0] + total[1], *total):
            t = t.reshape(-1, COLUMNS).astype(np.float64)
            blobs.append(zstandard.compress(cell_values(t @ code.through, t @ code.ones).tobytes(), 1))
        return pa.table({"ord": pa.array([key[0].as_py()], pa.int32()), "slice": pa.array([key[1].as_py()], pa.int32()),
                         **{name: pa.array([blob], pa.binary()) for name, blob in zip(TABLES, blobs)}})
    return run


#: Tables of all training texts and of their two halves.
TABLES = ("every", "first", "second")


def _tables(values: DataFrame, which: str, rows: list[int]) -> list[np.ndarray]:
    """The tables of all orders, collected slice by slice; their size is bounded."""
    tables = [np.full(COLUMNS * n, UNSEEN, np.uint8) for n in rows]
    for r in values.select("ord", "slice", which).toLocalIterator():
        part = np.frombuffer(zstandard.decompress(bytes(r[which])), np.uint8)
        tables[r.ord][r.slice * len(part):(r.slice + 1) * len(part)] = part
    return tables


def cell_values(seen: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """A byte for each cell: logit of a one in steps of a quarter (upper six bits), confidence (lower two)."""
    logit = np.log((ones + PRIOR) / (seen - ones + PRIOR))
    step = np.clip(np.floor(logit * 4 + 32), 0, 63).astype(np.uint8)
    return (step << 2) | np.digitize(seen, LEVELS).astype(np.uint8)


def block_starts(number: np.ndarray) -> np.ndarray:
    late = BLOCK * (number - len(STARTS) + 1)
    return np.where(number < len(STARTS), STARTS[np.minimum(number, len(STARTS) - 1)], late)


#: The value of a cell without counts.
UNSEEN = int(cell_values(np.zeros(1), np.zeros(1))[0])


class Mixer:
    """Code, tables by order, weights (orders x gates) and damping; ``log10`` scores texts."""

    def __init__(self, code: Code, tables: list[np.ndarray], weights: np.ndarray, damping: float):
        self.code, self.tables, self.weights, self.damping = code, tables, weights, damping
        self.rows = [len(t) // COLUMNS for t in tables]
        self.bits = [(n - 1).bit_length() for n in self.rows]
        if SYMBOLS.bit_length() + sum(self.bits) > 63:
            raise ValueError(f"tables of {self.rows} rows are too large for one number by symbol")

    def lookups(self, now: np.ndarray, rows: list[np.ndarray]) -> np.ndarray:
        """Each symbol and its rows as one number: the symbol, then the last table's row, the first one's row lowest."""
        out = now.astype(np.uint64)
        for row, bits in zip(reversed(rows), reversed(self.bits)):
            out <<= np.uint64(bits)
            out |= row.view(np.uint64)
        return out

    def paths(self, lookups: np.ndarray) -> Iterator[tuple[int, int, int, np.ndarray]]:
        """(from, to, depth, keys): the decisions of ascending lookups, some thousands at a depth of a symbol's path.

        A key holds all that the mix depends on: from the low end the steps of
        the three logits (those of the bit that did not come), the last two
        each after its confidence, and whether the decision is a later one.
        """
        code, width = self.code, sum(self.bits)
        edge = np.searchsorted(lookups, np.arange(SYMBOLS, dtype=np.uint64) << np.uint64(width)).tolist()
        edge.append(len(lookups))
        for s in range(SYMBOLS):
            path = slice(code.first[s], code.first[s] + code.length[s])
            path = list(enumerate(zip(code.node[path].tolist(), code.bit[path].tolist())))
            for lo in range(edge[s], edge[s + 1], LOOKED_UP):
                hi = min(lo + LOOKED_UP, edge[s + 1])
                left, mine = lookups[lo:hi].view(np.int64), []
                for bits in self.bits:
                    row = left & ((1 << bits) - 1)
                    row *= COLUMNS
                    mine.append(row)
                    left = left >> bits
                for depth, (node, bit) in path:
                    near, far, word = (t[node:].take(r, mode="clip") for t, r in zip(self.tables, mine))
                    key = word.astype(np.uint32)
                    key <<= 8
                    key |= far
                    key <<= 6
                    near >>= 2
                    key |= near
                    if bit:
                        key ^= NEGATIVE
                    if depth:
                        key |= LATER
                    yield lo, hi, depth, key

    def decisions(self, sym: np.ndarray, at: np.ndarray, place: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(places, keys) of all decisions; ``place`` has that of each symbol's first decision."""
        lookups = self.lookups(sym[at], context_rows(self.code, sym, at, self.rows))
        by = np.argsort(lookups, kind="stable")
        for lo, hi, depth, key in self.paths(lookups[by]):
            yield place[by[lo:hi]] + depth, key

    def keys(self, now: np.ndarray, lookups: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(keys of all decisions, symbol after symbol in this order; the end of each symbol's): equal lookups once."""
        by = np.argsort(lookups)
        ranked = lookups[by]
        first = runs(ranked)
        which = np.empty(len(by), np.int64)
        which[by] = np.repeat(np.arange(len(first)), np.diff(first, append=len(by)))
        size = self.code.length[now[by[first]]]
        start = np.concatenate([[0], np.cumsum(size)])
        flat = np.empty(int(start[-1]), np.uint32)
        for lo, hi, depth, key in self.paths(ranked[first]):
            flat[start[lo] + depth:start[hi]:size[lo]] = key
        each = pa.Array.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(4 * start), pa.py_buffer(flat)])
        _, ends, got = each.take(pa.array(which[order])).buffers()
        ends = np.frombuffer(ends, np.int64, len(order) + 1)[1:] // 4
        return np.frombuffer(got, np.uint32, int(ends[-1])), ends

    def log10(self, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """log10 probability of each text (end included)."""
        code, n = self.code, len(offs) - 1
        if n == 0:
            return np.zeros(0)
        parts = [(now, self.lookups(now, rows)) for now, rows in coded(code, data, offs, self.rows)]
        now, lookups = (np.concatenate(x) for x in zip(*parts))
        del parts
        size = np.diff(offs) + 1
        begin = np.cumsum(size) - size
        # places in the order of (block, text)
        blocks = np.where(size <= BLOCK, np.searchsorted(STARTS, size), len(STARTS) - 1 - (-size // BLOCK))
        text = np.repeat(np.arange(n), blocks)
        number = np.arange(len(text)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        by = np.lexsort((text, number))
        text, number = text[by], number[by]
        start = block_starts(number)
        count = np.minimum(block_starts(number + 1), size[text]) - start
        order = np.repeat(begin[text] + start - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
        keys, ends = self.keys(now, lookups, order)
        edge = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(count)])]
        upper, lowest = self._shares
        first = np.searchsorted(number, np.arange(int(number[-1]) + 2))
        loss = np.zeros(n)
        change = np.zeros((len(ORDERS), n))
        curve = np.zeros((len(ORDERS), n))
        last = blocks[text] == number + 1
        # decisions of one block number are a stretch, in it each text is one; a stretch is taken in pieces
        for r in range(len(first) - 1):
            a, stop = int(first[r]), int(first[r + 1])
            while a < stop:
                b = min(stop, max(a + 1, int(np.searchsorted(edge, edge[a] + MIXED, side="right")) - 1))
                lo, hi = int(edge[a]), int(edge[b])
                who, inner = text[a:b], edge[a:b] - lo
                key = keys[lo:hi]
                xs = np.empty((len(ORDERS), hi - lo), np.float32)
                step = np.empty_like(key)
                for i, one in enumerate(xs):
                    np.right_shift(key, np.uint32(8 * i), out=step)
                    step &= np.uint32(STEPS - 1)
                    np.copyto(one, step)
                xs -= 31.5
                xs *= 0.25
                high = (key >> np.uint32(6)).astype(np.int64)
                z = lowest.take(high, mode="clip")
                z *= xs[0]
                z += upper.take(high, mode="clip")
                if r:
                    by_text = np.diff(edge[a:b + 1])
                    for d, one in zip(change[:, who].astype(np.float32), xs):
                        move = np.repeat(d, by_text)
                        move *= one
                        z += move
                e = np.exp(np.clip(z, -30, 30, out=z), out=z)  # odds against the bit that came
                miss = e + np.float32(1)
                loss[who] += np.add.reduceat(np.log(miss), inner, dtype=np.float64)
                if not last[a:b].all():  # blocks to learn for
                    e /= miss
                    slope = np.add.reduceat(e * xs, inner, axis=1)
                    np.subtract(1, e, out=miss)
                    miss *= e
                    xs *= xs
                    xs *= miss
                    curve[:, who] += np.add.reduceat(xs, inner, axis=1)
                    change[:, who] -= slope / (len(ORDERS) * curve[:, who] + self.damping)
                a = b
        escaped = np.add.reduceat(now == ESCAPE, begin, dtype=np.int64)
        return -(loss + escaped * code.raw) / np.log(10)

    @functools.cached_property
    def _shares(self) -> tuple[np.ndarray, np.ndarray]:
        """By a key without its lowest step: what the upper two logits add to the mix; the lowest one's weight."""
        high = np.arange(KEYS // STEPS)
        gate = (high >> 16) | ((high & 3) << 1) | (((high >> 8) & 3) << 3)
        x = [((high >> shift) & (STEPS - 1)) / 4 - 31.5 / 4 for shift in (2, 10)]
        return (sum(w[gate] * one for w, one in zip(self.weights[1:], x)).astype(np.float32),
                self.weights[0][gate].astype(np.float32))


def _count_steps(shared, lots: int):
    """Training (text, half) -> rows (ord, slice, lot, half, cells): of each gate (slice), how often it saw which steps."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mixers: list[Mixer] = shared.value
        lot = TaskContext.get().partitionId() % lots
        total = np.zeros(KEYS, np.uint32)
        for batch in batches:
            for lo, hi in packs(batch.column(0), TOLD_APART):
                half = batch.column(1).slice(lo, hi - lo).to_numpy()
                for which, mixer in enumerate(mixers):
                    if not (half == which).any():
                        continue
                    texts = batch.column(0).slice(lo, hi - lo).filter(pa.array(half == which))
                    seen = np.concatenate([mixer.lookups(*x) for x in coded(mixer.code, *joined_bytes(texts), mixer.rows)])
                    seen.sort()
                    first = runs(seen)  # equal lookups make the same decisions
                    often = np.diff(first, append=len(seen)).astype(np.uint32)
                    for a, b, _, key in mixer.paths(seen[first]):
                        np.add.at(total, key.astype(np.int64), often[a:b])
        # later, word's step and confidence, far's, near's step -> gate (confidences and later), steps
        total = total.reshape(2, STEPS, 4, STEPS, 4, STEPS).transpose(2, 4, 0, 5, 3, 1).reshape(GATES, -1)
        for g, part in enumerate(total):
            full = np.flatnonzero(part)
            if len(full):
                yield _cells_batch(0, g, lot, 0, full, part[full])
    return run


def _fit_gate(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
    """All lots' sums of a gate -> its weights and the information about each of them."""
    total = np.zeros(STEPS ** len(ORDERS), np.uint64)
    for x in group.column("cells"):
        _add_cells(total, x.as_py())
    full = np.flatnonzero(total)
    steps = np.stack([full // STEPS ** (len(ORDERS) - 1 - i) % STEPS for i in range(len(ORDERS))])
    weights, curve = fit_weights((steps - 31.5) / 4, total[full].astype(np.float64))
    return pa.table({"gate": pa.array([key[0].as_py()], pa.int32()), "weights": pa.array([weights.tolist()]),
                     "curve": pa.array([curve.tolist()])})


def fit_weights(x: np.ndarray, seen: np.ndarray, steps: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Weights of the least coding loss of decisions with logits ``x`` (of the bit that did not come), ``seen`` times each.

    Newton's method, with a ridge towards equal weights; the second result is
    the loss's curvature along each weight.
    """
    width = len(x)
    weights = np.full(width, 1 / width)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(weights @ x, -30, 30)))
        near = seen * p * (1 - p)
        curve = (near * x) @ x.T
        move = np.clip(np.linalg.solve(curve + np.eye(width), 1 / width - weights - x @ (seen * p)), -0.5, 0.5)
        weights += move
        if np.abs(move).max() < 1e-3:
            break
    return weights, np.diag(curve)


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mixer: Mixer = shared.value
        for batch in batches:
            out = np.zeros(batch.num_rows)
            size = np.zeros(batch.num_rows, np.int64)
            # texts of like length go together: a pack takes as many rounds as its longest text has blocks
            order = np.argsort(pc.binary_length(batch.column(1)).to_numpy(), kind="stable")
            texts = batch.column(1).take(pa.array(order))
            for lo, hi in packs(texts, SCORED):
                data, offs = joined_bytes(texts.slice(lo, hi - lo))
                out[order[lo:hi]] = mixer.log10(data, offs)
                size[order[lo:hi]] = np.diff(offs)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(size), pa.array(out)], ["row", "n_bytes", "score"])
    return run


def fit(train: DataFrame, histogram: np.ndarray, texts: int, max_rows: int = 1 << 20) -> Mixer:
    """The model of all of ``train(text)``; ``histogram`` counts its lower-cased bytes.

    ``max_rows`` bounds the rows (of 64 bytes) of the largest table.
    """
    sc = train.sparkSession.sparkContext
    code = Code(histogram, texts)
    rows = table_rows(int(histogram.sum()), max_rows)
    shared = sc.broadcast(code)
    halved = train.select("text", F.pmod(F.xxhash64("text"), F.lit(2)).cast("int").alias("half"))  # copies are in one half
    lots = max(1, round((2 * partitions(train)) ** 0.5))
    cells = map_arrow(halved.where("half = 0").unionByName(halved.where("half = 1")), _count_cells(shared, rows, lots),
                      "ord int, slice int, lot int, half int, cells binary")
    values = written(_lots_summed(cells).groupBy("ord", "slice").applyInArrow(
        _slice_values(shared), "ord int, slice int, " + ", ".join(f"{t} binary" for t in TABLES)))
    even = np.full((len(ORDERS), GATES), 1 / len(ORDERS), np.float32)
    # each half is looked up in the other's tables
    others = sc.broadcast([Mixer(code, _tables(values, t, rows), even, 0.0) for t in ("second", "first")])
    steps = map_arrow(halved, _count_steps(others, lots), "ord int, slice int, lot int, half int, cells binary")
    fitted = _lots_summed(steps).groupBy("slice").applyInArrow(
        _fit_gate, "gate int, weights array<double>, curve array<double>").collect()  # one row per gate
    others.unpersist()
    weights, curve = even.copy(), np.zeros(len(ORDERS))
    for r in fitted:
        weights[:, r.gate] = r.weights
        curve += r.curve
    return Mixer(code, _tables(values, "every", rows), weights, damping(curve, int(histogram.sum()) + texts))


def damping(curve: np.ndarray, symbols: int) -> float:
    """Damping of the correction's Newton steps: a block's mean information about a weight, as the steps count it."""
    return float(max(1.0, len(ORDERS) * curve.mean() * BLOCK / symbols))


def score(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte) for every row.

    ``docs`` has doc_id, text and held_out (false: learn from it).  A null
    text is empty: one token, the end.  ``score`` is the log10 probability of
    the lower-cased text under the mixing model; ``base_score`` that of its
    words under add-one counts.  Repeated rows, null ids and ids of any type are
    rows like any others; an empty table gives an empty result.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", "held_out", text.alias("text"),
                       F.xxhash64("doc_id").alias("k1"), F.xxhash64(text).alias("k2"))
    buckets = max(24, partitions(docs))
    sent = written(map_arrow(rows.select("k1", "k2", "text", "held_out"), _word_rows(buckets),
                             "kind int, key long, chunk long, blob binary"))
    answers = written(sent.where("kind = 0").select("key", "chunk", "blob").groupBy("key").applyInArrow(
        _bucket_counts, "chunk long, key long, kind int, blob binary"))
    distinct = tokens = 0
    for r in answers.where("kind = 3").select("blob").toLocalIterator():  # one row per bucket
        v, n = np.frombuffer(bytes(r.blob), np.int64)
        distinct, tokens = distinct + int(v), tokens + int(n)
    both = sent.where("kind = 1").unionByName(answers.where("kind = 0"))
    base = both.groupBy("chunk").applyInArrow(
        _chunk_scores(distinct, tokens, buckets), "k1 long, k2 long, n_tokens long, n_known long, base_score double")
    base = base.dropDuplicates(["k1", "k2"])  # repeated rows have the same scores

    histogram = np.zeros(256, np.int64)
    sums = map_arrow(sent.where("kind = 2").select("blob"), _sum_histograms, "blob binary")
    for r in sums.toLocalIterator():  # one row per partition
        histogram += np.frombuffer(bytes(r.blob), np.int64)
    train = rows.where(~F.col("held_out"))
    mixer = fit(train, histogram, max(1, train.select("k1").count()))
    shared = docs.sparkSession.sparkContext.broadcast(mixer)
    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = map_arrow(rows.select(F.struct("doc_id", "held_out", "k1", "k2").alias("row"), "text"), _score(shared),
                       f"row struct<doc_id:{kind},held_out:boolean,k1:bigint,k2:bigint>, n_bytes long, score double")
    return scored.select("row.*", "n_bytes", "score").join(base, ["k1", "k2"]).select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"), "base_score",
        "score", (-F.col("score") * float(np.log2(10)) / F.greatest(F.col("n_bytes"), F.lit(1))).alias("bits_per_byte"))


def _sum_histograms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(256, np.int64)
    for batch in batches:
        for x in batch.column(0):
            total += np.frombuffer(x.as_py(), np.int64)
    yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["blob"])
