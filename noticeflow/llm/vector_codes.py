"""Product codes of integer vectors: k-means codebooks from exact integer products.

Components become integers, vectors are cut into equal parts, and each part
position has a codebook.  Which entry is nearest is decided exactly: integers
are split into limbs small enough that a float64 BLAS product of two limb
matrices stays below 2^53, the products are put together again in int64, and
the first of the least distances wins.  A round sums the parts of each entry
inside its task first, so a task sends one row per part and entry whatever the
number of vectors; the codebooks (``parts * entries`` rows for each vector
length) are all that the driver holds.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import attach, map_arrow, written


def largest(n: int) -> int:
    """Components of n-vectors beyond this are refused: squared distances would leave 64 bits."""
    return math.isqrt((1 << 61) // max(n, 1)) - 1


def limbs(values: np.ndarray, width: int) -> list[np.ndarray]:
    """float64 arrays that sum to ``values`` when limb i is shifted by i * width bits; only the last may be negative."""
    out = []
    while values.size and (values.max() >= 1 << width or values.min() < -(1 << width)):
        out.append((values & ((1 << width) - 1)).astype(np.float64))
        values = values >> width
    return [*out, values.astype(np.float64)]


def exact_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a @ b.T`` of int64 matrices, exact: every BLAS product of limbs stays below 2^53."""
    depth = a.shape[1]
    width = (53 - max(depth, 1).bit_length()) // 2
    out = np.zeros((len(a), len(b)), np.int64)
    right = limbs(b, width)
    for i, x in enumerate(limbs(a, width)):
        for j, y in enumerate(right):
            out += (x @ y.T).astype(np.int64) << (width * (i + j))
    return out


def nearest(part: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the nearest entry, the lower at a tie; squared distance) for each row of ``part``."""
    norms = (book * book).sum(axis=1)
    score = norms - 2 * exact_products(part, book)
    index = score.argmin(axis=1)
    return index, (part * part).sum(axis=1) + score[np.arange(len(part)), index]


def _integers(column: pa.Array, scale: float, parts: int):
    """(row numbers, parts as int64 of shape (rows, parts, width)) for each vector length of a batch; unfit rows are left out."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    rows = np.flatnonzero(column.is_valid().to_numpy(zero_copy_only=False))
    column = column.drop_null()
    size = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().cast(pa.float64())
    flat = flat.fill_null(np.nan).to_numpy(zero_copy_only=False) if flat.null_count else flat.to_numpy()
    start = np.cumsum(size) - size
    for n in np.unique(size):
        at = np.flatnonzero(size == n)
        x = flat[start[at][:, None] + np.arange(n)]
        fit = np.isfinite(x).all(axis=1)
        with np.errstate(over="ignore"):
            x = np.floor(scale * x[fit])
        if x.size and np.abs(x).max() > largest(int(n)):
            raise ValueError(f"components of {n}-vectors times {scale:g} must lie within +-{largest(int(n))}")
        width = -(-int(n) // parts)
        padded = np.zeros((len(x), width * parts), np.int64)
        padded[:, :n] = x
        yield int(n), rows[at[fit]], padded.reshape(len(x), parts, width)


def _sums(books: dict[int, np.ndarray], scale: float, parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = {n: np.zeros(b.shape[:2], np.int64) for n, b in books.items()}
        total = {n: np.zeros(b.shape, np.int64) for n, b in books.items()}
        for batch in batches:
            for n, _, x in _integers(batch.column(0), scale, parts):
                for p in range(parts if len(x) else 0):
                    index, _ = nearest(x[:, p], books[n][p])
                    count[n][p] += np.bincount(index, minlength=count[n].shape[1])
                    np.add.at(total[n][p], index, x[:, p])
        out = [(n, p, e, int(count[n][p, e]), total[n][p, e].tolist())
               for n in books for p in range(parts) for e in range(count[n].shape[1]) if count[n][p, e]]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in out], t) for i, t in enumerate(
                (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64())))],
            ["n", "part", "entry", "rows", "sums"])
    return run


def _codes(books: dict[int, np.ndarray], scale: float, parts: int):
    digits = np.frombuffer("".join(f"{i:02x}" for i in range(256)).encode(), np.uint8).reshape(256, 2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n, rows, x in _integers(batch.column(2), scale, parts):
                index = np.zeros((len(x), parts), np.int64)
                error = np.zeros(len(x), np.int64)
                for p in range(parts if len(x) else 0):
                    index[:, p], d = nearest(x[:, p], books[n][p])
                    error += d
                code = np.ascontiguousarray(digits[index]).reshape(len(x), 2 * parts).view(f"S{2 * parts}").ravel()
                at = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), batch.column(1).take(at), pa.array(np.full(len(x), n, np.int32)),
                     pa.array(code.tolist(), pa.binary()).cast(pa.string()), pa.array(error)],
                    ["vec_id", "label", "n", "code", "error"])
    return run


def fit_vector(vector: Column) -> Column:
    """The vector is there and holds neither nulls nor values that are not finite."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(odd, F.lit(False))


def first_books(vectors: DataFrame, scale: float, parts: int, entries: int) -> dict[int, np.ndarray]:
    """Codebooks by vector length from the ``entries`` rows of least vec_id (null ids last, ties by vector)."""
    kept = vectors.where(fit_vector(F.col("embedding")))
    books = {}
    for (n,) in kept.select(F.size("embedding")).distinct().collect():  # one row per distinct vector length
        rows = (kept.where(F.size("embedding") == n).orderBy(F.col("vec_id").asc_nulls_last(), "embedding")
                .limit(entries).select("embedding").collect())
        column = pa.array([r[0] for r in rows], pa.list_(pa.float64()))
        (_, _, x), = _integers(column, scale, parts)
        books[n] = np.ascontiguousarray(x.transpose(1, 0, 2))
    return books


def improved(vectors: DataFrame, books: dict[int, np.ndarray], scale: float, parts: int) -> dict[int, np.ndarray]:
    """One round: each entry becomes the floored mean of the parts that are nearest to it; unused ones stay."""
    found = map_arrow(vectors.select("embedding"), _sums(books, scale, parts),
                      "n int, part int, entry int, rows long, sums array<long>")
    sums = (found.select("n", "part", "entry", "rows", F.posexplode_outer("sums").alias("i", "s"))
            .groupBy("n", "part", "entry", "i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"),
                                                    F.sum("rows").alias("rows")))
    out = {n: b.copy() for n, b in books.items()}
    for r in sums.where("i IS NOT NULL").collect():  # one row per codebook component
        out[r.n][r.part, r.entry, r.i] = int(r.s) // int(r.rows)
    return out


def digest(book: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, book.ravel().tolist())).encode()).hexdigest()


def product_codes(vectors: DataFrame, scale: float = 4096.0, parts: int = 8, entries: int = 16,
                  rounds: int = 6) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 for ``vectors(vec_id, embedding, label)``.

    Rows whose vector is null or holds nulls or values that are not finite are
    left out.  Repeated ids are coded row by row; a null id is coded too, and
    comes last among the starting entries.  With fewer rows than ``entries``
    the codebooks are that much shorter.  Vectors of another length have
    codebooks of their own; a length that ``parts`` does not divide is filled
    up with zeros, an empty vector has error 0.  An empty table gives an empty
    result.  Scaled components that 64-bit distances cannot hold (beyond 2^27 for
    64 components) end the run with an error.
    """
    if not 0 < entries <= 256:
        raise ValueError("entries must be 1 to 256")
    books = first_books(vectors, scale, parts, entries)
    for _ in range(rounds):
        books = improved(vectors, books, scale, parts)
    kinds = {f.name: f.dataType.simpleString() for f in vectors.schema}
    coded = written(map_arrow(vectors.select("vec_id", "label", "embedding"), _codes(books, scale, parts),
                              f"vec_id {kinds['vec_id']}, label {kinds['label']}, n int, code string, error long"))
    totals = coded.groupBy("label").agg(F.count(F.lit(1)).alias("rows"), F.sum("error").alias("label_error"))
    pairs = [x for n, b in books.items() for x in (F.lit(n), F.lit(digest(b)))]
    sha = F.element_at(F.create_map(*pairs), F.col("n")) if pairs else F.lit(None).cast("string")
    return attach(coded, totals, "label", "rows").select(
        "vec_id", "code", "error", "label_error", sha.alias("codebooks_sha256"))
