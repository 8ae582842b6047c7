"""Exact top-k by inner product as a Voronoi join.

Pivots cut the data into cells (each vector goes to its nearest pivot, inside
its own task).  A cell's summary is its least distances to the pivot, one for each
vec_id and k + 1 of them; the query side turns the summaries into a lower bound
of each query's k-th best score (``q.p - |q| d`` for every summarised distance
of another vec_id) and from that,
for each pair of query group and cell, the distance a vector needs to matter
(``q.x <= q.p + |q| d``).  Only blocks of vectors that reach it are replicated
to the group and searched there.

Queries and vectors travel as blocks of bounded size, so a group or cell that
holds a third of all rows is many blocks over many tasks.  Pivots and
summaries are of a fixed size: ``pivots`` vectors and ``pivots * (k + 1)``
ids and distances, whatever the size of the table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import cut, map_arrow

#: Vectors in a block of data and in a block of queries.
BLOCK, QUERY_BLOCK = 2048, 256


def _vectors(batch: pa.RecordBatch, dim: int, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """(ids, whole-number vectors) of the rows that take part."""
    ids, out = [], []
    for i, v in zip(batch.column(0), batch.column(1)):
        if v.is_valid and len(v) == dim and v.values.null_count == 0 and i.is_valid:
            x = v.values.to_numpy(zero_copy_only=False).astype(np.float64)
            if np.isfinite(x).all():
                ids.append(i.as_py())
                out.append(np.floor(x * scale))
    return np.array(ids, np.int64), np.array(out, np.float64).reshape(len(ids), dim)


def _nearest(x: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    d2 = (x * x).sum(1)[:, None] - 2 * x @ pivots.T + (pivots * pivots).sum(1)[None]
    cell = d2.argmin(1)
    return cell, np.sqrt(((x - pivots[cell]) ** 2).sum(1))


def _blocks(pivots: np.ndarray, scale: float, top: int):
    """Rows (cell, far, near, near_ids, ids, vectors): vectors of a cell sorted by distance.

    ``near`` are its least distances, one for each of ``near_ids``.
    """
    dim = pivots.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, x = _vectors(batch, dim, scale)
            if not len(ids):
                continue
            cell, dist = _nearest(x, pivots)
            rows: list[tuple] = []
            order = np.lexsort((dist, cell))
            start = np.flatnonzero(np.concatenate(([True], np.diff(cell[order]) != 0)))
            for s, e in zip(start, np.append(start[1:], len(order))):
                first = order[s + np.sort(np.unique(ids[order[s:e]], return_index=True)[1])[:top]]
                for at in range(s, e, BLOCK):
                    part = order[at:min(e, at + BLOCK)]
                    rows.append((int(cell[part[0]]), float(dist[part].max()),
                                 dist[first].tolist() if at == s else [], ids[first].tolist() if at == s else [],
                                 ids[part].tobytes(), x[part].tobytes()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.float64()),
                 pa.array([r[2] for r in rows], pa.list_(pa.float64())),
                 pa.array([r[3] for r in rows], pa.list_(pa.int64())),
                 pa.array([r[4] for r in rows], pa.binary()), pa.array([r[5] for r in rows], pa.binary())],
                ["cell", "far", "near", "near_ids", "ids", "vectors"])
    return run


def _queries(pivots: np.ndarray, summary: list[np.ndarray], owners: np.ndarray, scale: float, k: int):
    """Rows (grp, ids, vectors, need): a block of queries of one group, and the distance each cell needs.

    ``owners`` are the vec_ids of the summarised distances, cell after cell.
    """
    dim = pivots.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, q = _vectors(batch, dim, scale)
            if not len(ids):
                continue
            norm = np.sqrt((q * q).sum(1))
            at = q @ pivots.T
            slack = 1e-6 * (1 + np.abs(at).max(1) + norm * (1 + max((s.max() for s in summary if len(s)), default=0)))
            low = np.concatenate([at[:, [j]] - norm[:, None] * s[None] for j, s in enumerate(summary)], axis=1)
            low[ids[:, None] == owners[None]] = -np.inf  # rows of the query's own vec_id are no candidates
            bound = (np.sort(low, axis=1)[:, -k] if low.shape[1] >= k else np.full(len(q), -np.inf)) - slack
            with np.errstate(divide="ignore", invalid="ignore"):
                need = np.where(norm[:, None] > 0, (bound[:, None] - at) / norm[:, None], -np.inf)
            group, _ = _nearest(q, pivots)
            rows = []
            for g in np.unique(group):
                mine = np.flatnonzero(group == g)
                for s in range(0, len(mine), QUERY_BLOCK):
                    part = mine[s:s + QUERY_BLOCK]
                    rows.append((int(g), ids[part].tobytes(), q[part].tobytes(), bound[part].tobytes(),
                                 need[part].min(0).tolist()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary()),
                 pa.array([r[2] for r in rows], pa.binary()), pa.array([r[3] for r in rows], pa.binary()),
                 pa.array([r[4] for r in rows], pa.list_(pa.float64()))],
                ["grp", "query_ids", "queries", "bounds", "need"])
    return run


def _search(dim: int, k: int):
    """A block of queries against a block of vectors -> the k best of each query, none below its bound."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                qid, q, bound, ids, x = (np.frombuffer(batch.column(c)[i].as_py(), t) for c, t in enumerate(
                    (np.int64, np.float64, np.float64, np.int64, np.float64)))
                q, x = q.reshape(-1, dim), x.reshape(-1, dim)
                if np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * dim < 2 ** 52:
                    score = (q @ x.T).astype(np.int64)  # sums of whole numbers: exact in doubles
                else:
                    score = q.astype(np.int64) @ x.astype(np.int64).T
                out_q, out_v, out_s = [], [], []
                for r in range(len(qid)):
                    ok = np.flatnonzero((ids != qid[r]) & (score[r] >= bound[r]))
                    best = ok[np.lexsort((ids[ok], -score[r][ok]))[:k]]
                    out_q.append(np.full(len(best), qid[r]))
                    out_v.append(ids[best])
                    out_s.append(score[r][best])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(a)) for a in (out_q, out_v, out_s)], ["query_id", "vec_id", "score"])
    return run


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, scale: float = 1024.0,
          pivots: int = 16) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows of ``vectors`` for each row of ``queries``.

    Both have vec_id and embedding.  Components become ``floor(scale * x)``;
    the score is their inner product; equal scores go to the smaller vec_id,
    and rows with the query's own vec_id are no candidates.  Vectors that are
    null, hold null or non-finite components, have a null vec_id or another
    length than most of the pivots' sample take no part.  Repeated rows with
    one vec_id are candidates each; a repeated query is answered once.  Empty
    tables give an empty result.
    """
    data = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    asked = queries.select(F.col("vec_id").cast("long").alias("vec_id"),
                           F.col("embedding").cast("array<double>").alias("v")).dropDuplicates(["vec_id", "v"])
    # the pivots: a bounded sample, in the order of a hash
    sample = data.where("vec_id is not null and v is not null and not exists(v, x -> x is null or isnan(x) "
                        "or abs(x) = double('infinity'))")
    picked = sample.orderBy(F.xxhash64("vec_id"), "vec_id").limit(4 * pivots).collect()
    dims = [len(r.v) for r in picked]
    dim = max(set(dims), key=lambda d: (dims.count(d), -d), default=1) or 1
    centres = np.unique(np.array([np.floor(np.array(r.v) * scale) for r in picked if len(r.v) == dim])
                        .reshape(-1, dim), axis=0)
    centres = centres[np.random.default_rng(0).permutation(len(centres))[:pivots]]
    if not len(centres):
        centres = np.zeros((1, dim))
    blocks = map_arrow(data, _blocks(centres, scale, k + 1),
                       "cell int, far double, near array<double>, near_ids array<bigint>, ids binary, vectors binary")
    blocks = cut(blocks)
    near = blocks.select("cell", F.explode(F.arrays_zip("near", "near_ids")).alias("x"))
    near = near.groupBy("cell", F.col("x.near_ids").alias("vec_id")).agg(F.min("x.near").alias("d"))
    least = near.withColumn("r", F.row_number().over(Window.partitionBy("cell").orderBy("d", "vec_id"))).where(
        f"r <= {k + 1}")
    summary: list[list[tuple[float, int]]] = [[] for _ in centres]
    for r in least.collect():  # at most pivots * (k + 1) rows
        summary[r.cell].append((r.d, r.vec_id))
    owners = np.array([i for s in summary for _, i in s], np.int64)
    asked = map_arrow(asked, _queries(centres, [np.array([d for d, _ in s]) for s in summary], owners, scale, k),
                      "grp int, query_ids binary, queries binary, bounds binary, need array<double>")
    asked = cut(asked.withColumn("qb", F.monotonically_increasing_id()))
    # a block of queries needs the cells whose farthest vector may still matter
    wanted = asked.select("qb", "query_ids", "queries", "bounds", F.posexplode("need").alias("cell", "least"))
    pairs = wanted.join(blocks.select("cell", "far", "ids", "vectors"), "cell").where("far >= least")
    # pairs are dealt evenly, so a hot group or cell is spread
    hits = map_arrow(pairs.select("query_ids", "queries", "bounds", "ids", "vectors"), _search(dim, k),
                     "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
