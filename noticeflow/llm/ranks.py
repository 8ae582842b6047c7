"""Ranks over sort keys, global or within groups, without a window that holds a partition or group."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, map_arrow, runs


def dense_rank(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """``df`` with ``name``: 0, 1, 2, ... in the order of ``keys``.

    One range shuffle and a reliable checkpoint, then a row count for each
    partition (the only thing that reaches the driver).  Rows that tie in all
    keys are told apart by a number, so a group of equal keys can be split
    over partitions.
    """
    marked = df.withColumn("_tie", F.monotonically_increasing_id())
    order = [*keys, "_tie"]
    n = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    placed = cut(marked.repartitionByRange(n, *order).sortWithinPartitions(*order)
                 .withColumn("_at", F.monotonically_increasing_id()).drop("_tie"))
    # monotonically_increasing_id: partition in the upper bits, place in the lower 33
    part = F.shiftright("_at", 33)
    counts = {r.p: r["count"] for r in placed.groupBy(part.alias("p")).count().collect()}
    base, total = [], 0
    for p in range(max(counts, default=-1) + 1):
        base.append(total)
        total += counts.get(p, 0)
    offsets = F.expr("array(" + ", ".join(f"{b}L" for b in base) + ")") if base else F.array().cast("array<bigint>")
    return placed.withColumn(name, F.element_at(offsets, part.cast("int") + 1)
                             + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))).drop("_at")


def rank_in_group(df: DataFrame, group: str, keys: list, keep: list, name: str) -> DataFrame:
    """``keep`` columns of ``df`` plus ``name``: 0, 1, 2, ... within each ``group`` (a long) in the order of ``keys``.

    One range shuffle on (group, keys), so a group of any size is spread over
    partitions, and a reliable checkpoint; then a streaming count inside each
    partition.  What the rows of a partition's first group already number in
    the partitions before it is worked out from one row per partition.
    """
    marked = df.withColumn("_tie", F.monotonically_increasing_id())
    order = [F.col(group), *keys, F.col("_tie")]
    n = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    placed = cut(marked.repartitionByRange(n, *order).sortWithinPartitions(*order)
                 .select(*keep, F.shiftright(F.monotonically_increasing_id(), 33).alias("_part")))
    ends = map_arrow(placed.select("_part", F.col(group).alias("_group")), _ends,
                     "part long, first long, last long, rows long, tail long").collect()
    before, held, count = {}, None, 0
    for r in sorted(ends):
        before[r.part] = count if held == r.first else 0
        count = r.tail + (before[r.part] if r.first == r.last else 0)
        held = r.last
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in placed.schema if f.name != "_part")
    return map_arrow(placed, _numbers(placed.columns.index(group), before, name), f"{kinds}, {name} long")


def _ends(batches):
    """One row per partition: its first and last group, its rows, and the rows of the last group."""
    part = first = last = None
    rows = tail = 0
    for batch in batches:
        group = batch.column(1).to_numpy(zero_copy_only=False)
        if len(group):
            if part is None:
                part, first = batch.column(0)[0].as_py(), int(group[0])
            same = len(group) - int(np.searchsorted(group, group[-1], side="left"))
            tail = tail + same if last == group[-1] and same == len(group) else same
            last, rows = int(group[-1]), rows + len(group)
    out = [] if part is None else [(part, first, last, rows, tail)]
    yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.int64()) for i in range(5)],
                                     ["part", "first", "last", "rows", "tail"])


def _numbers(at: int, before: dict[int, int], name: str):
    def run(batches):
        last, done = None, 0
        for batch in batches:
            group = batch.column(at).to_numpy(zero_copy_only=False)
            if not len(group):
                continue
            if last is None:
                last, done = group[0], before.get(batch.column(batch.num_columns - 1)[0].as_py(), 0)
            start = runs(group)
            number = np.arange(len(group)) - np.repeat(start, np.diff(np.append(start, len(group))))
            if group[0] == last:
                number[:int(np.searchsorted(group, group[0], side="right"))] += done
            last, done = group[-1], int(number[-1]) + 1
            columns = [c for i, c in enumerate(batch.columns) if i < batch.num_columns - 1]
            names = batch.schema.names[:-1]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(number)], [*names, name])
    return run
