"""Unions (U-*)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def append(*frames: DataFrame) -> DataFrame:
    """UNION ALL by name (U-1).  Order is carried by lineage columns, not row order."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def append_missing(*frames: DataFrame) -> DataFrame:
    """UNION ALL by name, missing columns become NULL (U-2)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
