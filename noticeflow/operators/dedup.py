"""Deduplication (DD-*).

``dropDuplicates`` keeps an arbitrary row, which is wrong for "keep last", so
keep-last is ``row_number() = 1`` over the key ordered by lineage descending.
Spark plans that as a partial ``WindowGroupLimit`` before the shuffle, so a
key with millions of copies is cut to one row per map task before it moves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import KEY6, KEY7, LINEAGE


def distinct_rows(df: DataFrame) -> DataFrame:
    """Exact distinct (DD-1): hash aggregate with map-side partial distinct."""
    return df.distinct()


def keep_last(df: DataFrame, key: list[str], order: list[str | Column]) -> DataFrame:
    """Keep the row that comes last in ``order`` for every key (NULL keys equal)."""
    cols = [F.col(c).desc_nulls_first() if isinstance(c, str) else c for c in order]
    w = Window.partitionBy(*key).orderBy(*cols)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def _keep_last_notice(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """Keep last by ``key``, in which a blank cell and a missing one are the same:
    pages give the one, a sheet export the other."""
    types = dict(df.dtypes)
    keys = {f"_k{i}": F.nullif(F.col(c), F.lit("")) if types[c] == "string" else F.col(c) for i, c in enumerate(key)}
    return keep_last(df.withColumns(keys), list(keys), order).drop(*keys)


def keep_last_key6(df: DataFrame, order: list[str] = LINEAGE) -> DataFrame:
    """Keep last across runs, sources and keywords by the six descriptive columns (DD-3)."""
    return _keep_last_notice(df, KEY6, order)


def keep_last_key7(df: DataFrame, order: list[str] = LINEAGE, by: tuple[str, ...] | list[str] = ()) -> DataFrame:
    """Keep last by the six columns plus URL (DD-2), within each ``by``."""
    return _keep_last_notice(df, [*by, *KEY7], order)


def keep_existing(df: DataFrame, order: list[str] = LINEAGE) -> DataFrame:
    """Master precedence (DD-4): existing (annotated) rows come after fresh ones."""
    return _keep_last_notice(df, KEY6, ["is_existing"] + list(order))


def ordered_keywords(text: Column) -> Column:
    """Comma list -> trimmed, non-blank, first-occurrence-ordered array (DD-5, F-7)."""
    parts = F.transform(F.split(text, ","), lambda s: F.trim(s))
    return F.array_distinct(F.filter(parts, lambda s: s != ""))
