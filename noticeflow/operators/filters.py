"""Row filters (F-*): time windows, take-while, blank keywords."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import WINDOW_DAYS, _as_date, window_start
from ..session import materialize

#: Groups of a take-while whose cut-offs are broadcast.
BROADCAST_GROUPS = 100_000


def recent(df: DataFrame, as_of, col: str = "received_date",
           days: int | None = WINDOW_DAYS) -> DataFrame:
    """Inclusive last-N-days filter (F-2); ``days=None`` keeps everything (all-time run)."""
    if days is None:
        return df
    return df.where(F.col(col) >= window_start(as_of, days))


def closed_range(df: DataFrame, as_of, col: str = "received_date",
                 days: int = WINDOW_DAYS) -> DataFrame:
    """[as_of - N, as_of] both ends included (F-3)."""
    return df.where(F.col(col).between(window_start(as_of, days), _as_date(as_of)))


def strictly_newer(df: DataFrame, as_of, col: str = "received_date",
                   days: int = WINDOW_DAYS) -> DataFrame:
    """Strictly after the cut-off (F-4)."""
    return df.where(F.col(col) > window_start(as_of, days))


def current_year(df: DataFrame, as_of, col: str = "received_date") -> DataFrame:
    """Same calendar year as the as-of date (F-6)."""
    return df.where(F.year(F.col(col)) == F.year(_as_date(as_of)))


def take_while(df: DataFrame, by: list[str], order: list[str], stop: Column) -> DataFrame:
    """Keep rows in listing order until the first row where ``stop`` holds (F-5).

    Rows after (and including) the first stopping row of their group are
    dropped.  Instead of a running window partitioned by ``by`` (one task per
    group, which breaks when one source holds a third of the rows), the first
    stopping position per group is found with a partial aggregation and kept
    by a checkpoint.  Its rows are counted: up to ``BROADCAST_GROUPS`` (some
    tens of bytes each) it is broadcast, and the listing is not shuffled at
    all, however hot a source is; beyond, both sides are joined by a shuffle
    with the same result.
    """
    pos = _position(df, order)
    cut = materialize(df.where(stop).groupBy(*by).agg(F.min(pos).alias("_first_stop")))
    side = F.broadcast(cut) if cut.limit(BROADCAST_GROUPS + 1).count() <= BROADCAST_GROUPS else cut
    side = side.select(*[F.col(c).alias(f"_by_{c}") for c in by], "_first_stop")
    same = [F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in by]
    joined = df.join(side, same, "left")
    return joined.where(F.col("_first_stop").isNull() | (pos < F.col("_first_stop"))).select(*df.columns)


def _position(df: DataFrame, order: list[str]) -> Column:
    """Listing position as one comparable value.

    One or two non-negative integer columns (page number, row) pack into a
    BIGINT, so the cut-off is a hash aggregate; anything else falls back to
    a struct (ordered field by field, planned as a sort aggregate).
    """
    types = dict(df.dtypes)
    if len(order) == 1 and types[order[0]] in ("int", "bigint", "smallint", "tinyint"):
        return F.coalesce(F.col(order[0]).cast("bigint"), F.lit(0))
    if len(order) == 2 and all(types[c] in ("int", "smallint", "tinyint") for c in order):
        # a listing without page numbers is one page
        hi, lo = (F.coalesce(F.col(c).cast("bigint"), F.lit(0)) for c in order)
        return F.shiftleft(hi, 32) + (lo + F.lit(1 << 31))
    return F.struct(*[F.col(c) for c in order])


def non_blank(df: DataFrame, col: str = "keyword") -> DataFrame:
    """Drop blank keywords (F-7)."""
    return df.where(F.trim(F.col(col)) != "")
