"""Sorts, dense positions and top-k lists (O-*, L-1)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def newest_first(df: DataFrame, date_col: str, tie_breakers: list[str] = ()) -> DataFrame:
    """Date descending then authority ascending, NULLs last both ways (O-1, O-2).

    pandas puts NaN last in both directions; Spark's ascending default puts
    NULLs first, hence the explicit null ordering.  Extra key columns make
    the order total, so positions are reproducible.
    """
    return df.orderBy(*sort_columns(date_col, tie_breakers))


def sort_columns(date_col: str, tie_breakers: list[str] = ()) -> list[Column]:
    return ([F.col(date_col).desc_nulls_last(), F.col("local_authority_name").asc_nulls_last()]
            + [F.col(c).asc_nulls_last() for c in tie_breakers])


def with_positions(df: DataFrame, order: list[Column], name: str = "position",
                   partitions: int | None = None) -> DataFrame:
    """Dense 0-based position in a total order without a single-partition window (O-3).

    1. range-partition on the order and sort inside partitions (the same
       shuffle a global sort needs), then checkpoint so partition ids and
       in-partition order are fixed;
    2. count rows per partition -- one small row per partition, so the
       offsets table is bounded by the partition count and safe to broadcast;
    3. position = offset of the partition + index inside the partition, read
       from ``monotonically_increasing_id`` (partition id in the upper bits,
       row index in the lower 33 bits) -- a narrow projection.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *order).sortWithinPartitions(*order).checkpoint(eager=True)
    mid = F.monotonically_increasing_id()
    tagged = ranged.select("*", F.shiftright(mid, 33).alias("_pid"),
                           (mid.bitwiseAND(F.lit((1 << 33) - 1))).alias("_idx"))
    # One (partition, count) pair per partition: bounded by ``n``, like the
    # count pass of RDD.zipWithIndex.
    counts = sorted(tuple(r) for r in tagged.groupBy("_pid").count().collect())
    running, rows = 0, []
    for pid, cnt in counts:
        rows.append((int(pid), running))
        running += int(cnt)
    offsets = spark.createDataFrame(rows or [(0, 0)], "_pid long, _off long")
    return (tagged.join(F.broadcast(offsets), "_pid")
            .withColumn(name, (F.col("_off") + F.col("_idx")).cast("bigint"))
            .drop("_pid", "_idx", "_off"))


def latest_k(df: DataFrame, by: list[str], order_col: str, k: int) -> DataFrame:
    """Rows of the ``k`` latest distinct ``order_col`` values per group (L-1).

    The ranking runs on the distinct (group, value) pairs only -- a partial
    aggregate shrinks the data before any shuffle -- and the qualifying pairs
    are joined back (AQE broadcasts them when small).  No window over the
    full table partitioned by a few hot groups.
    """
    pairs = df.select(*by, order_col).distinct()
    w = Window.partitionBy(*by).orderBy(F.col(order_col).desc())
    top = pairs.withColumn("_r", F.dense_rank().over(w)).where(F.col("_r") <= k).drop("_r")
    return df.join(top, on=by + [order_col], how="left_semi")
