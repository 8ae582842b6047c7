"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
import weakref

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space that separates words: \x20 and \x09-\x0D.
SPACE_CLASS = "[\\x20\\x09-\\x0D]+"


_shipped: weakref.WeakSet = weakref.WeakSet()


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors once per context, so that workers can import it."""
    sc = spark.sparkContext
    if sc not in _shipped:
        root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        folder = tempfile.mkdtemp(prefix="noticeflow-py-")
        package = os.path.join(folder, "src", "noticeflow")
        shutil.copytree(os.path.join(root, "noticeflow"), package, ignore=shutil.ignore_patterns("__pycache__"))
        sc.addPyFile(shutil.make_archive(os.path.join(folder, "noticeflow"), "zip", os.path.dirname(package)))
        _shipped.add(sc)


def map_arrow(df: DataFrame, run, schema: str) -> DataFrame:
    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``).

    A private folder is made only where the setting is unset *and* the master
    is local (tests); elsewhere a missing setting is an error.
    """
    sc = spark.sparkContext
    found = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not found:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="noticeflow-llm-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(found)
    return found


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: lineage ends in files of the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, compression: str = "zstd") -> DataFrame:
    """Like ``cut``, but as a Parquet table of the shared folder (columnar, smaller)."""
    spark = df.sparkSession
    path = os.path.join(shared_dir(spark), f"llm-{uuid.uuid4().hex}")
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def held_out(doc_id: str, mod: int) -> F.Column:
    """True where crc32(doc_id as text) mod ``mod`` is 2; a null id is never held out."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")),
                             F.lit(mod)) == 2, F.lit(False))


def bounded_broadcast(df: DataFrame, rows: int, limit: int) -> DataFrame:
    """Broadcast hint behind a size check; beyond the limit Spark shuffles."""
    return F.broadcast(df) if rows <= limit else df


def partitions(df: DataFrame) -> int:
    return df.rdd.getNumPartitions()


def pow2_at_least(n: int) -> int:
    return 1 << max(0, int(n) - 1).bit_length()


def packs(column: pa.Array, limit: int = 4 << 20):
    """Slices ``(from, to)`` of a string column, each of about ``limit`` bytes (one text at least)."""
    n = len(column)
    if n == 0:
        return
    sizes = np.zeros(n, np.int64)
    got = pc.binary_length(column).fill_null(0)
    sizes[:] = got.to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    start = 0
    while start < n:
        base = ends[start - 1] if start else 0
        stop = int(np.searchsorted(ends, base + limit, side="right"))
        stop = max(stop, start + 1)
        yield start, stop
        start = stop


def joined_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts end to end, offsets of length n + 1); a null text is empty."""
    col = column.fill_null("") if column.null_count else column
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.large_binary())
    bufs = col.buffers()
    offs = np.frombuffer(bufs[1], np.int64, len(col) + 1 + col.offset)[col.offset:]
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    return data[offs[0]:offs[-1]], offs - offs[0]


def runs(keys: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal neighbours."""
    if len(keys) == 0:
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)


def attach(rows: DataFrame, totals: DataFrame, key: str, weight: str, share: int = 1000) -> DataFrame:
    """``rows`` with the columns of ``totals`` (one row per key; nulls are one key), hot keys not shuffled.

    ``weight`` is the number of ``rows`` under a key.  Keys that hold more than
    one part in ``share`` of all rows are fewer than ``share`` by arithmetic:
    those are broadcast, and their rows are dealt out evenly past the join on
    the remaining keys, none of which can fill a task.
    """
    total = totals.agg(F.sum(weight)).first()[0] or 0
    names = [c for c in totals.columns if c not in (key, weight)]
    hot, cold = F.col(weight) * share > total, F.col(weight) * share <= total
    near = totals.where(hot).select(F.col(key).alias("_hot"), F.lit(True).alias("_hit"),
                                    *[F.col(c).alias(f"_hot_{c}") for c in names])
    far = totals.where(cold).select(F.col(key).alias("_cold"), F.lit(0).alias("_deal"),
                                    *[F.col(c).alias(f"_cold_{c}") for c in names])
    first = rows.join(F.broadcast(near), F.col(key).eqNullSafe(F.col("_hot")), "left")
    first = first.withColumns({
        "_asked": F.when(F.col("_hit").isNull(), F.col(key)),
        "_salt": F.when(F.col("_hit").isNull(), F.lit(0)).otherwise(
            (F.monotonically_increasing_id() % share).cast("int") + 1)})
    both = first.join(far, F.col("_asked").eqNullSafe(F.col("_cold")) & (F.col("_salt") == F.col("_deal")), "left")
    return both.select(*[F.col(c) for c in rows.columns],
                       *[F.coalesce(f"_hot_{c}", f"_cold_{c}").alias(c) for c in names])
