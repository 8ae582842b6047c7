"""Versioned master table, incremental by received month (SRC-4, SRC-5, SNK-2, SNK-3).

Layout under ``root``::

    data/v=<n>/received_month=<yyyy-MM | __none__>/part-*.parquet
    fresh/v=<n>/part-*.parquet                        the batch merged into v, kept once
    manifest/v=<n>.json     the version that holds each month; stream batches done

A version becomes visible when its manifest is renamed into place.  A merge
rewrites only the months its batch touches -- exact, because the received date
is part of the deduplication key, so duplicates always share a month -- and the
manifest points every untouched month at the version that already holds it.
The input of a publish or merge is evaluated once: which months it touches is
observed while it is written.  Nothing is overwritten in
place, so every earlier version stays readable (it is the backup taken before
each merge) until ``vacuum`` removes what no kept manifest names.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import fill_human_columns
from ..schema import MASTER_SCHEMA

MONTH = "received_month"
NO_MONTH = "__none__"


STORED_SCHEMA = T.StructType(MASTER_SCHEMA.fields + [
    T.StructField("v", T.IntegerType()), T.StructField(MONTH, T.StringType())])


def month_of(col: str = "received_date") -> Column:
    return F.coalesce(F.date_format(F.col(col), "yyyy-MM"), F.lit(NO_MONTH))


class MasterStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # ------------------------------------------------------------ listing
    def _fs(self):
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.root)
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), jvm

    def _names(self, sub: str) -> list[str]:
        """Names in a folder under the root."""
        fs, jvm = self._fs()
        folder = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{sub}")
        return [st.getPath().getName() for st in fs.listStatus(folder)] if fs.exists(folder) else []

    def _months(self, sub: str) -> set[str]:
        """Months of a written folder: one folder each, bounded by the calendar."""
        return {n.split("=", 1)[1] for n in self._names(sub) if n.startswith(f"{MONTH}=")}

    def versions(self) -> list[int]:
        return sorted(int(n[2:-5]) for n in self._names("manifest") if n.startswith("v=") and n.endswith(".json"))

    def _next_version(self) -> int:
        """One past every version folder, visible or not: a publish that died
        half-way (data without manifest) is skipped, never reused."""
        names = [n for sub in ("data", "fresh", "manifest") for n in self._names(sub) if n.startswith("v=")]
        return max((int(n[2:].removesuffix(".json")) for n in names), default=0) + 1

    def _data(self, version: int) -> str:
        return f"{self.root}/data/v={version:06d}"

    def _manifest_path(self, version: int) -> str:
        return f"{self.root}/manifest/v={version:06d}.json"

    def _about(self, version: int | None = None) -> dict:
        vs = self.versions()
        if not vs:
            return {"months": {}, "streams": {}}
        fs, jvm = self._fs()
        f = fs.open(jvm.org.apache.hadoop.fs.Path(self._manifest_path(vs[-1] if version is None else version)))
        try:
            return json.loads(jvm.org.apache.commons.io.IOUtils.toString(f, "UTF-8"))
        finally:
            f.close()

    def manifest(self, version: int | None = None) -> dict[str, int]:
        """month -> version holding it (one entry per month)."""
        return self._about(version)["months"]

    # ------------------------------------------------------------ read
    def read(self, version: int | None = None, months: set[str] | None = None) -> DataFrame:
        """The master (latest or a given version), optionally only some months.

        An empty table with the full schema when nothing is published (SNK-2).
        """
        mf = self.manifest(version)
        if months is not None:
            mf = {m: v for m, v in mf.items() if m in months}
        if not mf:
            return self.spark.createDataFrame([], MASTER_SCHEMA)
        # Read the few version folders and let partition pruning pick each
        # month from the version that holds it.
        by_version: dict[int, list[str]] = {}
        for m, v in mf.items():
            by_version.setdefault(v, []).append(m)
        cond = None
        for v, ms in sorted(by_version.items()):
            c = (F.col("v").cast("int") == v) & F.col(MONTH).cast("string").isin(sorted(ms))
            cond = c if cond is None else (cond | c)
        df = (self.spark.read.schema(STORED_SCHEMA).option("basePath", f"{self.root}/data")
              .parquet(*[self._data(v) for v in sorted(by_version)]))
        return df.where(cond).select(*[F.col(f.name).cast(f.dataType) for f in MASTER_SCHEMA.fields])

    # ------------------------------------------------------------ write
    def _write(self, df: DataFrame, version: int) -> set[str]:
        """Writes a version's rows and returns their months."""
        # Stored rows are always in filled form (S-14 is idempotent), so months
        # a merge does not touch look exactly like months it rewrites.
        # Rebalanced by month: a task writes few months, small months share a
        # task, and Spark splits a month that holds a third of all rows.  No
        # range partitioning, whose sample would evaluate the merge twice.
        out = fill_human_columns(df).select(*MASTER_SCHEMA.names, month_of().alias(MONTH))
        out.hint("rebalance", F.col(MONTH)).write.mode("errorifexists").partitionBy(MONTH).parquet(self._data(version))
        return self._months(f"data/v={version:06d}")

    def _show(self, version: int, months: dict[str, int], streams: dict[str, int]) -> int:
        """Makes a version visible: its manifest is written aside and renamed."""
        fs, jvm = self._fs()
        path = jvm.org.apache.hadoop.fs.Path
        aside = path(f"{self.root}/manifest/.v={version:06d}.json.part")
        out = fs.create(aside, True)
        out.write(json.dumps({"months": dict(sorted(months.items())), "streams": streams}).encode())
        out.close()
        if not fs.rename(aside, path(self._manifest_path(version))):
            raise RuntimeError(f"version {version} was published by another writer")
        return version

    def publish(self, df: DataFrame) -> int:
        """Write a complete new version (SNK-3); returns its number."""
        v = self._next_version()
        months = self._write(df, v)
        return self._show(v, {m: v for m in months}, self._about()["streams"])

    def merge(self, fresh: DataFrame, merge_fn: Callable[[DataFrame, DataFrame], DataFrame],
              stream: str | None = None, batch: int | None = None) -> int:
        """Merge ``fresh`` into the latest version, rewriting only touched months.

        ``fresh`` is written once, and the months that it touches (bounded by the
        calendar) are observed by that write.  A stream names itself and its batch: a batch that an
        earlier version holds already (a replay after a failure) changes nothing.
        """
        vs, about = self.versions(), self._about()
        if stream is not None and batch <= about["streams"].get(stream, -1):
            return vs[-1]
        v = self._next_version()
        kept = f"{self.root}/fresh/v={v:06d}"
        seen = Observation()
        fresh.observe(seen, F.collect_set(month_of()).alias("months")).write.parquet(kept)
        touched = set(seen.get["months"])
        streams = about["streams"] | ({stream: batch} if stream is not None else {})
        if not touched:
            if stream is not None and vs:  # an empty batch is done, too
                return self._show(v, about["months"], streams)
            return vs[-1] if vs else 0
        merged = merge_fn(self.spark.read.schema(fresh.schema).parquet(kept), self.read(months=touched))
        written = self._write(merged, v)
        return self._show(v, about["months"] | {m: v for m in written}, streams)

    def vacuum(self, keep: int = 7) -> list[str]:
        """Removes versions older than the ``keep`` newest: manifests, and month folders no kept manifest names.

        Folders of versions above the newest (a write under way) stay.
        """
        vs = self.versions()
        if keep < 1 or not vs:
            return []
        old, kept = vs[:-keep], vs[-keep:]
        named = {(v, m) for k in kept for m, v in self.manifest(k).items()}
        gone = [f"manifest/v={v:06d}.json" for v in old]
        for name in self._names("data"):
            v = int(name[2:])
            if v > vs[-1]:
                continue
            months = self._months(f"data/{name}")
            used = [m for m in months if (v, m) in named]
            gone += [f"data/{name}"] if not used else [f"data/{name}/{MONTH}={m}" for m in sorted(months - set(used))]
        gone += [f"fresh/{name}" for name in self._names("fresh") if int(name[2:]) <= vs[-1]]
        fs, jvm = self._fs()
        for path in gone:
            fs.delete(jvm.org.apache.hadoop.fs.Path(f"{self.root}/{path}"), True)
        return gone
