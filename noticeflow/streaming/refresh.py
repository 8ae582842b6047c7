"""Incremental refresh as a file stream (PIPE-6).

New captures land as Parquet files of pages; each micro-batch goes through the
same ``fresh_notices`` and ``merge_master`` as the batch job and into the
versioned master.  The stream checkpoint records which files are done, so a
restart (or a lost executor) replays at most the open batch, and the master's
manifest names the batches it holds, so a replay changes nothing.  Already
parsed notices can be streamed in the same way.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..functions import dates as D
from ..plans import pipeline as P
from ..schema import CANONICAL9_SCHEMA, CAPTURE_SCHEMA, LINEAGE
from ..sources.master_store import MasterStore

FRESH_SCHEMA = T.StructType(CANONICAL9_SCHEMA.fields
                            + [T.StructField(c, T.IntegerType()) for c in LINEAGE])


def merge_batch(store: MasterStore, stream: str, fresh: Callable[[DataFrame], DataFrame] = lambda batch: batch):
    """foreachBatch handler: merge the batch's notices into the months they touch."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        store.merge(fresh(batch), P.merge_master, stream=stream, batch=batch_id)
    return handle


def capture_batch(sources: DataFrame, as_of, days: int | None = D.WINDOW_DAYS) -> Callable[[DataFrame], DataFrame]:
    """Notices of a batch of captured pages; ``as_of`` is a date, or a function asked at each batch."""
    def fresh(batch: DataFrame) -> DataFrame:
        day = as_of() if callable(as_of) else as_of
        return P.fresh_notices(batch, sources, day, days)
    return fresh


def start(spark: SparkSession, inbox: str, store: MasterStore, checkpoint: str,
          files_per_batch: int | None = None, available_now: bool = True,
          schema: T.StructType = FRESH_SCHEMA, fresh: Callable[[DataFrame], DataFrame] = lambda batch: batch):
    """Start the refresh stream.

    By default every file present at a trigger forms one batch: a capture run
    lands as many files, and the keep-last rule must see the whole run at
    once (an earlier batch's rows are "existing" for the next one).
    """
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    stream = reader.parquet(inbox)
    writer = (stream.writeStream.foreachBatch(merge_batch(store, checkpoint, fresh))
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="1 minute")
    return writer.start()


def start_captures(spark: SparkSession, inbox: str, sources: DataFrame, store: MasterStore, checkpoint: str,
                   as_of: _dt.date | Callable[[], _dt.date], days: int | None = D.WINDOW_DAYS,
                   files_per_batch: int | None = None, available_now: bool = True):
    """Start the stream over captured pages: newest lists and latest attempts of a batch are parsed and merged.

    A retry that lands in a later batch is parsed again; rows already in the
    master stay, its other rows are added.
    """
    return start(spark, inbox, store, checkpoint, files_per_batch, available_now, CAPTURE_SCHEMA,
                 capture_batch(sources, as_of, days))


def finish(query) -> None:
    """Waits for an available-now stream and raises its error."""
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def run_available(spark: SparkSession, inbox: str, store: MasterStore, checkpoint: str,
                  files_per_batch: int | None = None) -> None:
    """Process every file present now, then stop."""
    finish(start(spark, inbox, store, checkpoint, files_per_batch, available_now=True))


def run_available_captures(spark: SparkSession, inbox: str, sources: DataFrame, store: MasterStore, checkpoint: str,
                           as_of, days: int | None = D.WINDOW_DAYS, files_per_batch: int | None = None) -> None:
    """Process every file of captured pages present now, then stop."""
    finish(start_captures(spark, inbox, sources, store, checkpoint, as_of, days, files_per_batch))
