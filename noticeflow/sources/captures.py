"""Captured-page scan (SRC-1): the input boundary of the engine."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import CAPTURE_SCHEMA


def read_captures(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Captured pages with the capture schema.

    Parquet datasets are expected to be partitioned by ``source_id`` (and
    capture date), so source and date filters prune files and the HTML column
    is only read for the pages a job needs.
    """
    return spark.read.format(fmt).schema(CAPTURE_SCHEMA).load(path)


def select_run(captures: DataFrame, first, last=None) -> DataFrame:
    """Captures of one run, or of the days ``first`` to ``last``; prunes partitions by capture date."""
    return captures.where(F.col("fetched_on").between(F.lit(first), F.lit(first if last is None else last)))


def read_html_folder(spark: SparkSession, path: str, layout: str, source_id: str,
                     source_rank: int = 1) -> DataFrame:
    """Ad-hoc folder of saved ``.html`` files, one page per file."""
    raw = spark.read.option("wholetext", True).text(path)
    fname = F.input_file_name()
    return raw.select(
        F.lit(source_id).alias("source_id"), F.lit(source_rank).alias("source_rank"),
        F.lit(1).alias("site_rank"), F.lit(layout).alias("layout"),
        F.lit(None).cast("string").alias("keyword"), F.lit(0).alias("keyword_rank"),
        F.lit(0).alias("list_pos"),
        F.regexp_extract(fname, r"(\d+)\D*$", 1).try_cast("int").alias("page_no"),
        F.lit(1).alias("attempt"), F.lit(None).cast("date").alias("fetched_on"),
        fname.alias("url"), F.col("value").alias("html"))
