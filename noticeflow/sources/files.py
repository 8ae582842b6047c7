"""CSV source and sink (SRC-3, SNK-1) with pandas-compatible quoting.

Spark escapes quotes with a backslash by default while spreadsheet exports
double them; both ends here use ``escape='"'``.  Schemas are always explicit:
inference would turn an identifier like ``0012`` into the number 12.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import DISPLAY_NAMES


def read_csv(spark: SparkSession, path: str, schema: T.StructType,
             display_names: bool = True, position: bool = False) -> DataFrame:
    """Header CSV with an explicit schema; header names may be display names.

    ``position`` adds ``sheet_pos``, which orders rows by file name and row
    within the file, whatever order Spark packs the files in.  Quoted line
    breaks make a file one task; an export in several files is spread.
    """
    text_schema = T.StructType([
        T.StructField(DISPLAY_NAMES.get(f.name, f.name) if display_names else f.name,
                      T.StringType()) for f in schema.fields])
    raw = (spark.read.schema(text_schema)
           .option("header", True).option("multiLine", True)
           .option("escape", '"').option("quote", '"')
           .option("enforceSchema", False)
           .csv(path))
    pos = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("row"))
    return raw.select(*[F.col(tf.name).cast(f.dataType).alias(f.name)
                        if f.dataType != T.StringType() else F.col(tf.name).alias(f.name)
                        for tf, f in zip(text_schema.fields, schema.fields)],
                      *([pos.alias("sheet_pos")] if position else []))


def write_csv(df: DataFrame, path: str, display_names: bool = True,
              mode: str = "errorifexists", partition: str | None = None) -> None:
    """Header CSV, quotes doubled, no index column (SNK-1); a folder for each value of ``partition``."""
    out = df.select(*[F.col(c).alias(DISPLAY_NAMES.get(c, c)) if display_names else F.col(c)
                      for c in df.columns])
    # Empty strings are written quoted ("") and NULLs as nothing, so both
    # survive a round trip.
    (out.write.mode(mode).partitionBy(*([partition] if partition else []))
     .option("header", True).option("escape", '"').option("quote", '"').csv(path))
