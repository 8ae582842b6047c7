"""Keywords: parameter parsing (DD-5, F-7) and description search (F-1)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .dedup import ordered_keywords


def keywords_df(spark: SparkSession, text: str) -> DataFrame:
    """``keyword_rank`` (1-based, first occurrence wins) and ``keyword``.

    Raises when nothing usable remains: an empty list would silently make
    every collector return nothing.
    """
    df = (spark.createDataFrame([(text,)], "raw string")
          .select(F.posexplode(ordered_keywords(F.col("raw"))).alias("pos", "keyword"))
          .select((F.col("pos") + 1).cast("int").alias("keyword_rank"), "keyword"))
    if not [k.strip() for k in text.split(",") if k.strip()]:
        raise ValueError("keyword list is empty")
    return df


def keyword_list(text: str) -> list[str]:
    """Driver-side form of the same rule for building literal arrays."""
    seen, out = set(), []
    for k in (p.strip() for p in text.split(",")):
        if k and k not in seen:
            seen.add(k)
            out.append(k)
    if not out:
        raise ValueError("keyword list is empty")
    return out


def keyword_hits(df: DataFrame, text_col: str, keywords: list[str],
                 out_col: str = "search_term", rank_col: str = "keyword_rank") -> DataFrame:
    """One row per (row, matching keyword), case-insensitive substring (F-1).

    The keyword list is a small job parameter, so it is inlined as a literal
    array and the match stays a narrow, codegen'd ``filter`` + ``explode``:
    no join, no shuffle, and the whole text is searched.
    """
    kws = F.array(*[F.struct(F.lit(i + 1).alias("r"), F.lit(k).alias("k"),
                             F.lit(k.lower()).alias("lk")) for i, k in enumerate(keywords)])
    low = df.withColumn("_lt", F.lower(F.col(text_col)))
    hits = F.filter(kws, lambda s: F.contains(F.col("_lt"), s["lk"]))
    return (low.select("*", F.explode(hits).alias("_kw"))
            .withColumn(out_col, F.col("_kw.k"))
            .withColumn(rank_col, F.col("_kw.r"))
            .drop("_kw", "_lt"))
