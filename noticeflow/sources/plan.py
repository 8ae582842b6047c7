"""Search-plan fan-out (SRC-2): one request row per (site, keyword).

The plan is a work-list table; nothing is fetched here.  Keywords are a tiny
job parameter, so the fan-out is ``inline`` of a small array (narrow, no
join), and the date bounds come from the fixed ``as_of``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import _as_date, as_of_texts
from ..functions.text import encode_spaces


def keyword_array(keywords: list[str] | Column) -> Column:
    """Ranked keywords of a list or of an array column (``dedup.ordered_keywords``)."""
    if not isinstance(keywords, Column):
        keywords = F.array(*[F.lit(k) for k in keywords]).cast("array<string>")
    return F.transform(keywords, lambda k, i: F.struct((i + 1).alias("keyword_rank"), k.alias("keyword")))


def search_plan(sources: DataFrame, keywords: list[str] | Column, as_of) -> DataFrame:
    """Requests for the ``sources`` dimension: keyword sources fan out (none without keywords), others once.

    Spaces of a keyword are encoded in the URL only.
    """
    t = as_of_texts(as_of)
    kw = F.when(F.col("keyword_search"), keyword_array(keywords)).otherwise(
        F.array(F.struct(F.lit(0).alias("keyword_rank"), F.lit(None).cast("string").alias("keyword"))))
    plan = sources.select("*", F.inline(kw))
    url = F.col("url_template")
    for token, value in [("{keyword}", F.coalesce(encode_spaces("keyword"), F.lit(""))),
                         ("{from}", t["from_iso"]), ("{to}", t["to_iso"]),
                         ("{year}", F.year(_as_date(as_of)).cast("string"))]:
        url = F.replace(url, F.lit(token), value)
    return plan.select("source_id", "source_rank", "site_rank", "layout", "keyword_rank",
                       "keyword", url.alias("request_url"))
