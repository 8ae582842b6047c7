"""Capture audits (EXT-9..EXT-13): counters, completeness, status, retries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import digits_to_int

# Markers that a listing page carries when a search found nothing.
NO_RESULT_MARKERS = ["noResultsPlGridDiv", 'id="no_results"', "No weekly lists found",
                     "No results found"]


def page_counter(label: Column, k: int) -> Column:
    """Current (k=1) or last (k=2) page from 'N of M' / 'N / M' labels (EXT-9)."""
    part = F.regexp_extract(label, r"(\d[\d,]*)\s*(?:of|/)\s*(\d[\d,]*)", k)
    return digits_to_int(part)


def completeness(pages: DataFrame, by: list[str], page_col: str = "page_no",
                 last_col: str = "last_page") -> DataFrame:
    """Did we capture every page the counter promised (EXT-10)?"""
    return (pages.groupBy(*by)
            .agg(F.max(last_col).cast("bigint").alias("promised_pages"),
                 F.countDistinct(page_col).cast("bigint").alias("captured_pages"))
            .withColumn("missing_pages",
                        F.greatest(F.col("promised_pages") - F.col("captured_pages"),
                                   F.lit(0)).cast("bigint")))


# Elements that have no end tag.
VOID_TAGS = ["area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"]
_HIDES = r"<[a-zA-Z][^<>]*(?:(?i:display\s*:\s*none)|\s(?i:hidden)(?=[\s>=/]))"


def shows_no_results(html: Column, markers: list[str] = NO_RESULT_MARKERS) -> Column:
    """The page says that nothing was found; a marker counts only where it and all around it are displayed (EXT-11).

    Pages with a marker and with hidden parts are folded over their tags: from
    a hidden element's start tag to its own end tag (elements of the same name
    inside it are counted) nothing is seen.
    """
    def marked(text: Column) -> Column:
        found = F.lit(False)
        for m in markers:
            found = found | F.contains(text, F.lit(m))
        return found

    def about(piece: Column) -> Column:
        after = F.regexp_extract(piece, "(?s)>(.*)", 1)
        return F.struct(F.lower(F.regexp_extract(piece, "^(/?[a-zA-Z][a-zA-Z0-9]*)", 1)).alias("tag"),
                        F.concat(F.lit("<"), piece).rlike("^" + _HIDES).alias("hides"),
                        marked(piece).alias("whole"), marked(after).alias("after"))

    def step(s: Column, i: Column) -> Column:
        inside = s["depth"] > 0
        depth = (F.when(inside, s["depth"] + (i["tag"] == s["within"]).cast("int")
                        - (i["tag"] == F.concat(F.lit("/"), s["within"])).cast("int"))
                 .otherwise((i["hides"] & ~i["tag"].isin(VOID_TAGS)).cast("int")))
        seen = F.when(depth > 0, False).when(inside | i["hides"], i["after"]).otherwise(i["whole"])
        return F.struct(F.when(inside, s["within"]).otherwise(i["tag"]).alias("within"), depth.alias("depth"),
                        (s["found"] | seen).alias("found")).cast(state)

    state = "struct<within string, depth int, found boolean>"
    start = F.struct(F.lit("").alias("within"), F.lit(0).alias("depth"),
                     marked(F.substring_index(html, "<", 1)).alias("found")).cast(state)
    tags = F.transform(F.split(html, "<"), about)
    folded = F.aggregate(F.slice(tags, 2, F.greatest(F.size(tags), F.lit(1))), start, step, lambda s: s["found"])
    return F.when(~marked(html), False).when(~html.rlike(_HIDES), True).otherwise(folded)


def page_status() -> Column:
    """Status of parsed pages (``extract.page_records``): error / ok / no_results / empty (EXT-11)."""
    return (F.when(~F.col("page_ok"), F.lit("error"))
            .when(F.size("records") > 0, F.lit("ok"))
            .when(F.col("no_results"), F.lit("no_results")).otherwise(F.lit("empty")))


MOST_PAGES = 1_000_000  # a counter that promises more is reported unread, with no page number


def missing_pages(pages: DataFrame, by: list[str]) -> DataFrame:
    """Pages that a listing's counters promised and that no capture holds (EXT-9, EXT-10).

    ``pages`` are parsed (``page_label`` as the page shows it, ``page_no`` as
    captured).  The largest last page that a listing shows makes the sequence
    1, 2, ... of its pages; what was captured is anti-joined, so repeated
    captures count once.  Listings without a counter promise nothing.
    """
    promised = (pages.groupBy(*by).agg(F.max(page_counter(F.col("page_label"), 2)).alias("promised_pages"))
                .where("promised_pages > 0"))
    numbers = F.when(F.col("promised_pages") <= MOST_PAGES, F.sequence(F.lit(1).cast("bigint"), F.col("promised_pages")))
    wanted = promised.select(*by, "promised_pages", F.explode(F.coalesce(
        numbers, F.array(F.lit(None).cast("bigint")))).alias("page_no"))
    have = pages.select(*[F.col(c).alias(f"_{c}") for c in by], F.col("page_no").cast("bigint").alias("_no")).distinct()
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by]
    return wanted.join(have, [*same, F.col("page_no") == F.col("_no")], "left_anti")


def error_report(df: DataFrame, by: list[str], status_col: str = "status") -> DataFrame:
    """Per-source status counts (EXT-12): every source reported, none stops the run."""
    return df.groupBy(*by, status_col).agg(F.count(F.lit(1)).alias("n"))


def latest_attempt(df: DataFrame, key: list[str], attempt_col: str,
                   tie_breakers: list[str] = ()) -> DataFrame:
    """Keep the newest attempt per key (EXT-13), a retry's data replaces the first try."""
    order = [F.col(attempt_col).desc()] + [F.col(c).desc() for c in tie_breakers]
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
