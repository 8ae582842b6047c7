"""Composite pipelines (PIPE-1..PIPE-5).

captures -> newest lists, latest attempts -> parse (native regexes, Python only
for flagged pages) -> records -> normalise -> window -> combine -> merge with
the master -> announce -> publish.  Every function returns a DataFrame; those
that read their input more than once (``apply_window`` over consultations,
``run_refresh`` with a report) first cut it with a reliable checkpoint, which
runs a job; ``filters.take_while`` and ``newest_lists`` count their per-source
tables.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import text as X
from ..functions.announce import DEFAULT_HELP_URL, DEFAULT_TAG, draft_announcement
from ..functions.cache import per_jvm
from ..operators import dedup, extract, filters, ordering, sets
from ..schema import (BOARD_CASE_BASE, CANONICAL9, CONSULTATION_BASE, DEADLINE_DAYS, KEY6,
                      LAYOUT_DATE_FORMATS, LINEAGE, MASTER13, NO_RUN)
from ..session import materialize
from ..sources import files

PARSE_INPUT = ["fetched_on", "source_id", "source_rank", "site_rank", "layout", "keyword", "keyword_rank",
               "list_pos", "page_no", "attempt", "url", "html"]
#: Columns of a single source's file.
SOURCE_FILE = [c for c in CANONICAL9 if c != "deadline"]
#: Layouts that a source publishes as numbered lists, the newest first (L-1).
LIST_LAYOUTS = ["cards6", "case1"]
LATEST_LISTS = 4


def capture_pages(captures: DataFrame, latest_only: bool = True) -> DataFrame:
    """One row per captured page with its records; the HTML is dropped after parsing.

    Only the newest lists' pages and the latest attempts are parsed.
    """
    captures = newest_lists(captures)
    if latest_only:
        captures = drop_superseded(captures)
    if "fetched_on" not in captures.columns:
        captures = captures.withColumn("fetched_on", F.lit(None).cast("date"))
    return extract.page_records(extract.parse_pages(captures.select(*PARSE_INPUT)))


def extract_records(captures: DataFrame, latest_only: bool = True) -> tuple[DataFrame, DataFrame]:
    """(records, quarantined pages) from captures; the HTML is dropped after parsing.

    ``latest_only`` keeps the newest attempt of every page (EXT-13: a retry's
    data replaces the first try), see ``drop_superseded``.
    """
    pages = capture_pages(captures, latest_only)
    return extract.explode_records(pages), extract.quarantine_pages(pages)


def _equal(*columns: Column) -> list[Column]:
    """Texts that are equal where the columns are, missing values included."""
    return [F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("")) for c in columns]


def newest_lists(captures: DataFrame, k: int = LATEST_LISTS) -> DataFrame:
    """Captures without the pages of lists older than a source's ``k`` newest, before anything is parsed (L-1).

    A source of a list layout numbers its lists from the newest on.  The first
    list that is too old, one row per run and source that has any, is worked
    out from the capture metadata and kept by a checkpoint.  No rows: nothing
    is joined; up to ``BROADCAST_GROUPS``, they are broadcast.  Either way no
    page moves, however many of them one source holds; beyond, both sides are
    joined by a shuffle with the same result.  Fewer lists, pages without a
    list number and other layouts all stay.
    """
    run = F.col("fetched_on") if "fetched_on" in captures.columns else F.lit(None)
    key = dict(zip(("_run", "_source"), _equal(run, F.col("source_id"))))
    lists = (captures.where(F.col("layout").isin(LIST_LAYOUTS) & F.col("list_pos").isNotNull())
             .select(*[c.alias(n) for n, c in key.items()], F.col("list_pos").alias("_list")).distinct())
    w = Window.partitionBy("_run", "_source").orderBy("_list")
    old = materialize(lists.withColumn("_r", F.dense_rank().over(w)).where(F.col("_r") == k + 1)
                      .select("_run", "_source", F.col("_list").alias("_from")))
    groups = old.limit(filters.BROADCAST_GROUPS + 1).count()
    if groups == 0:
        return captures
    side = F.broadcast(old) if groups <= filters.BROADCAST_GROUPS else old
    marked = captures.withColumns(key | {"_list": F.when(F.col("layout").isin(LIST_LAYOUTS), F.col("list_pos"))})
    same = [marked[n] == side[n] for n in key] + [marked["_list"] >= side["_from"]]
    return marked.join(side, same, "left_anti").select(*captures.columns)


def drop_superseded(captures: DataFrame) -> DataFrame:
    """Captures of each page's latest attempt (EXT-13), before anything is parsed.

    A page is its run (capture date), source, keyword, list and page number;
    without a page number its URL stands in.  Missing values are equal to each
    other.  Of captures with the same latest attempt all stay (their records
    meet in the deduplication); a missing attempt is older than any other.

    One lazy plan: the pages that were tried more than once come from an
    aggregate over the capture metadata, and their older captures are
    anti-joined.  Most runs have few or none, which AQE sees at run time (a
    broadcast, or no join at all).
    """
    run = F.col("fetched_on") if "fetched_on" in captures.columns else F.lit(None)
    page = F.coalesce(F.concat(F.lit("p"), F.col("page_no").cast("string")), F.concat(F.lit("u"), F.col("url")))
    names = ["_run", "_source", "_kw", "_list", "_page"]
    key = dict(zip(names, _equal(run, F.col("source_id"), F.col("keyword"), F.col("list_pos"), page)))
    attempt = F.coalesce(F.col("attempt"), F.lit(-(1 << 31)))
    tried = captures.select(*[c.alias(n) for n, c in key.items()], attempt.alias("_attempt"))
    retried = (tried.groupBy(*names).agg(F.max("_attempt").alias("_latest"), F.min("_attempt").alias("_first"))
               .where("_latest <> _first").drop("_first"))
    marked = captures.withColumns(key | {"_attempt": attempt})
    older = [marked[n] == retried[n] for n in names] + [marked["_attempt"] < retried["_latest"]]
    return marked.join(retried, older, "left_anti").select(*captures.columns)


def source_rules(sources: DataFrame) -> DataFrame:
    """The dimension by its key; a source that is listed twice ends the run with an error."""
    formats = F.col("date_formats") if "date_formats" in sources.columns else F.lit(None).cast("array<string>")
    rules = F.struct(F.col("authority").alias("_authority"), F.col("class").alias("source_class"),
                     F.col("deadline_days").cast("int").alias("deadline_days"), formats.alias("_formats"))
    one = sources.groupBy("source_id").agg(F.any_value(rules).alias("r"), F.count(F.lit(1)).alias("n"))
    twice = F.raise_error(F.concat(F.lit("source listed twice: "), F.coalesce("source_id", F.lit("NULL"))))
    return one.withColumn("r", F.when(F.col("n") == 1, F.col("r")).otherwise(twice.cast(one.schema["r"].dataType))) \
        .select("source_id", "r.*")


def normalise(records: DataFrame, sources: DataFrame) -> DataFrame:
    """Raw records -> canonical columns + lineage + class (PIPE-1).

    One equi-join on the dimension's checked key, whatever its size; a source
    that is not listed has NULL rules.
    """
    if "fetched_on" not in records.columns:
        records = records.withColumn("fetched_on", F.lit(None).cast("date"))
    run = F.coalesce(F.unix_date("fetched_on"), F.lit(NO_RUN))
    return (records.withColumn("run_day", run).join(source_rules(sources), "source_id", "left")
            .select(*_normalise_exprs()))


@per_jvm
def _normalise_exprs() -> list:
    lay = F.col("detected_layout")
    known = list(dict.fromkeys(f for formats in LAYOUT_DATE_FORMATS.values() for f in formats))
    # a source's own formats first, else those of its layout
    received = F.when(F.col("_formats").isNotNull(), D.parse_by_formats("raw_received", "_formats", known))
    for name, formats in LAYOUT_DATE_FORMATS.items():
        received = received.when(lay == name, D.parse_declared("raw_received", formats))
    authority = (F.when(lay.isin("table", "grid5"), F.col("raw_authority"))
                 .when(lay == "responsive7", X.authority_from_url("url"))
                 .otherwise(F.col("_authority")))
    description = F.when(lay.isin("grid5", "columns4", "deflist4"),
                         F.lit(X.NO_DESCRIPTION)).otherwise(F.col("raw_description"))
    file_number = F.col("raw_file_number")
    url = (F.when(lay == "table", X.detail_url("url", file_number))
           .when(lay.isin("responsive7", "deflist4"), X.encode_spaces("url"))
           .when(lay.isin("cards6", "case1"), X.absolute_url(BOARD_CASE_BASE, file_number))
           .when(lay == "links5", X.absolute_url(CONSULTATION_BASE, F.col("raw_link")))
           .otherwise(F.col("url")))
    term = (F.when(lay.isin("cards6", "case1"), F.lit(X.NA_SID))
            .when(lay == "links5", F.lit(X.NA_DECC))
            .otherwise(F.col("keyword")))
    return [
        file_number.alias("file_number"), received.alias("received_date"),
        authority.alias("local_authority_name"), F.col("raw_applicant").alias("applicant_name"),
        F.col("raw_address").alias("development_address"),
        description.alias("development_description"), url.alias("url"),
        term.alias("search_term"),
        "source_id", "source_class", "deadline_days", "detected_layout",
        F.col("raw_received"),
        *[F.col(c).cast("int").alias(c) for c in LINEAGE]]


def bad_dates(normalised: DataFrame) -> DataFrame:
    """Rows without a received date, or whose text did not parse with the declared formats."""
    return normalised.where(F.col("received_date").isNull())


def refresh_report(captures: DataFrame, sources: DataFrame) -> DataFrame:
    """What a refresh leaves out: pages in quarantine, rows without a date, sources that are not listed.

    One row per finding: kind (page / date / source), source_id, url, file_number, detail.
    The pages are parsed once and kept without their HTML by a checkpoint.
    """
    return report_pages(materialize(capture_pages(captures)), captures, sources)


def report_pages(pages: DataFrame, captures: DataFrame, sources: DataFrame) -> DataFrame:
    """``refresh_report`` from parsed pages; of the captures only the sources' names are read."""
    none = F.lit(None).cast("string")
    broken = extract.quarantine_pages(pages).select(
        F.lit("page").alias("kind"), "source_id", "url", none.alias("file_number"), F.col("error").alias("detail"))
    undated = bad_dates(normalise(extract.explode_records(pages), sources)).select(
        F.lit("date").alias("kind"), "source_id", "url", "file_number",
        F.coalesce("raw_received", F.lit("no date")).alias("detail"))
    unknown = (captures.select("source_id").distinct().join(sources.select("source_id"), "source_id", "left_anti")
               .select(F.lit("source").alias("kind"), "source_id", none.alias("url"), none.alias("file_number"),
                       F.lit("unknown source").alias("detail")))
    return broken.unionByName(undated).unionByName(unknown)


def apply_window(normalised: DataFrame, as_of, days: int | None = D.WINDOW_DAYS) -> DataFrame:
    """Recent notices only: inclusive window for listings (F-2); consultations are
    read newest-first and stop at the first old one (F-5), run by run.  Board
    cases have no window: their lists are those of the current year already (F-6)."""
    good = normalised.where(F.col("received_date").isNotNull())
    if days is None:
        return good
    cut = D.window_start(as_of, days)
    lay = F.col("detected_layout")
    plain = good.where(lay.isin("cards6", "case1") | (~lay.isin("links5", "cards6", "case1")
                                                      & (F.col("received_date") >= cut)))
    by = [c for c in ("source_id", "run_day") if c in normalised.columns]
    consult = filters.take_while(good.where(lay == "links5"), by=by, order=["page_no", "row_pos"],
                                 stop=F.col("received_date") <= cut)
    return sets.append(plain, consult)


def combine(normalised: DataFrame) -> DataFrame:
    """Canonical rows + deadline by source class (PIPE-2, D-6)."""
    days = F.coalesce(F.col("deadline_days"), F.lit(DEADLINE_DAYS["council"]))
    return normalised.withColumn("deadline", D.deadline("received_date", days)) \
        .select(*CANONICAL9, *LINEAGE)


def fresh_notices(captures: DataFrame, sources: DataFrame, as_of,
                  days: int | None = D.WINDOW_DAYS) -> DataFrame:
    """captures -> canonical9 + lineage: PIPE-1 + window + PIPE-2."""
    return fresh_from_pages(capture_pages(captures), sources, as_of, days)


def fresh_from_pages(pages: DataFrame, sources: DataFrame, as_of, days: int | None = D.WINDOW_DAYS,
                     parsed_once: bool = False) -> DataFrame:
    """``fresh_notices`` from parsed pages; ``parsed_once``: the pages are kept already, not a plan that parses."""
    normalised = normalise(extract.explode_records(pages), sources)
    if days is not None and not parsed_once:
        # The window reads consultations again for their cut-off: what it can
        # drop at once goes first, then one checkpoint keeps the rest, so the
        # pages are parsed once.
        lay = F.col("detected_layout")
        recent = F.col("received_date") >= D.window_start(as_of, days)
        normalised = materialize(normalised.where(lay.isin("links5", "cards6", "case1") | recent))
    return combine(apply_window(normalised, as_of, days))


def source_files(captures: DataFrame, sources: DataFrame, as_of, path: str, only: list[str] | None = None,
                 days: int | None = None) -> None:
    """Each source's own notices as CSV under ``path/source_id=<id>/``, newest first, in one job for all.

    ``only`` names the sources to run; their captures alone are read.  Within a
    source the last of equal rows (six columns and URL, DD-2) stays; two
    sources' equal rows both do.  Rows are ranged by source and date, so a
    source that holds most of them is spread over several files, which follow
    each other by name.
    """
    if only is not None:
        captures, sources = (x.where(F.col("source_id").isin(only)) for x in (captures, sources))
    rank = ["source_rank", "site_rank"]
    fresh = fresh_notices(captures, sources, as_of, days).join(sources.select(*rank, "source_id"), rank)
    last = dedup.keep_last_key7(fresh, by=["source_id"])
    order = [F.col("source_id"), F.col("received_date").desc_nulls_last(), F.col("local_authority_name").asc_nulls_last(),
             F.col("file_number").asc_nulls_last()]
    out = last.select("source_id", *SOURCE_FILE).repartitionByRange(*order).sortWithinPartitions(*order)
    files.write_csv(out, path, partition="source_id")


def master_from_text(master_text: DataFrame, keep_order: bool = False) -> DataFrame:
    """Master exported as text: parse both date columns in any dialect (D-4).

    A sheet read with its positions (``files.read_csv(position=True)``) keeps
    them as ``master_pos``, so that duplicate keys inside the sheet itself
    resolve to the later row, as keep-last does.  ``keep_order`` numbers the
    rows of any other input in the order Spark reads them.
    """
    out = master_text.withColumns({
        "received_date": D.parse_master_date("received_date"),
        "deadline": D.parse_master_date("deadline"),
    })
    if "sheet_pos" in out.columns:
        return out.withColumnRenamed("sheet_pos", "master_pos")
    return out.withColumn("master_pos", F.monotonically_increasing_id()) if keep_order else out


def merge_master(fresh: DataFrame, master: DataFrame) -> DataFrame:
    """Fresh rows + master, keep-last on KEY6 with existing rows winning (PIPE-3).

    One shuffle on the key (with a partial top-1 before it).  The result is
    not sorted: sorting belongs to publishing, so merges can be chained.
    """
    f = fresh.select(*CANONICAL9, *[c for c in LINEAGE if c in fresh.columns]) \
        .withColumn("is_existing", F.lit(0))
    extra = ["master_pos"] if "master_pos" in master.columns else []
    m = master.select(*MASTER13, *extra).withColumn("is_existing", F.lit(1))
    both = sets.append_missing(f, m)
    order = [c for c in LINEAGE if c in both.columns] + extra
    merged = dedup.keep_existing(both, order)
    return X.fill_human_columns(merged.select(*MASTER13))


def announce(master: DataFrame, as_of, help_url: str = DEFAULT_HELP_URL,
             tag: str = DEFAULT_TAG) -> DataFrame:
    """Draft announcement for every row (PIPE-4)."""
    return master.withColumn("draft_announcement", draft_announcement(as_of, help_url, tag))


def publish_view(master: DataFrame, with_position: bool = True) -> DataFrame:
    """Sheet view: deadline desc, authority asc, dense row position, display dates (PIPE-5)."""
    order = ordering.sort_columns("deadline", [c for c in KEY6 if c != "local_authority_name"])
    out = master
    if with_position:
        out = ordering.with_positions(master, order, name="position")
    return out.withColumns({"deadline": D.display_date("deadline"),
                            "received_date": D.display_date("received_date")})


def run_refresh(captures: DataFrame, sources: DataFrame, master: DataFrame, as_of: _dt.date,
                days: int | None = D.WINDOW_DAYS, help_url: str = DEFAULT_HELP_URL,
                tag: str = DEFAULT_TAG, report_path: str | None = None) -> DataFrame:
    """The whole refresh: fresh notices merged into the master and announced.

    ``report_path`` is a new folder that gets ``refresh_report`` as Parquet.
    """
    if report_path is None:
        fresh = fresh_notices(captures, sources, as_of, days)
    else:  # parsed pages are kept once, for the report and the refresh
        pages = materialize(capture_pages(captures))
        report_pages(pages, captures, sources).write.parquet(report_path)
        fresh = fresh_from_pages(pages, sources, as_of, days, parsed_once=True)
    return announce(merge_master(fresh, master), as_of, help_url, tag)
