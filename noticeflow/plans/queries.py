"""Driver queries: one per operator family, each with its DuckDB oracle.

Every query reads the driver's tables in full (or data Spark derives from
them) and returns a DataFrame whose column names match the oracle SQL.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import text as X
from ..operators import audit, dedup, filters, keywords, ordering, sets
from ..schema import CANONICAL9, KEY6, LINEAGE, MASTER13, sources_df
from ..session import ensure_checkpoint_dir
from ..sources import files as io_files
from ..sources import plan as requests
from ..sources.captures import read_captures, select_run
from ..sources.master_store import MasterStore
from ..streaming import refresh
from . import fixtures as FX
from . import oracle as O
from . import pipeline as P

AS_OF = FX.AS_OF
TAKE_WHILE_DAYS = 1461  # four years: listing per customer read until an older order
KEYWORD_PARAM = "data centre, gas ,tunnel,, gas"
SEARCH_KEYWORDS = ["data", "the", "tion"]

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def _orders(spark, sf):
    return FX.table(spark, sf, "orders")


def _apps(spark, sf):
    return FX.apps(_orders(spark, sf))


def scratch_dir(spark: SparkSession, tag: str) -> str:
    """A fresh folder under the shared checkpoint location (never machine-local on a cluster)."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/noticeflow-{tag}-{uuid.uuid4().hex[:12]}"


C9 = ", ".join(CANONICAL9)
W = "WITH " + O.APPS


# ---------------------------------------------------------------- S-*
@register("canonical_projection", W + """
SELECT CAST(o_orderkey AS VARCHAR) AS file_number, received_date,
       'Wexford Co. Co.' AS local_authority_name, applicant_name,
       o_orderpriority AS development_address, 'No Description' AS development_description,
       'https://dms.wexfordcoco.ie/advanced.php' AS url, search_term
FROM apps""")
def canonical_projection(spark, sf):
    a = _apps(spark, sf)
    return a.select(
        F.col("o_orderkey").cast("string").alias("file_number"), "received_date",
        F.lit("Wexford Co. Co.").alias("local_authority_name"), "applicant_name",
        F.col("o_orderpriority").alias("development_address"),
        F.lit(X.NO_DESCRIPTION).alias("development_description"),
        F.lit("https://dms.wexfordcoco.ie/advanced.php").alias("url"), "search_term")


_AGILE_URL_SQL = ("concat('https://planning.agileapplications.ie/', CASE o_custkey % 4 WHEN 0 THEN 'dublincity' "
                  "WHEN 1 THEN 'fingal' WHEN 2 THEN 'dunlaoghaire' ELSE 'meath' END, "
                  "'/search-applications/results?id=', CAST(o_orderkey AS VARCHAR))")


@register("authority_from_url", f"""
SELECT CAST(o_orderkey AS VARCHAR) AS file_number, {_AGILE_URL_SQL} AS url,
       CASE WHEN contains({_AGILE_URL_SQL}, 'dublincity') THEN 'Dublin City Council'
            WHEN contains({_AGILE_URL_SQL}, 'fingal') THEN 'Fingal Co. Co.'
            WHEN contains({_AGILE_URL_SQL}, 'dunlaoghaire') THEN 'Dun Laoghaire Co. Co.' END AS local_authority_name
FROM orders""")
def authority_from_url(spark, sf):
    o = _orders(spark, sf)
    c4 = F.col("o_custkey") % 4
    url = F.concat(F.lit("https://planning.agileapplications.ie/"),
                   F.when(c4 == 0, "dublincity").when(c4 == 1, "fingal")
                   .when(c4 == 2, "dunlaoghaire").otherwise("meath"),
                   F.lit("/search-applications/results?id="), F.col("o_orderkey").cast("string"))
    return o.select(F.col("o_orderkey").cast("string").alias("file_number"), url.alias("url")) \
        .withColumn("local_authority_name", X.authority_from_url("url"))


def _strip_sql(e: str) -> str:
    return f"regexp_replace(regexp_replace({e}, '^\\s+', ''), '\\s+$', '')"


_LBL_REF = "concat('Case reference:', CAST(o_orderkey AS VARCHAR))"
_LBL_DATE = "concat('Date lodged:', strftime(CAST(o_orderdate AS DATE), '%d/%m/%Y'), ' 10:15')"
_LBL_TITLE = "concat(CAST(o_orderkey AS VARCHAR), ': ', o_orderpriority, ' : annex')"
_LBL_DESC = "concat(chr(9), 'Description:', ' Status ', o_orderstatus, chr(10), ' ')"


@register("label_cleanup", f"""
SELECT replace({_LBL_REF}, 'Case reference:', '') AS file_number,
       substr(replace({_LBL_DATE}, 'Date lodged:', ''), 1, 10) AS received_text,
       {_strip_sql(f"split_part({_LBL_TITLE}, ':', 1)")} AS case_number,
       {_strip_sql(f"split_part({_LBL_TITLE}, ':', 2)")} AS development_address,
       {_strip_sql(f"replace({_LBL_DESC}, 'Description:', '')")} AS development_description
FROM orders""")
def label_cleanup(spark, sf):
    o = _orders(spark, sf)
    ref = F.concat(F.lit("Case reference:"), F.col("o_orderkey").cast("string"))
    lodged = F.concat(F.lit("Date lodged:"), F.date_format(F.col("o_orderdate").cast("date"), "dd/MM/yyyy"),
                      F.lit(" 10:15"))
    title = F.concat(F.col("o_orderkey").cast("string"), F.lit(": "), F.col("o_orderpriority"),
                     F.lit(" : annex"))
    desc = F.concat(F.lit("\t"), F.lit("Description:"), F.lit(" Status "), F.col("o_orderstatus"),
                    F.lit("\n"), F.lit(" "))
    return o.select(
        X.remove_literal(ref, X.BOARD_LABELS["file_number"]).alias("file_number"),
        X.prefix(X.remove_literal(lodged, X.BOARD_LABELS["received_date"]), 10).alias("received_text"),
        X.split_take(title, ":", 0).alias("case_number"),
        X.split_take(title, ":", 1).alias("development_address"),
        X.py_strip(X.remove_literal(desc, X.BOARD_LABELS["development_description"]))
        .alias("development_description"))


_COUNTER = ("concat('Showing page ', CAST(o_orderkey % 97 + 1 AS VARCHAR), ' of ', "
            "CAST(o_custkey * 13 AS VARCHAR), ' (', CAST(o_custkey AS VARCHAR), ',', "
            "lpad(CAST(o_orderkey % 1000 AS VARCHAR), 3, '0'), ' results)')")
_COUNTER_RE = "(\\d[\\d,]*)\\s*(?:of|/)\\s*(\\d[\\d,]*)"


@register("digits_to_int", f"""
SELECT CAST(o_orderkey AS VARCHAR) AS file_number,
  TRY_CAST(NULLIF(regexp_replace(regexp_extract({_COUNTER}, '{_COUNTER_RE}', 1), '\\D', '', 'g'), '') AS BIGINT) AS current_page,
  TRY_CAST(NULLIF(regexp_replace(regexp_extract({_COUNTER}, '{_COUNTER_RE}', 2), '\\D', '', 'g'), '') AS BIGINT) AS last_page,
  TRY_CAST(NULLIF(regexp_replace(regexp_extract({_COUNTER}, '\\(([^)]*)\\)', 1), '\\D', '', 'g'), '') AS BIGINT) AS total_results
FROM orders""")
def digits_to_int(spark, sf):
    o = _orders(spark, sf)
    label = F.concat(F.lit("Showing page "), (F.col("o_orderkey") % 97 + 1).cast("string"), F.lit(" of "),
                     (F.col("o_custkey") * 13).cast("string"), F.lit(" ("),
                     F.col("o_custkey").cast("string"), F.lit(","),
                     F.lpad((F.col("o_orderkey") % 1000).cast("string"), 3, "0"), F.lit(" results)"))
    return o.select(F.col("o_orderkey").cast("string").alias("file_number"),
                    audit.page_counter(label, 1).alias("current_page"),
                    audit.page_counter(label, 2).alias("last_page"),
                    X.digits_to_int(F.regexp_extract(label, r"\(([^)]*)\)", 1)).alias("total_results"))


@register("detail_url", f"""
SELECT file_number,
       concat(replace(concat('http://www.eplanning.ie/C', CAST(o_custkey % 31 AS VARCHAR), 'CC/SearchExact/Description'),
              'SearchExact/Description', 'AppFileRefDetails/'), file_number, '/0') AS url,
       concat('https://www.pleanala.ie/en-ie/case/', file_number) AS case_url,
       replace(concat('http://www.sdublincoco.ie/Planning/Applications?p=1&prop=data centre ', o_orderpriority), ' ', '%20') AS search_url
FROM (SELECT CAST(o_orderkey AS VARCHAR) AS file_number, o_custkey, o_orderpriority FROM orders)""")
def detail_url(spark, sf):
    o = _orders(spark, sf).select(F.col("o_orderkey").cast("string").alias("file_number"),
                                  "o_custkey", "o_orderpriority")
    site = F.concat(F.lit("http://www.eplanning.ie/C"), (F.col("o_custkey") % 31).cast("string"),
                    F.lit("CC/SearchExact/Description"))
    search = F.concat(F.lit("http://www.sdublincoco.ie/Planning/Applications?p=1&prop=data centre "),
                      F.col("o_orderpriority"))
    return o.select("file_number", X.detail_url(site, "file_number").alias("url"),
                    X.absolute_url("https://www.pleanala.ie/en-ie/case/", "file_number").alias("case_url"),
                    X.encode_spaces(search).alias("search_url"))


@register("fill_and_mask", W + f""",
src AS (
  SELECT file_number, deadline,
         CASE WHEN o_orderstatus <> 'F' THEN concat('c', file_number) END AS comments,
         CASE WHEN o_orderstatus = 'O' THEN 'Yes' END AS show_public,
         CASE WHEN o_orderpriority = '1-URGENT' THEN 'Yes' END AS announcement_sent,
         concat('''=if(', file_number, ')') AS draft_announcement,
         concat('''', strftime(deadline, '%d/%m/%Y')) AS deadline_text
  FROM apps)
SELECT file_number, coalesce(comments, '') AS comments, coalesce(show_public, '-') AS show_public,
       coalesce(announcement_sent, '-') AS announcement_sent, '' AS extra,
       regexp_replace(CASE WHEN date_diff('day', deadline, {O.AS_OF_SQL}) > 50 THEN 'No Tweet'
                           ELSE draft_announcement END, '^''=', '=') AS draft_announcement,
       regexp_replace(deadline_text, '''', '', 'g') AS deadline_text
FROM src""")
def fill_and_mask(spark, sf):
    a = _apps(spark, sf)
    src = a.select(
        "file_number", "deadline",
        F.when(F.col("o_orderstatus") != "F", F.concat(F.lit("c"), F.col("file_number"))).alias("comments"),
        F.when(F.col("o_orderstatus") == "O", F.lit("Yes")).alias("show_public"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("Yes")).alias("announcement_sent"),
        F.concat(F.lit("'=if("), F.col("file_number"), F.lit(")")).alias("draft_announcement"),
        F.concat(F.lit("'"), F.date_format("deadline", "dd/MM/yyyy")).alias("deadline_text"))
    filled = X.fill_human_columns(src).withColumn("extra", F.lit(""))
    masked = filled.withColumn("draft_announcement", F.when(
        D.days_overdue("deadline", AS_OF) > 50, F.lit("No Tweet")).otherwise(F.col("draft_announcement")))
    cleaned = X.clean_columns(masked, {"draft_announcement": ("^'=", "="), "deadline_text": ("'", "")})
    return cleaned.select("file_number", "comments", "show_public", "announcement_sent", "extra",
                          "draft_announcement", "deadline_text")


# ---------------------------------------------------------------- D-*
_BAD_DMY = ("CASE WHEN o_orderstatus = 'P' THEN strftime(CAST(o_orderdate AS DATE), '%-d-%-m-%Y') "
            "ELSE strftime(CAST(o_orderdate AS DATE), '%-d/%-m/%Y') END")


@register("parse_day_first", f"""
SELECT CAST(o_orderkey AS VARCHAR) AS file_number, {_BAD_DMY} AS received_text,
       CAST(try_strptime({_BAD_DMY}, '%d/%m/%Y') AS DATE) AS received_date
FROM orders""")
def parse_day_first(spark, sf):
    o = _orders(spark, sf)
    d = F.col("o_orderdate").cast("date")
    txt = F.when(F.col("o_orderstatus") == "P", F.date_format(d, "d-M-yyyy")) \
        .otherwise(F.date_format(d, "d/M/yyyy"))
    return o.select(F.col("o_orderkey").cast("string").alias("file_number"), txt.alias("received_text")) \
        .withColumn("received_date", D.parse_day_first("received_text"))


_LONG = ("concat(' ', CASE WHEN o_orderstatus = 'P' THEN concat(strftime(CAST(o_orderdate AS DATE), '%-d'), 'th ', "
         "strftime(CAST(o_orderdate AS DATE), '%B %Y')) ELSE strftime(CAST(o_orderdate AS DATE), '%-d %B %Y') END, chr(10))")


@register("parse_long_month", f"""
SELECT CAST(o_orderkey AS VARCHAR) AS file_number, {_LONG} AS received_text,
       CAST(try_strptime({_strip_sql(_LONG)}, '%d %B %Y') AS DATE) AS received_date
FROM orders""")
def parse_long_month(spark, sf):
    o = _orders(spark, sf)
    d = F.col("o_orderdate").cast("date")
    body = F.when(F.col("o_orderstatus") == "P",
                  F.concat(F.date_format(d, "d"), F.lit("th "), F.date_format(d, "MMMM yyyy"))) \
        .otherwise(F.date_format(d, "d MMMM yyyy"))
    txt = F.concat(F.lit(" "), body, F.lit("\n"))
    return o.select(F.col("o_orderkey").cast("string").alias("file_number"), txt.alias("received_text")) \
        .withColumn("received_date", D.parse_long_month("received_text"))


@register("parse_mixed_dates", W + f""",
t AS (SELECT file_number, {O._dialect('received_date')} AS received_text FROM apps)
SELECT file_number, received_text, {O._parse_master('received_text')} AS received_date FROM t""")
def parse_mixed_dates(spark, sf):
    a = _apps(spark, sf)
    k3 = F.col("o_orderkey") % 3
    d = F.col("received_date")
    txt = (F.when(k3 == 0, F.date_format(d, "yyyy-MM-dd")).when(k3 == 1, F.date_format(d, "dd/MM/yyyy"))
           .otherwise(F.replace(F.date_format(d, "dd MMM yyyy"), F.lit("Sep"), F.lit("Sept"))))
    return a.select("file_number", txt.alias("received_text")) \
        .withColumn("received_date", D.parse_master_date("received_text"))


@register("deadline_by_class", W + """
SELECT file_number, received_date, class, deadline FROM apps""")
def deadline_by_class(spark, sf):
    a = _apps(spark, sf)
    days = F.when(F.col("class") == "sid", 39).when(F.col("class") == "consultation", 25).otherwise(32)
    return a.select("file_number", "received_date", "class",
                    D.deadline("received_date", days).alias("deadline"))


@register("days_overdue", W + f"""
SELECT file_number, deadline, CAST(date_diff('day', deadline, {O.AS_OF_SQL}) AS BIGINT) AS days_overdue FROM apps""")
def days_overdue(spark, sf):
    return _apps(spark, sf).select("file_number", "deadline",
                                   D.days_overdue("deadline", AS_OF).alias("days_overdue"))


@register("display_dates", W + f"""
SELECT file_number, {O.display_date('received_date')} AS received_text, {O.display_date('deadline')} AS deadline_text FROM apps""")
def display_dates(spark, sf):
    return _apps(spark, sf).select("file_number", D.display_date("received_date").alias("received_text"),
                                   D.display_date("deadline").alias("deadline_text"))


# ---------------------------------------------------------------- SRC-2, F-1
_KWS = keywords.keyword_list(KEYWORD_PARAM)


@register("search_plan", f"""
SELECT n_nationkey, CAST(k.keyword_rank AS BIGINT) AS keyword_rank, k.keyword,
       concat('https://planning.example.ie/', lower(n_name), '/search?q=', replace(k.keyword, ' ', '%20'),
              '&from=', strftime({O.WINDOW_FROM_SQL}, '%Y-%m-%d'), '&to=', strftime({O.AS_OF_SQL}, '%Y-%m-%d')) AS request_url
FROM nation CROSS JOIN (VALUES {", ".join(f"({i + 1}, '{k}')" for i, k in enumerate(_KWS))}) AS k(keyword_rank, keyword)""")
def search_plan(spark, sf):
    site = F.concat(F.lit("https://planning.example.ie/"), F.lower("n_name"),
                    F.lit("/search?q={keyword}&from={from}&to={to}"))
    sources = FX.table(spark, sf, "nation").select(
        F.col("n_nationkey").alias("source_id"), F.col("n_nationkey").alias("source_rank"), F.lit(1).alias("site_rank"),
        F.lit("table").alias("layout"), F.lit(True).alias("keyword_search"), site.alias("url_template"))
    plan = requests.search_plan(sources, dedup.ordered_keywords(F.lit(KEYWORD_PARAM)), AS_OF)
    return plan.select(F.col("source_id").alias("n_nationkey"),
                       F.col("keyword_rank").cast("bigint").alias("keyword_rank"), "keyword", "request_url")


@register("keyword_hits", f"""
SELECT doc_id, k.kw AS search_term, CAST(k.r AS BIGINT) AS keyword_rank
FROM documents JOIN (VALUES {", ".join(f"({i + 1}, '{k}')" for i, k in enumerate(SEARCH_KEYWORDS))}) AS k(r, kw)
  ON contains(lower(text), k.kw)
WHERE trim(k.kw) <> ''""")
def keyword_hits(spark, sf):
    docs = FX.table(spark, sf, "documents").select("doc_id", "text")
    hits = keywords.keyword_hits(docs, "text", SEARCH_KEYWORDS)
    return filters.non_blank(hits, "search_term").select(
        "doc_id", "search_term", F.col("keyword_rank").cast("bigint").alias("keyword_rank"))


# ---------------------------------------------------------------- F-*
@register("recent_window", W + f"SELECT {C9} FROM apps WHERE received_date >= {O.WINDOW_FROM_SQL}")
def recent_window(spark, sf):
    return filters.recent(_apps(spark, sf), AS_OF).select(*CANONICAL9)


@register("closed_range", W + f"SELECT {C9} FROM apps WHERE received_date BETWEEN {O.WINDOW_FROM_SQL} AND {O.AS_OF_SQL}")
def closed_range(spark, sf):
    return filters.closed_range(_apps(spark, sf), AS_OF).select(*CANONICAL9)


@register("strict_recent", W + f"SELECT {C9} FROM apps WHERE received_date > {O.WINDOW_FROM_SQL}")
def strict_recent(spark, sf):
    return filters.strictly_newer(_apps(spark, sf), AS_OF).select(*CANONICAL9)


@register("current_year", W + f"SELECT {C9} FROM apps WHERE year(received_date) = year({O.AS_OF_SQL})")
def current_year(spark, sf):
    return filters.current_year(_apps(spark, sf), AS_OF).select(*CANONICAL9)


@register("take_while_recent", f"""
SELECT CAST(o_orderkey AS VARCHAR) AS file_number, CAST(o_custkey AS BIGINT) AS o_custkey, CAST(o_orderdate AS DATE) AS received_date
FROM (SELECT *, max(CASE WHEN CAST(o_orderdate AS DATE) <= {O.AS_OF_SQL} - {TAKE_WHILE_DAYS} THEN 1 ELSE 0 END)
                OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS stopped
      FROM orders)
WHERE stopped = 0""")
def take_while_recent(spark, sf):
    o = _orders(spark, sf).select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("received_date"))
    kept = filters.take_while(o, by=["o_custkey"], order=["o_orderkey"],
                              stop=F.col("received_date") <= D.window_start(AS_OF, TAKE_WHILE_DAYS))
    return kept.select(F.col("o_orderkey").cast("string").alias("file_number"),
                       F.col("o_custkey").cast("bigint").alias("o_custkey"), "received_date")


# ---------------------------------------------------------------- U-*, DD-*
@register("union_sources", W + f"""
SELECT {C9}, 'councils' AS collector FROM apps WHERE class = 'council'
UNION ALL SELECT {C9}, 'board' AS collector FROM apps WHERE class = 'sid'
UNION ALL SELECT {C9}, 'consultations' AS collector FROM apps WHERE class = 'consultation'""")
def union_sources(spark, sf):
    a = _apps(spark, sf)
    parts = [a.where(F.col("class") == c).select(*CANONICAL9, F.lit(name).alias("collector"))
             for c, name in [("council", "councils"), ("sid", "board"), ("consultation", "consultations")]]
    return sets.append(*parts)


@register("union_missing_cols", "WITH " + O.APPS + "," + O.EXISTING + f"""
SELECT {C9}, CAST(NULL AS VARCHAR) AS comments, CAST(NULL AS VARCHAR) AS show_public,
       CAST(NULL AS VARCHAR) AS announcement_sent, CAST(NULL AS VARCHAR) AS draft_announcement, 0 AS is_existing FROM apps
UNION ALL SELECT {O.MASTER13_SQL}, 1 AS is_existing FROM existing""")
def union_missing_cols(spark, sf):
    o = _orders(spark, sf)
    fresh = FX.apps(o).select(*CANONICAL9).withColumn("is_existing", F.lit(0))
    master = P.master_from_text(FX.existing_master_text(o)).withColumn("is_existing", F.lit(1))
    return sets.append_missing(fresh, master).select(*MASTER13, "is_existing")


@register("distinct_rows", """
SELECT DISTINCT CAST(o_custkey AS BIGINT) AS o_custkey, o_orderstatus, o_orderpriority FROM orders""")
def distinct_rows(spark, sf):
    return dedup.distinct_rows(_orders(spark, sf).select("o_custkey", "o_orderstatus", "o_orderpriority"))


_KEEP_LAST = "WITH " + O.APPS + "," + O.FRESH + """
SELECT {c9} FROM (
  SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS rn FROM fresh) WHERE rn = 1"""


@register("keep_last_url_key", _KEEP_LAST.format(c9=C9, key=O.KEY6_SQL + ", url", order=O.LINEAGE_DESC))
def keep_last_url_key(spark, sf):
    return dedup.keep_last_key7(FX.fresh(_orders(spark, sf))).select(*CANONICAL9)


@register("keep_last_key", _KEEP_LAST.format(c9=C9, key=O.KEY6_SQL, order=O.LINEAGE_DESC))
def keep_last_key(spark, sf):
    return dedup.keep_last_key6(FX.fresh(_orders(spark, sf))).select(*CANONICAL9)


def _merged(spark, sf) -> DataFrame:
    o = _orders(spark, sf)
    return P.merge_master(FX.fresh(o), P.master_from_text(FX.existing_master_text(o)))


_MERGE_SQL = "WITH " + O.APPS + "," + O.FRESH + "," + O.EXISTING + "," + O.MERGED


@register("merge_master", _MERGE_SQL + f"\nSELECT {O.MASTER13_SQL} FROM merged")
def merge_master(spark, sf):
    return _merged(spark, sf)


@register("announce", _MERGE_SQL + f"""
SELECT {O.MASTER13_SQL.replace('draft_announcement', '')} {O.announce_expr()} AS draft_announcement FROM merged""")
def announce(spark, sf):
    return P.announce(_merged(spark, sf), AS_OF)


# ---------------------------------------------------------------- O-*, L-1
_ORDER_SQL = ("deadline DESC NULLS LAST, local_authority_name ASC NULLS LAST, file_number ASC NULLS LAST, "
              "received_date ASC NULLS LAST, applicant_name ASC NULLS LAST, "
              "development_address ASC NULLS LAST, development_description ASC NULLS LAST")


@register("sorted_positions", W + f"""
SELECT file_number, deadline, local_authority_name,
       row_number() OVER (ORDER BY {_ORDER_SQL}) - 1 AS position FROM apps""")
def sorted_positions(spark, sf):
    a = _apps(spark, sf).select(*CANONICAL9)
    order = ordering.sort_columns("deadline", [c for c in KEY6 if c != "local_authority_name"])
    return ordering.with_positions(a, order).select("file_number", "deadline", "local_authority_name",
                                                    "position")


@register("newest_first", W + f"""
SELECT file_number, received_date, local_authority_name FROM apps
ORDER BY received_date DESC NULLS LAST, local_authority_name ASC NULLS LAST, file_number""")
def newest_first(spark, sf):
    return ordering.newest_first(_apps(spark, sf), "received_date", ["file_number"]) \
        .select("file_number", "received_date", "local_authority_name")


@register("latest_lists", W + """
SELECT file_number, received_date FROM (
  SELECT *, dense_rank() OVER (PARTITION BY year(received_date) ORDER BY date_trunc('month', received_date) DESC) AS r
  FROM apps) WHERE r <= 4""")
def latest_lists(spark, sf):
    a = _apps(spark, sf).withColumns({"list_year": F.year("received_date"),
                                      "list_month": F.trunc("received_date", "month")})
    return ordering.latest_k(a, ["list_year"], "list_month", 4).select("file_number", "received_date")


# ---------------------------------------------------------------- EXT-*
def _roundtrip(layout: str | None, window: bool):
    base, sel = O.expected_notices(layout, window)
    sql = "WITH " + base.strip() + "\n" + sel.strip()

    def run(spark, sf):
        caps = FX.render_captures(_orders(spark, sf), layout)
        return P.fresh_notices(caps, sources_df(spark), AS_OF, D.WINDOW_DAYS if window else None) \
            .select(*CANONICAL9)
    return run, sql


def _sql_unwindowed() -> str:
    return _roundtrip(None, False)[1]


for _name, _layout in [("html_table_roundtrip", "table"), ("grid_records", "grid5"),
                       ("responsive_dedup", "responsive7"), ("column_zip", "columns4"),
                       ("definition_list", "deflist4"), ("detail_cards", "cards6"),
                       ("single_case", "case1"), ("consultation_links", "links5")]:
    _fn, _sql = _roundtrip(_layout, False)
    register(_name, _sql)(_fn)

_fn, _sql = _roundtrip(None, True)
register("combined_notices", _sql)(_fn)


@register("source_files", f"WITH s AS ({_sql_unwindowed()}) SELECT {', '.join(P.SOURCE_FILE)} FROM s")
def source_files(spark, sf):
    from pyspark.sql import types as T
    out = scratch_dir(spark, "sources")
    P.source_files(FX.render_captures(_orders(spark, sf), None), sources_df(spark), AS_OF, out)
    kinds = {"received_date": T.DateType()}
    schema = T.StructType([T.StructField(c, kinds.get(c, T.StringType())) for c in P.SOURCE_FILE])
    return io_files.read_csv(spark, out, schema)


_ANCHOR_RE = '<a href="([^"]*)">([^<]*)</a>'


@register("page_links", f"""
SELECT page_id, CAST(i AS BIGINT) AS link_pos, texts[i] AS anchor_text,
       CASE WHEN starts_with(hrefs[i], '/') THEN concat(base, hrefs[i]) ELSE hrefs[i] END AS link
FROM (SELECT page_id, regexp_extract(url, '^(https?://[^/?#]+)', 1) AS base,
             regexp_extract_all(html, '{_ANCHOR_RE}', 1) AS hrefs,
             regexp_extract_all(html, '{_ANCHOR_RE}', 2) AS texts FROM pages) p,
     unnest(generate_series(1, len(hrefs))) AS g(i)""")
def page_links(spark, sf):
    pages = FX.table(spark, sf, "pages")
    base = F.regexp_extract("url", r"^(https?://[^/?#]+)", 1)
    z = F.arrays_zip(F.regexp_extract_all("html", F.lit(_ANCHOR_RE), 1).alias("h"),
                     F.regexp_extract_all("html", F.lit(_ANCHOR_RE), 2).alias("t"))
    rows = pages.select("page_id", base.alias("base"), F.posexplode(z).alias("pos", "a"))
    href = F.col("a.h")
    return rows.select("page_id", (F.col("pos") + 1).cast("bigint").alias("link_pos"),
                       F.col("a.t").alias("anchor_text"),
                       F.when(href.startswith("/"), X.absolute_url(F.col("base"), href))
                       .otherwise(href).alias("link"))


_HOST = "regexp_extract(url, '^https?://([^/?#]+)', 1)"
_PAGE = "coalesce(TRY_CAST(NULLIF(regexp_extract(url, '[?&]page=(\\d+)', 1), '') AS INTEGER), 1)"


@register("completeness_audit", f"""
SELECT host, CAST(max(page_no) AS BIGINT) AS promised_pages, CAST(count(DISTINCT page_no) AS BIGINT) AS captured_pages,
       CAST(greatest(max(page_no) - count(DISTINCT page_no), 0) AS BIGINT) AS missing_pages
FROM (SELECT {_HOST} AS host, {_PAGE} AS page_no FROM pages) GROUP BY host""")
def completeness_audit(spark, sf):
    pages = FX.table(spark, sf, "pages")
    p = pages.select(F.regexp_extract("url", r"^https?://([^/?#]+)", 1).alias("host"),
                     F.coalesce(F.regexp_extract("url", r"[?&]page=(\d+)", 1).try_cast("int"),
                                F.lit(1)).alias("page_no"))
    return audit.completeness(p.withColumn("last_page", F.col("page_no")), ["host"])


@register("missing_pages", f"""
WITH pages_seen AS (SELECT DISTINCT CAST(o_custkey % 31 AS INTEGER) AS c, CAST((o_orderkey // 10) % 40 + 1 AS BIGINT) AS page_no
                    FROM orders WHERE (((o_orderkey // 10) % 40 + 1) * 7 + o_custkey % 31) % 5 <> 0),
wanted AS (SELECT c, g.page_no FROM (SELECT DISTINCT c FROM pages_seen), generate_series(1, {FX.COUNTED_LAST}) AS g(page_no))
SELECT concat('search ', CAST(c AS VARCHAR)) AS keyword, CAST({FX.COUNTED_LAST} AS BIGINT) AS promised_pages, page_no
FROM wanted ANTI JOIN pages_seen USING (c, page_no)""")
def missing_pages(spark, sf):
    """Which pages of each search no capture holds, from the counters that its pages show."""
    pages = P.capture_pages(FX.counted_pages(_orders(spark, sf)))
    by = ["fetched_on", "source_id", "keyword", "list_pos"]
    return audit.missing_pages(pages, by).select("keyword", "promised_pages", "page_no")


@register("capture_status", f"""
SELECT host, status, count(*) AS n FROM (
  SELECT {_HOST} AS host, CASE WHEN page_id % 7 = 0 THEN 'error' WHEN page_id % 3 = 1 AND contains(html, '</body>') THEN 'no_results'
              ELSE 'empty' END AS status
  FROM pages) GROUP BY host, status""")
def capture_status(spark, sf):
    """Raw pages that are no listing, some with a marker that is shown or that its parent hides."""
    pages = P.capture_pages(FX.marked_pages(FX.table(spark, sf, "pages")))
    s = pages.select(F.col("source_id").alias("host"), audit.page_status().alias("status"))
    return audit.error_report(s, ["host"])


@register("tolerant_pages", f"""
SELECT {_HOST} AS host, count(*) AS pages, true AS native FROM pages GROUP BY host""")
def tolerant_pages(spark, sf):
    """The raw pages by host, and whether the JVM reader hands at most one in twenty to the Python reader."""
    pages = P.capture_pages(FX.raw_captures(FX.table(spark, sf, "pages")))
    tolerant = F.sum(F.col("tolerant").cast("bigint"))
    return pages.groupBy(F.col("source_id").alias("host")).agg(
        F.count(F.lit(1)).alias("pages"), (tolerant * 20 <= F.count(F.lit(1))).alias("native"))


@register("retried_pages", f"""
WITH p AS (SELECT DISTINCT o_orderkey // 10 AS p FROM orders),
kept AS (SELECT p, 'first' AS who, {O.AS_OF_SQL} AS run_on FROM p WHERE p % 2 <> 0
         UNION ALL SELECT p, unnest(['again', 'equal']), {O.AS_OF_SQL} FROM p WHERE p % 2 = 0
         UNION ALL SELECT p, 'early', {O.AS_OF_SQL} - 7 FROM p WHERE p % 4 = 0)
SELECT concat('F', CAST(p AS VARCHAR)) AS file_number, who AS applicant_name, CAST(run_on AS DATE) AS run_on FROM kept""")
def retried_pages(spark, sf):
    """Records of each page's latest attempt in each run; attempts are not counted before."""
    records, _ = P.extract_records(FX.tried_pages(_orders(spark, sf)))
    return records.select(F.col("raw_file_number").alias("file_number"), F.col("raw_applicant").alias("applicant_name"),
                          F.col("fetched_on").alias("run_on"))


_OLD_URL = "http://old.example.org/enquiry"


@register("refresh_two_runs", f"""
SELECT CAST(o_orderkey AS VARCHAR) AS file_number, CAST(o_orderdate AS DATE) AS received_date,
       CASE WHEN o_orderstatus = 'F' THEN '{_OLD_URL}' ELSE '{FX.KILDARE_URL}' END AS url,
       CASE WHEN o_orderstatus = 'F' THEN 'old term'
            ELSE {O.sql_list(FX.PAGE_KEYWORDS)}[(o_orderkey // 10) % {len(FX.PAGE_KEYWORDS)} + 1] END AS search_term
FROM orders""")
def refresh_two_runs(spark, sf):
    """Equal notices of two runs: the later run's URL and term win, though its keyword ranks lower."""
    o = _orders(spark, sf)
    old = (FX.render_captures(o, "grid5", AS_OF - timedelta(days=31)).withColumn("url", F.lit(_OLD_URL))
           .withColumn("keyword", F.lit("old term")).withColumn("keyword_rank", F.lit(99)))
    new = FX.render_captures(o.where(F.col("o_orderstatus") != "F"), "grid5")
    folder = scratch_dir(spark, "runs")
    new.unionByName(old).write.partitionBy("fetched_on").parquet(folder)
    fresh = P.fresh_notices(read_captures(spark, folder), sources_df(spark), AS_OF, None)
    return dedup.keep_last_key6(fresh).select("file_number", "received_date", "url", "search_term")


@register("newest_list_cases", """
SELECT CAST(o_orderkey AS VARCHAR) AS file_number, CAST(o_orderdate AS DATE) AS received_date
FROM orders WHERE (o_orderkey // 10) % 7 < 4""")
def newest_list_cases(spark, sf):
    """Board pages in seven lists; those of the fifth and older ones are left out before parsing."""
    caps = FX.render_captures(_orders(spark, sf), "cards6")
    caps = caps.withColumn("list_pos", F.col("page_no") % 7 + 1)
    records, _ = P.extract_records(caps)
    return P.normalise(records, sources_df(spark)).select("file_number", "received_date")


@register("source_date_formats", """
SELECT CAST(o_orderkey AS VARCHAR) AS file_number, CAST(o_orderdate AS DATE) AS received_date
FROM orders WHERE (o_orderkey // 10) % 2 = 0
UNION ALL
SELECT CAST(o_orderkey AS VARCHAR), make_date(CAST(year(o_orderdate) AS BIGINT),
       CAST(CASE WHEN day(o_orderdate) <= 12 THEN day(o_orderdate) ELSE month(o_orderdate) END AS BIGINT),
       CAST(CASE WHEN day(o_orderdate) <= 12 THEN month(o_orderdate) ELSE day(o_orderdate) END AS BIGINT))
FROM orders WHERE (o_orderkey // 10) % 2 <> 0""")
def source_date_formats(spark, sf):
    """Two sources of one layout write day and month in different orders; each is read by its own formats."""
    caps = FX.render_captures(_orders(spark, sf), "grid5")
    caps = caps.withColumn("source_id", F.when(F.col("page_no") % 2 == 0, "day first").otherwise("month first"))
    formats = F.when(F.col("source_id") == "day first", F.array(F.lit("d/M/yyyy"))).otherwise(
        F.array(F.lit("M/d/yyyy"), F.lit("d/M/yyyy")))
    grid = sources_df(spark).where("source_id = 'kildare'")
    two = grid.withColumn("source_id", F.explode(F.array(F.lit("day first"), F.lit("month first")))) \
        .withColumn("date_formats", formats)
    records, _ = P.extract_records(caps)
    return P.normalise(records, two).select("file_number", "received_date")


@register("page_status", """
SELECT status, count(*) AS n FROM (
  SELECT CASE o_custkey % 5 WHEN 1 THEN 'empty' WHEN 2 THEN 'no_results' ELSE 'ok' END AS status FROM orders)
GROUP BY status""")
def page_status(spark, sf):
    pages = P.capture_pages(FX.case_pages(_orders(spark, sf)))
    return audit.error_report(pages.select(audit.page_status().alias("status")), [])


@register("quarantine_report", f"""
SELECT 'date' AS kind, 'board' AS source_id, CAST(NULL AS VARCHAR) AS url,
       'F' || o_orderkey AS file_number, '{FX.BAD_DATE_TEXT}' AS detail FROM orders WHERE o_custkey % 5 = 0
UNION ALL
SELECT 'page', 'board', 'https://example.org/case/' || o_orderkey, NULL,
       'no records and no sign of an empty result' FROM orders WHERE o_custkey % 5 = 1
UNION ALL
SELECT DISTINCT 'source', 'nowhere', NULL, NULL, 'unknown source' FROM orders WHERE o_custkey % 5 = 3""")
def quarantine_report(spark, sf):
    report = P.refresh_report(FX.case_pages(_orders(spark, sf)), sources_df(spark))
    return report.withColumn("url", F.when(F.col("kind") == "page", F.col("url")))


@register("refresh_one_run", """
SELECT 'F' || o_orderkey AS file_number, 'New' AS applicant_name, CAST(o_orderdate AS DATE) AS received_date
FROM orders WHERE o_custkey % 5 >= 3""")
def refresh_one_run(spark, sf):
    """Two capture runs hold the same pages; the refresh reads the later one only."""
    o = _orders(spark, sf)
    earlier = FX.case_pages(o, "Old", AS_OF - timedelta(days=31))
    folder = scratch_dir(spark, "captures")
    earlier.unionByName(FX.case_pages(o, "New")).write.partitionBy("fetched_on").parquet(folder)
    run = select_run(read_captures(spark, folder), AS_OF)
    return P.fresh_notices(run, sources_df(spark), AS_OF).select("file_number", "applicant_name", "received_date")


@register("latest_attempt", """
SELECT event_id, user_id, event_type FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""")
def latest_attempt(spark, sf):
    ev = FX.table(spark, sf, "events").select("event_id", "user_id", "event_type", "ts")
    return audit.latest_attempt(ev, ["user_id", "event_type"], "ts", ["event_id"]) \
        .select("event_id", "user_id", "event_type")


# ---------------------------------------------------------------- PIPE-5, PIPE-6
@register("published_master", _MERGE_SQL + f""",
announced AS (SELECT {O.MASTER13_SQL.replace('draft_announcement', '')} {O.announce_expr()} AS draft_announcement FROM merged)
SELECT row_number() OVER (ORDER BY {_ORDER_SQL}) - 1 AS position,
       file_number, {O.display_date('received_date')} AS received_date, local_authority_name,
       {O.display_date('deadline')} AS deadline, applicant_name, development_address, development_description,
       url, search_term, comments, show_public, announcement_sent, draft_announcement
FROM announced""")
def published_master(spark, sf):
    from pyspark.sql import types as T
    view = P.publish_view(P.announce(_merged(spark, sf), AS_OF))
    cols = ["position"] + MASTER13
    out = scratch_dir(spark, "published")
    io_files.write_csv(view.select(*cols), out)
    schema = T.StructType([T.StructField("position", T.LongType())]
                          + [T.StructField(c, T.StringType()) for c in MASTER13])
    # Like the sheet export, CSV cannot tell '' from missing: fill on read (S-14).
    return X.fill_human_columns(io_files.read_csv(spark, out, schema))


@register("refresh_stream", _MERGE_SQL + f"\nSELECT {O.MASTER13_SQL} FROM merged")
def refresh_stream(spark, sf):
    o = _orders(spark, sf)
    root = scratch_dir(spark, "stream")
    store = MasterStore(spark, f"{root}/master")
    store.publish(P.master_from_text(FX.existing_master_text(o)).select(*MASTER13))
    fresh = FX.fresh(o)
    inbox = f"{root}/inbox"
    for status in ("F", "O", "P"):  # three capture runs arrive, one per order status
        fresh.where(F.col("o_orderstatus") == status).select(*CANONICAL9, *LINEAGE) \
            .write.mode("append").parquet(inbox)
        refresh.run_available(spark, inbox, store, f"{root}/_checkpoint")
    return store.read()


_CAPTURED, _CAPTURED_WINDOW = O.expected_notices(None, True, ", page_no, row_pos")


@register("refresh_captures", "WITH " + _CAPTURED.strip() + ", recent AS (" + _CAPTURED_WINDOW + f""")
SELECT {C9}, '' AS comments, '-' AS show_public, '-' AS announcement_sent, CAST(NULL AS VARCHAR) AS draft_announcement
FROM (SELECT *, row_number() OVER (PARTITION BY {O.KEY6_SQL} ORDER BY page_no DESC, row_pos DESC) AS rn FROM recent) WHERE rn = 1""")
def refresh_captures(spark, sf):
    """Captured pages arrive in three deliveries and go through the stream into the master."""
    root = scratch_dir(spark, "captures")
    store = MasterStore(spark, f"{root}/master")
    caps = FX.render_captures(_orders(spark, sf))
    delivery = (F.when(F.col("layout").isin("table", "grid5", "responsive7"), 1)
                .when(F.col("layout").isin("columns4", "deflist4"), 2).otherwise(3))
    caps.withColumn("delivery", delivery).write.partitionBy("delivery").parquet(f"{root}/rendered")
    for d in (1, 2, 3):
        spark.read.parquet(f"{root}/rendered/delivery={d}").write.mode("append").parquet(f"{root}/inbox")
        refresh.run_available_captures(spark, f"{root}/inbox", sources_df(spark), store, f"{root}/_checkpoint", AS_OF)
    return store.read()


@register("empty_master", "SELECT " + ", ".join(f"CAST(NULL AS VARCHAR) AS {c}" for c in ("file_number", "comments"))
          + " FROM orders WHERE o_custkey < 0")
def empty_master(spark, sf):
    """A refresh that finds nothing publishes an empty master with its columns, which reads back (SNK-2)."""
    store = MasterStore(spark, f"{scratch_dir(spark, 'empty')}/master")
    none = FX.existing_master_text(_orders(spark, sf).where("o_custkey < 0"))
    store.publish(P.master_from_text(none).select(*MASTER13))
    return store.read().select("file_number", "comments")


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
