"""DuckDB SQL twins of the fixtures (the correctness oracle).

Each CTE mirrors a Spark derivation in ``plans.fixtures``; queries in
``plans.queries`` combine them.  Written once, by hand, in plain SQL.
"""

from __future__ import annotations

from ..functions.announce import (DEFAULT_HELP_URL, DEFAULT_TAG, HEADLINE)
from ..schema import (AGILE_TEMPLATE, BOARD_CASE_BASE, CONSULTATION_BASE, KILDARE_URL,
                      SOUTH_DUBLIN_TEMPLATE, STANDARD_SITES, WEXFORD_URL)
from .fixtures import AS_OF, LAYOUTS, PAGE_KEYWORDS

AS_OF_SQL = f"DATE '{AS_OF.isoformat()}'"
WINDOW_FROM_SQL = f"({AS_OF_SQL} - 365)"


def sql_list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


APPS = """
apps AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS file_number,
         CAST(o_orderdate AS DATE) AS received_date,
         concat('Council ', lpad(CAST(o_custkey % 31 AS VARCHAR), 2, '0')) AS local_authority_name,
         CAST(o_orderdate AS DATE) + (CASE o_custkey % 31 WHEN 0 THEN 39 WHEN 1 THEN 25 ELSE 32 END) AS deadline,
         concat('Customer ', CAST(o_custkey AS VARCHAR)) AS applicant_name,
         CASE WHEN o_custkey % 31 = 1 THEN 'N/A for DECC' ELSE o_orderpriority END AS development_address,
         o_orderstatus AS development_description,
         concat('http://www.example.ie/C', CAST(o_custkey % 31 AS VARCHAR), '/SearchExact/Description') AS url,
         CASE o_orderkey % 3 WHEN 0 THEN 'data' WHEN 1 THEN 'gas' ELSE 'tunnel' END AS search_term,
         CASE o_custkey % 31 WHEN 0 THEN 'sid' WHEN 1 THEN 'consultation' ELSE 'council' END AS class,
         CASE o_custkey % 31 WHEN 0 THEN 8 WHEN 1 THEN 9 ELSE 1 END AS source_rank,
         CAST(o_orderkey % 3 + 1 AS INTEGER) AS keyword_rank,
         1 AS site_rank,
         CAST(o_orderkey // 10 AS INTEGER) AS page_no,
         CAST(o_orderkey % 10 AS INTEGER) AS row_pos,
         o_orderstatus, o_orderpriority, o_orderkey
  FROM orders)"""

FRESH = """
fresh AS (
  SELECT * FROM apps
  UNION ALL
  SELECT * REPLACE ('gas' AS search_term, 2 AS keyword_rank) FROM apps WHERE o_orderstatus = 'P')"""


def _dialect(col: str) -> str:
    return (f"CASE o_orderkey % 3 WHEN 0 THEN strftime({col}, '%Y-%m-%d') "
            f"WHEN 1 THEN strftime({col}, '%d/%m/%Y') "
            f"ELSE replace(strftime({col}, '%d %b %Y'), 'Sep', 'Sept') END")


def _parse_master(col: str) -> str:
    s = f"regexp_replace(regexp_replace({col}, '^\\s+', ''), '\\s+$', '')"
    return (f"CAST(coalesce(try_strptime({s}, '%Y-%m-%d'), try_strptime({s}, '%d/%m/%Y'), "
            f"try_strptime(replace({s}, 'Sept', 'Sep'), '%d %b %Y')) AS DATE)")


EXISTING = f"""
existing_text AS (
  SELECT file_number, {_dialect('received_date')} AS received_date, local_authority_name,
         {_dialect('deadline')} AS deadline, applicant_name, development_address,
         development_description, url, search_term,
         concat('note ', file_number) AS comments,
         CASE WHEN o_orderstatus = 'O' THEN 'Yes' END AS show_public,
         CASE WHEN o_orderstatus = 'F' THEN 'Yes' END AS announcement_sent,
         CAST(NULL AS VARCHAR) AS draft_announcement
  FROM apps WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')),
existing AS (
  SELECT * REPLACE ({_parse_master('received_date')} AS received_date,
                    {_parse_master('deadline')} AS deadline)
  FROM existing_text)"""

MASTER13_SQL = ("file_number, received_date, local_authority_name, deadline, applicant_name, "
                "development_address, development_description, url, search_term, comments, "
                "show_public, announcement_sent, draft_announcement")
KEY6_SQL = ("file_number, received_date, local_authority_name, applicant_name, "
            "development_address, development_description")
LINEAGE_DESC = ("source_rank DESC NULLS FIRST, keyword_rank DESC NULLS FIRST, "
                "site_rank DESC NULLS FIRST, page_no DESC NULLS FIRST, row_pos DESC NULLS FIRST")

MERGED = f"""
merged AS (
  SELECT file_number, received_date, local_authority_name, deadline, applicant_name,
         development_address, development_description, url, search_term,
         coalesce(comments, '') AS comments, coalesce(show_public, '-') AS show_public,
         coalesce(announcement_sent, '-') AS announcement_sent, draft_announcement
  FROM (
    SELECT *, row_number() OVER (PARTITION BY {KEY6_SQL}
                                 ORDER BY is_existing DESC, {LINEAGE_DESC}) AS rn
    FROM (
      SELECT file_number, received_date, local_authority_name, deadline, applicant_name,
             development_address, development_description, url, search_term,
             CAST(NULL AS VARCHAR) AS comments, CAST(NULL AS VARCHAR) AS show_public,
             CAST(NULL AS VARCHAR) AS announcement_sent, CAST(NULL AS VARCHAR) AS draft_announcement,
             0 AS is_existing, source_rank, keyword_rank, site_rank, page_no, row_pos
      FROM fresh
      UNION ALL
      SELECT {MASTER13_SQL}, 1 AS is_existing, NULL, NULL, NULL, NULL, NULL FROM existing))
  WHERE rn = 1)"""


def announce_expr(help_url: str = DEFAULT_HELP_URL, tag: str = DEFAULT_TAG) -> str:
    age = f"date_diff('day', deadline, {AS_OF_SQL})"
    decc = "development_address = 'N/A for DECC'"
    text = (f"concat('{HEADLINE}', chr(10), comments, ' proposed for ', "
            f"CASE WHEN {decc} THEN 'DECC' ELSE development_address END, chr(10), "
            f"'Deadline for submissions: ', strftime(deadline, '%d %b'), chr(10), "
            f"CASE WHEN {decc} THEN '' ELSE concat(chr(10), 'Ref No: ', file_number) END, "
            f"chr(10), 'Link: ', url, chr(10), 'How to submit: ', '{help_url}', chr(10), chr(10), "
            f"'{tag}')")
    return (f"CASE WHEN deadline IS NULL THEN draft_announcement "
            f"WHEN {age} > 50 THEN 'No Tweet' "
            f"WHEN lower(show_public) = 'yes' AND {age} <= 3 THEN {text} "
            f"ELSE 'No tweet' END")


def display_date(col: str) -> str:
    return f"replace(strftime({col}, '%d %b %Y'), 'Sep', 'Sept')"


# ---------------------------------------------------------------- rendered pages
def expected_notices(layout: str | None, window: bool, extra: str = "") -> str:
    """Canonical9 rows the pipeline must extract from ``render_captures``."""
    lay = f"'{layout}'" if layout else f"{sql_list(LAYOUTS)}[(o_orderkey // 10) % {len(LAYOUTS)} + 1]"
    kw = f"{sql_list(PAGE_KEYWORDS)}[(o_orderkey // 10) % {len(PAGE_KEYWORDS)} + 1]"
    council = "['dublincity', 'fingal', 'dunlaoghaire'][(o_orderkey // 10) % 3 + 1]"
    agile = (f"replace(replace(replace(replace('{AGILE_TEMPLATE}', '{{council}}', {council}), "
             f"'{{keyword}}', {kw}), '{{from}}', strftime({WINDOW_FROM_SQL}, '%Y-%m-%d')), "
             f"'{{to}}', strftime({AS_OF_SQL}, '%Y-%m-%d'))")
    site = f"{sql_list(STANDARD_SITES)}[(o_orderkey // 10) % {len(STANDARD_SITES)} + 1]"
    f_file = "CAST(o_orderkey AS VARCHAR)"
    base = f"""
pages_src AS (
  SELECT o_orderkey, {lay} AS layout, CAST(o_orderdate AS DATE) AS d,
         CASE WHEN {lay} = 'case1' THEN CAST(o_orderkey AS INTEGER)
              ELSE CAST(o_orderkey // 10 AS INTEGER) END AS page_no,
         CASE WHEN {lay} = 'case1' THEN 0 ELSE CAST(o_orderkey % 10 AS INTEGER) END AS row_pos,
         {kw} AS keyword, {council} AS council, {agile} AS agile, {site} AS site,
         {f_file} AS f_file,
         concat('Customer ', CAST(o_custkey AS VARCHAR)) AS f_applicant,
         concat(o_orderpriority, ' Road & Yard') AS f_address,
         concat('Status ', o_orderstatus, ' <works>') AS f_description,
         concat('Council ', lpad(CAST(o_custkey % 31 AS VARCHAR), 2, '0')) AS f_authority
  FROM orders),
notices AS (
  SELECT CASE layout WHEN 'links5' THEN 'N/A for DECC' ELSE f_file END AS file_number,
         d AS received_date,
         CASE WHEN layout IN ('table', 'grid5') THEN f_authority
              WHEN layout = 'responsive7' THEN CASE council WHEN 'dublincity' THEN 'Dublin City Council'
                   WHEN 'fingal' THEN 'Fingal Co. Co.' ELSE 'Dun Laoghaire Co. Co.' END
              WHEN layout = 'columns4' THEN 'Wexford Co. Co.'
              WHEN layout = 'deflist4' THEN 'South Dublin Co. Co.'
              WHEN layout IN ('cards6', 'case1') THEN 'An Bord Pleanala - SID'
              ELSE 'Dept. Environment/Climate' END AS local_authority_name,
         d + CASE WHEN layout IN ('cards6', 'case1') THEN 39 WHEN layout = 'links5' THEN 25
                  ELSE 32 END AS deadline,
         CASE layout WHEN 'links5' THEN 'Gov Consultation' ELSE f_applicant END AS applicant_name,
         CASE layout WHEN 'links5' THEN 'N/A for DECC' ELSE f_address END AS development_address,
         CASE WHEN layout IN ('grid5', 'columns4', 'deflist4') THEN 'No Description'
              ELSE f_description END AS development_description,
         CASE layout
           WHEN 'table' THEN concat(replace(site, 'SearchExact/Description', 'AppFileRefDetails/'), f_file, '/0')
           WHEN 'grid5' THEN '{KILDARE_URL}'
           WHEN 'responsive7' THEN replace(agile, ' ', '%20')
           WHEN 'columns4' THEN '{WEXFORD_URL}'
           WHEN 'deflist4' THEN replace(replace('{SOUTH_DUBLIN_TEMPLATE}', '{{keyword}}', keyword), ' ', '%20')
           WHEN 'links5' THEN concat('{CONSULTATION_BASE}', '/en/consultation/', f_file, '/')
           ELSE concat('{BOARD_CASE_BASE}', f_file) END AS url,
         CASE WHEN layout IN ('cards6', 'case1') THEN 'N/A for SID'
              WHEN layout = 'links5' THEN 'N/A for DECC' ELSE keyword END AS search_term,
         layout, page_no, row_pos
  FROM pages_src)"""
    cols = ("file_number, received_date, local_authority_name, deadline, applicant_name, "
            "development_address, development_description, url, search_term")
    cols += extra
    if not window:
        return base, f"SELECT {cols} FROM notices"
    sel = f"""
SELECT {cols} FROM notices WHERE layout IN ('cards6', 'case1')
  OR (layout <> 'links5' AND received_date >= {WINDOW_FROM_SQL})
UNION ALL
SELECT {cols} FROM (
  SELECT *, max(CASE WHEN received_date <= {WINDOW_FROM_SQL} THEN 1 ELSE 0 END)
              OVER (ORDER BY page_no, row_pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS stopped
  FROM notices WHERE layout = 'links5') WHERE stopped = 0"""
    return base, sel
