"""Schemas, key column sets and the ``sources`` dimension.

Names are snake_case; display names are applied only at the CSV sink.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# ---------------------------------------------------------------- columns
CANONICAL8 = [
    "file_number", "received_date", "local_authority_name", "applicant_name",
    "development_address", "development_description", "url", "search_term",
]
CANONICAL9 = [
    "file_number", "received_date", "local_authority_name", "deadline",
    "applicant_name", "development_address", "development_description", "url",
    "search_term",
]
HUMAN_COLUMNS = ["comments", "show_public", "announcement_sent", "draft_announcement"]
MASTER13 = CANONICAL9 + HUMAN_COLUMNS

# Deduplication keys: six descriptive columns (the master merge) and the same
# plus the URL (single-source runs).  Search term is deliberately not a key.
KEY6 = [
    "file_number", "received_date", "local_authority_name", "applicant_name",
    "development_address", "development_description",
]
KEY7 = KEY6 + ["url"]

# Lineage replaces the implicit row order of concatenated frames.  "Keep last"
# means the greatest tuple in this order (run, collector, keyword, site, page,
# row); ``run_day`` is the capture run's date as days since 1970.
LINEAGE = ["run_day", "source_rank", "keyword_rank", "site_rank", "page_no", "row_pos"]
NO_RUN = -(1 << 31)  # a missing capture date is older than any

CANONICAL9_SCHEMA = T.StructType([
    T.StructField("file_number", T.StringType()),
    T.StructField("received_date", T.DateType()),
    T.StructField("local_authority_name", T.StringType()),
    T.StructField("deadline", T.DateType()),
    T.StructField("applicant_name", T.StringType()),
    T.StructField("development_address", T.StringType()),
    T.StructField("development_description", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("search_term", T.StringType()),
])

MASTER_SCHEMA = T.StructType(
    CANONICAL9_SCHEMA.fields
    + [T.StructField(c, T.StringType()) for c in HUMAN_COLUMNS]
)

# Master as exported to text (CSV): every column is a string; dates come in
# several dialects and are parsed by ``functions.dates.parse_master_date``.
MASTER_TEXT_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in MASTER13])

CAPTURE_SCHEMA = T.StructType([
    T.StructField("source_id", T.StringType()),
    T.StructField("source_rank", T.IntegerType()),
    T.StructField("site_rank", T.IntegerType()),
    T.StructField("layout", T.StringType()),
    T.StructField("keyword", T.StringType()),
    T.StructField("keyword_rank", T.IntegerType()),
    T.StructField("list_pos", T.IntegerType()),
    T.StructField("page_no", T.IntegerType()),
    T.StructField("attempt", T.IntegerType()),
    T.StructField("fetched_on", T.DateType()),
    T.StructField("url", T.StringType()),
    T.StructField("html", T.StringType()),
])

# Display names used by the published sheet (columns A..M), fixed values.
DISPLAY_NAMES = {
    "file_number": "File Number",
    "received_date": "Received Date",
    "local_authority_name": "Local Authority Name",
    "deadline": "Deadline",
    "applicant_name": "Applicant Name",
    "development_address": "Development Address",
    "development_description": "Development Description",
    "url": "URL",
    "search_term": "Search Term",
    "comments": "Comments",
    "show_public": "Show Public",
    "announcement_sent": "Tweet Sent?",
    "draft_announcement": "Draft Tweet",
}

# ---------------------------------------------------------------- sources
# The listing sites, their collector order and rules.
# Collector (source_rank) order is the concatenation order of the combine step:
# 1 standard platform, 2 Kildare, 3 Dublin City, 4 Fingal, 5 Dun Laoghaire,
# 6 Wexford, 7 South Dublin, 8 national board (SID), 9 consultations.
STANDARD_SITES = [
    "http://www.eplanning.ie/CarlowCC/SearchExact/Description",
    "http://www.eplanning.ie/CavanCC/SearchExact/Description",
    "http://www.eplanning.ie/ClareCC/SearchExact/Description",
    "http://planning.corkcoco.ie/ePlan/SearchExact/Description",
    "http://planning.corkcity.ie/SearchExact/Description",
    "http://www.eplanning.ie/DonegalCC/SearchExact/Description",
    "https://geo.galwaycity.ie/ePlan5/SearchExact/Description",
    "http://www.eplanning.ie/GalwayCC/SearchExact/Description",
    "http://www.eplanning.ie/KerryCC/SearchExact/Description",
    "http://www.eplanning.ie/KilkennyCC/SearchExact/Description",
    "http://www.eplanning.ie/LaoisCC/SearchExact/Description",
    "http://www.eplanning.ie/LeitrimCC/SearchExact/Description",
    "https://www.eplanning.ie/LimerickCCC/SearchExact/Description",
    "http://www.eplanning.ie/LouthCC/SearchExact/Description",
    "http://www.eplanning.ie/LongfordCC/SearchExact/Description",
    "http://www.eplanning.ie/MayoCC/SearchExact/Description",
    "http://www.eplanning.ie/MeathCC/SearchExact/Description",
    "http://www.eplanning.ie/MonaghanCC/SearchExact/Description",
    "http://www.eplanning.ie/OffalyCC/SearchExact/Description",
    "http://www.eplanning.ie/RoscommonCC/SearchExact/Description",
    "http://www.eplanning.ie/SligoCC/SearchExact/Description",
    "http://www.eplanning.ie/TipperaryCC/SearchExact/Description",
    "http://www.eplanning.ie/WaterfordCCC/SearchExact/Description",
    "http://www.eplanning.ie/WestmeathCC/SearchExact/Description",
    "http://www.eplanning.ie/WicklowCC/SearchExact/Description",
]
AGILE_TEMPLATE = (
    "https://planning.agileapplications.ie/{council}/search-applications/results?"
    "criteria=%7B%22proposal%22:%22{keyword}%22,%22openApplications%22:%22false%22,"
    "%22registrationDateFrom%22:%22{from}%22,%22registrationDateTo%22:%22{to}%22%7D"
)
KILDARE_URL = "http://webgeo.kildarecoco.ie/planningenquiry"
WEXFORD_URL = "https://dms.wexfordcoco.ie/advanced.php"
SOUTH_DUBLIN_TEMPLATE = "http://www.sdublincoco.ie/Planning/Applications?p=1&prop={keyword}"
BOARD_TEMPLATE = "https://www.pleanala.ie/en-ie/lists/cases?list=I&year={year}"
BOARD_CASE_BASE = "https://www.pleanala.ie/en-ie/case/"
CONSULTATION_URL = (
    "https://www.gov.ie/en/search/?type=consultations"
    "&organisation=department-of-the-environment-climate-and-communications"
)
CONSULTATION_BASE = "https://www.gov.ie"

DEADLINE_DAYS = {"council": 32, "sid": 39, "consultation": 25}

# Date formats per layout (Spark patterns), for sources that declare none of
# their own.  Layouts whose source never declared a format get the explicit
# list below instead of inference.
DAY_FIRST = "d/M/yyyy"
LONG_MONTH = "d MMMM yyyy"
UNDECLARED_FORMATS = ["yyyy-MM-dd", "d MMM yyyy", "d/M/yyyy"]
LAYOUT_DATE_FORMATS = {
    "table": [DAY_FIRST],
    "grid5": [DAY_FIRST],
    "responsive7": UNDECLARED_FORMATS,
    "columns4": UNDECLARED_FORMATS,
    "deflist4": [DAY_FIRST],
    "cards6": [DAY_FIRST],
    "case1": [DAY_FIRST],
    "links5": [LONG_MONTH],
}

SOURCES_SCHEMA = T.StructType([
    T.StructField("source_id", T.StringType(), False),
    T.StructField("source_rank", T.IntegerType(), False),
    T.StructField("site_rank", T.IntegerType(), False),
    T.StructField("layout", T.StringType(), False),
    T.StructField("authority", T.StringType()),
    T.StructField("url_template", T.StringType(), False),
    T.StructField("keyword_search", T.BooleanType(), False),
    T.StructField("class", T.StringType(), False),
    T.StructField("deadline_days", T.IntegerType(), False),
    # tried in turn; NULL: the formats of the page's layout
    T.StructField("date_formats", T.ArrayType(T.StringType())),
])


def source_rows() -> list[tuple]:
    rows = []
    for i, link in enumerate(STANDARD_SITES, start=1):
        site = link.split("/")[-3] if "eplanning" in link else link.split("/")[2]
        rows.append((f"std:{site}", 1, i, "table", None, link, True, "council", 32))
    rows.append(("kildare", 2, 1, "grid5", None, KILDARE_URL, True, "council", 32))
    for rank, (council, authority) in enumerate([
        ("dublincity", "Dublin City Council"),
        ("fingal", "Fingal Co. Co."),
        ("dunlaoghaire", "Dun Laoghaire Co. Co."),
    ], start=3):
        rows.append((council, rank, 1, "responsive7", authority,
                     AGILE_TEMPLATE.replace("{council}", council), True, "council", 32))
    rows.append(("wexford", 6, 1, "columns4", "Wexford Co. Co.", WEXFORD_URL, True,
                 "council", 32))
    rows.append(("southdublin", 7, 1, "deflist4", "South Dublin Co. Co.",
                 SOUTH_DUBLIN_TEMPLATE, True, "council", 32))
    rows.append(("board", 8, 1, "cards6", "An Bord Pleanala - SID", BOARD_TEMPLATE,
                 False, "sid", 39))
    rows.append(("consultations", 9, 1, "links5", "Dept. Environment/Climate",
                 CONSULTATION_URL, False, "consultation", 25))
    return [(*r, None) for r in rows]


def sources_df(spark: SparkSession) -> DataFrame:
    """The 33-row ``sources`` dimension (small and fixed: safe to broadcast)."""
    return spark.createDataFrame(source_rows(), SOURCES_SCHEMA)
