"""Driver-table fixtures: notices and captured pages derived from ``orders``.

The driver's tables hold no listing pages, so the round-trip queries render
``orders`` into pages of each layout *with Spark* (grouping ten orders per
page), parse them back and compare with the plain projection in SQL.  Every
fixture covers the whole table; rules pick attributes, never row subsets.

Each Spark derivation below has a DuckDB twin in ``plans.queries``.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import text as X
from ..functions.cache import per_jvm
from ..operators.extract import TABLE_HEADERS
from ..schema import (AGILE_TEMPLATE, BOARD_TEMPLATE, CONSULTATION_URL, KILDARE_URL,
                      SOUTH_DUBLIN_TEMPLATE, STANDARD_SITES, WEXFORD_URL, source_rows)

# Fixed fixture parameters.
AS_OF = _dt.date(2001, 8, 1)  # the latest o_orderdate at every scale factor
ROWS_PER_PAGE = 10
PAGE_KEYWORDS = ["data centre", "gas", "tunnel"]
APP_KEYWORDS = ["data", "gas", "tunnel"]
LAYOUTS = ["table", "grid5", "responsive7", "columns4", "deflist4", "cards6", "case1", "links5"]
ORDERS_A_TASK = 50_000  # orders that one task renders (and parses)
COUNCILS = ["dublincity", "fingal", "dunlaoghaire"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---------------------------------------------------------------- notices
def apps(orders: DataFrame) -> DataFrame:
    """One notice per order: canonical9 + class + lineage."""
    c31 = F.col("o_custkey") % 31
    cls = F.when(c31 == 0, "sid").when(c31 == 1, "consultation").otherwise("council")
    days = F.when(cls == "sid", 39).when(cls == "consultation", 25).otherwise(32)
    k3 = F.col("o_orderkey") % 3
    received = F.col("o_orderdate").cast("date")
    return orders.select(
        F.col("o_orderkey").cast("string").alias("file_number"),
        received.alias("received_date"),
        F.concat(F.lit("Council "), F.lpad(c31.cast("string"), 2, "0")).alias("local_authority_name"),
        F.date_add(received, days).alias("deadline"),
        F.concat(F.lit("Customer "), F.col("o_custkey").cast("string")).alias("applicant_name"),
        F.when(c31 == 1, F.lit("N/A for DECC")).otherwise(F.col("o_orderpriority"))
        .alias("development_address"),
        F.col("o_orderstatus").alias("development_description"),
        F.concat(F.lit("http://www.example.ie/C"), c31.cast("string"),
                 F.lit("/SearchExact/Description")).alias("url"),
        F.when(k3 == 0, "data").when(k3 == 1, "gas").otherwise("tunnel").alias("search_term"),
        cls.alias("class"),
        F.when(cls == "council", 1).when(cls == "sid", 8).otherwise(9).alias("source_rank"),
        F.lit(0).alias("run_day"), (k3 + 1).cast("int").alias("keyword_rank"),
        F.lit(1).alias("site_rank"),
        F.floor(F.col("o_orderkey") / ROWS_PER_PAGE).cast("int").alias("page_no"),
        (F.col("o_orderkey") % ROWS_PER_PAGE).cast("int").alias("row_pos"),
        F.col("o_orderstatus"), F.col("o_orderpriority"), F.col("o_orderkey"),
    )


def fresh(orders: DataFrame) -> DataFrame:
    """Fresh capture: every notice, plus pending ones found again under 'gas'."""
    a = apps(orders)
    again = (a.where(F.col("o_orderstatus") == "P")
             .withColumn("search_term", F.lit("gas")).withColumn("keyword_rank", F.lit(2)))
    return a.unionByName(again)


def existing_master_text(orders: DataFrame) -> DataFrame:
    """Annotated master rows as exported text (three date dialects)."""
    a = apps(orders).where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))
    k3 = F.col("o_orderkey") % 3

    def dialect(c):
        return (F.when(k3 == 0, F.date_format(c, "yyyy-MM-dd"))
                .when(k3 == 1, F.date_format(c, "dd/MM/yyyy"))
                .otherwise(F.replace(F.date_format(c, "dd MMM yyyy"), F.lit("Sep"), F.lit("Sept"))))

    return a.select(
        "file_number", dialect(F.col("received_date")).alias("received_date"),
        "local_authority_name", dialect(F.col("deadline")).alias("deadline"),
        "applicant_name", "development_address", "development_description", "url",
        "search_term",
        F.concat(F.lit("note "), F.col("file_number")).alias("comments"),
        F.when(F.col("o_orderstatus") == "O", F.lit("Yes")).alias("show_public"),
        F.when(F.col("o_orderstatus") == "F", F.lit("Yes")).alias("announcement_sent"),
        F.lit(None).cast("string").alias("draft_announcement"),
    )


# ---------------------------------------------------------------- pages
def _esc(c: Column) -> Column:
    c = F.replace(c, F.lit("&"), F.lit("&amp;"))
    c = F.replace(c, F.lit("<"), F.lit("&lt;"))
    return F.replace(c, F.lit(">"), F.lit("&gt;"))


def _tag(tag: str, inner: Column, attrs: str = "") -> Column:
    return F.concat(F.lit(f"<{tag}{attrs}>"), inner, F.lit(f"</{tag}>"))


def order_fields(orders: DataFrame, layout: Column | str | None = None) -> DataFrame:
    """Per-order rendered fields plus page attributes (layout, source, keyword)."""
    page = F.floor(F.col("o_orderkey") / ROWS_PER_PAGE).cast("int")
    lay = F.lit(layout) if isinstance(layout, str) else (
        layout if layout is not None else F.element_at(F.array(*[F.lit(x) for x in LAYOUTS]),
                                                       (page % len(LAYOUTS) + 1).cast("int")))
    d = F.col("o_orderdate").cast("date")
    return orders.select(
        "o_orderkey", lay.alias("layout"), page.alias("page_no"),
        (F.col("o_orderkey") % ROWS_PER_PAGE).cast("int").alias("pos"),
        F.col("o_orderkey").cast("string").alias("f_file"),
        d.alias("f_date"),
        F.concat(F.lit("Customer "), F.col("o_custkey").cast("string")).alias("f_applicant"),
        F.concat(F.col("o_orderpriority"), F.lit(" Road & Yard")).alias("f_address"),
        F.concat(F.lit("Status "), F.col("o_orderstatus"), F.lit(" <works>")).alias("f_description"),
        F.concat(F.lit("Council "), F.lpad((F.col("o_custkey") % 31).cast("string"), 2, "0"))
        .alias("f_authority"),
        F.col("o_orderstatus").alias("f_status"),
    )


def render_tasks(orders: DataFrame) -> int:
    """Tasks that render ``orders``: one for each core, more as the table grows, so that a task's share does not."""
    return max(orders.sparkSession.sparkContext.defaultParallelism, -(-orders.count() // ORDERS_A_TASK))


@per_jvm
def _snippet() -> Column:
    """HTML of one record, by layout."""
    lay = F.col("layout")
    f = {k: _esc(F.col(f"f_{k}")) for k in ("file", "applicant", "address", "description",
                                             "authority", "status")}
    dmy = F.date_format("f_date", "d/M/yyyy")
    td = lambda c: _tag("td", c)
    table_row = _tag("tr", F.concat(td(f["file"]), td(f["status"]), td(F.lit("")), td(F.lit("")),
                                    td(F.lit("")), td(dmy), td(f["applicant"]), td(f["address"]),
                                    td(f["description"]), td(f["authority"])))
    grid_row = _tag("tr", F.concat(td(f["file"]), td(f["authority"]), td(f["applicant"]),
                                   td(f["address"]), td(dmy)))
    resp_row = _tag("tr", F.concat(td(f["file"]), td(f["description"]), td(f["address"]),
                                   td(F.date_format("f_date", "yyyy-MM-dd")), td(F.lit("")),
                                   td(F.lit("")), td(f["applicant"])))

    def col_div(width, c):
        return _tag("div", c, f' style="text-align: left; width: {width}px; white-space: normal;"')

    col_row = F.concat(col_div(75, f["file"]), col_div(65, F.date_format("f_date", "d MMM yyyy")),
                       col_div(190, f["applicant"]), col_div(275, f["address"]))
    dl_row = F.concat(
        _tag("h3", f["file"], ' class="responsiveheader"'),
        _tag("dl", F.concat(F.lit("<dt>Received</dt>"), _tag("dd", dmy),
                            F.lit("<dt>Decision</dt><dd>Pending</dd><dt>Applicant</dt>"),
                            _tag("dd", f["applicant"]), F.lit("<dt>Location</dt>"),
                            _tag("dd", f["address"]))))
    card = _tag("div", F.concat(
        F.lit('<a href="/en-ie/case/'), f["file"], F.lit('"><div>'),
        _tag("span", f["address"], ' class="title"'),
        _tag("ul", F.concat(_tag("li", f["applicant"]), F.lit("<li>Strategic Infrastructure</li>"))),
        _tag("span", F.concat(F.lit("Case reference:"), f["file"]), ' class="details"'),
        _tag("span", F.concat(F.lit("Due date:"), F.date_format(F.date_add("f_date", 60), "dd/MM/yyyy")),
             ' class="details"'),
        _tag("span", F.concat(F.lit("Description:"), f["description"]), ' class="details"'),
        _tag("span", F.concat(F.lit("Date lodged:"), F.date_format("f_date", "dd/MM/yyyy"),
                              F.lit(" 10:15")), ' class="details"'),
        F.lit('<span class="details">EIAR:No</span><span class="details">NIS:No</span>'),
        F.lit("</div></a>")), ' class="card"')
    case = F.concat(
        _tag("p", F.concat(f["file"], F.lit(": "), f["address"]), ' class="address"'),
        F.lit("<p>Lodged "), _tag("strong", F.concat(F.lit(" "), F.date_format("f_date", "dd/MM/yyyy"),
                                                      F.lit(" "))), F.lit("</p>"),
        _tag("ul", _tag("li", _tag("p", f["applicant"]))),
        _tag("p", f["description"], ' class="case-summary"'))
    para = F.concat(F.lit("Consultation;"), F.date_format("f_date", "d MMMM yyyy"), F.lit(";"),
                    F.when(F.col("f_status") == "F", F.lit(X.STRAY_ORGANISATION)).otherwise(F.lit("")),
                    F.lit("Department of the Environment;Open;Online"))
    link = _tag("li", F.concat(F.lit('<a href="/en/consultation/'), f["file"], F.lit('/">'),
                               f["description"], F.lit("</a>"), _tag("p", _esc(para))))
    return (F.when(lay == "table", table_row).when(lay == "grid5", grid_row)
            .when(lay == "responsive7", resp_row).when(lay == "columns4", col_row)
            .when(lay == "deflist4", dl_row).when(lay == "cards6", card)
            .when(lay == "case1", case).when(lay == "links5", link))


@per_jvm
def _page_html() -> Column:
    body, n_rows = F.col("body"), F.col("n_rows")
    lay = F.col("layout")
    head = F.lit("<!DOCTYPE html><html><head><title>Results</title></head><body>")
    tail = F.lit("</body></html>")
    th = F.concat(*[F.lit(f"<th>{h}</th>") for h in TABLE_HEADERS])
    resp_head = F.concat(F.lit("<tr>"), *[F.lit(f"<td>H{i}</td>") for i in range(8)], F.lit("</tr>"))
    decoys = F.lit("".join(f"<ul><li><a href=\"/nav{i}\">Menu {i}</a></li></ul>" for i in range(6)))
    inner = (
        F.when(lay == "table", F.concat(F.lit('<table class="table"><thead><tr>'), th,
                                        F.lit("</tr></thead><tbody>"), body,
                                        F.lit("</tbody></table>")))
        .when(lay == "grid5", F.concat(F.lit('<div id="plGrid"><table>'), body,
                                       F.lit("</table></div>")))
        .when(lay == "responsive7", F.concat(F.lit("<table>"), resp_head, body, resp_head, body,
                                             F.lit("</table>")))
        .when(lay == "columns4", F.concat(F.lit('<div id="grd">'), body, F.lit("</div>")))
        .when(lay == "deflist4", F.concat(body, F.lit('<ul><li class="totals">Page 1 of 1 ('),
                                          n_rows.cast("string"), F.lit(" results)</li></ul>")))
        .when(lay == "cards6", F.concat(F.lit("<h2>Weekly list</h2>"), body))
        .when(lay == "case1", body)
        .when(lay == "links5", F.concat(decoys, F.lit("<ul>"), body, F.lit("</ul>"),
                                        F.lit('<div class="pagination">1 / 1</div>'))))
    return F.concat(head, inner, tail)


@per_jvm
def _capture_source(as_of) -> tuple[Column, Column]:
    """(source_id, capture url) for a page, by layout and page number."""
    lay, page = F.col("layout"), F.col("page_no")
    kw = F.col("keyword")
    std_ids = [r[0] for r in source_rows() if r[3] == "table"]
    std_idx = (page % len(STANDARD_SITES) + 1).cast("int")
    council_idx = (page % len(COUNCILS) + 1).cast("int")
    t = D.as_of_texts(as_of)
    agile = F.replace(F.replace(F.replace(F.replace(
        F.lit(AGILE_TEMPLATE), F.lit("{council}"), F.element_at(F.array(*map(F.lit, COUNCILS)), council_idx)),
        F.lit("{keyword}"), kw), F.lit("{from}"), t["from_iso"]), F.lit("{to}"), t["to_iso"])
    sid = (F.when(lay == "table", F.element_at(F.array(*map(F.lit, std_ids)), std_idx))
           .when(lay == "grid5", F.lit("kildare"))
           .when(lay == "responsive7", F.element_at(F.array(*map(F.lit, COUNCILS)), council_idx))
           .when(lay == "columns4", F.lit("wexford"))
           .when(lay == "deflist4", F.lit("southdublin"))
           .when(lay.isin("cards6", "case1"), F.lit("board"))
           .otherwise(F.lit("consultations")))
    # a page's source is data, also where all pages of a query have the same one
    sid = F.when(page.isNotNull(), sid)
    url = (F.when(lay == "table", F.element_at(F.array(*map(F.lit, STANDARD_SITES)), std_idx))
           .when(lay == "grid5", F.lit(KILDARE_URL))
           .when(lay == "responsive7", agile)
           .when(lay == "columns4", F.lit(WEXFORD_URL))
           .when(lay == "deflist4", F.replace(F.lit(SOUTH_DUBLIN_TEMPLATE), F.lit("{keyword}"), kw))
           .when(lay.isin("cards6", "case1"),
                 F.replace(F.lit(BOARD_TEMPLATE), F.lit("{year}"), F.year(F.lit(as_of)).cast("string")))
           .otherwise(F.lit(CONSULTATION_URL)))
    return sid, url


@per_jvm
def _source_ranks() -> dict[str, Column]:
    """source_id -> (source_rank, site_rank) from the fixed source list, as map lookups."""
    rank, site = [], []
    for r in source_rows():
        rank += [F.lit(r[0]), F.lit(r[1])]
        site += [F.lit(r[0]), F.lit(r[2])]
    return {"source_rank": F.element_at(F.create_map(*rank), F.col("source_id")).cast("int"),
            "site_rank": F.element_at(F.create_map(*site), F.col("source_id")).cast("int")}


def render_captures(orders: DataFrame, layout: str | None = None, as_of=AS_OF) -> DataFrame:
    """Captured pages (capture schema) rendered from ``orders`` in Spark.

    Ten consecutive orders make a page (single-case pages hold one order);
    the group is bounded, so ``collect_list`` per page is safe at any scale.
    """
    rows = order_fields(orders, layout)
    single = F.col("layout") == "case1"
    rows = rows.withColumn("page_no", F.when(single, F.col("o_orderkey").cast("int"))
                           .otherwise(F.col("page_no")))
    rows = rows.withColumn("snippet", _snippet())
    # Pages are parsed right after rendering; with an explicit partition count
    # AQE keeps them spread over all cores instead of folding the (small but
    # CPU-heavy) page set into one task.
    pages = (rows.repartition(render_tasks(orders), "page_no").groupBy("layout", "page_no")
             .agg(F.sort_array(F.collect_list(F.struct("pos", "snippet"))).alias("items")))
    body = F.array_join(F.transform("items", lambda s: s["snippet"]), "")
    kw_idx = (F.col("page_no") % len(PAGE_KEYWORDS) + 1).cast("int")
    keyed = F.col("layout").isin("table", "grid5", "responsive7", "columns4", "deflist4")
    pages = pages.select(
        "layout", "page_no", F.size("items").alias("n_rows"), body.alias("body"),
        F.when(keyed, F.element_at(F.array(*map(F.lit, PAGE_KEYWORDS)), kw_idx)).alias("keyword"),
        F.when(keyed, kw_idx).otherwise(F.lit(0)).cast("int").alias("keyword_rank"))
    sid, url = _capture_source(as_of)
    ranks = _source_ranks()
    pages = pages.withColumn("source_id", sid).withColumn("url", url).withColumns(ranks)
    return pages.select(
        "source_id", "source_rank", "site_rank", "layout", "keyword", "keyword_rank",
        # single-case pages are numbered by order key: a list of their own
        F.when(F.col("layout") == "case1", 1).otherwise(0).alias("list_pos"),
        "page_no", F.lit(1).alias("attempt"),
        F.lit(as_of).alias("fetched_on"), "url",
        _page_html().alias("html"))


# ---------------------------------------------------------------- faulty pages, runs
# Rules of the faulty case pages, by o_custkey % 5; the remaining orders get a sound page.
BAD_DATE, NO_RECORDS, NO_RESULTS, UNKNOWN_SOURCE = range(4)
BAD_DATE_TEXT = "32/13/2021"


def case_pages(orders: DataFrame, party: str = "Ann", fetched_on=AS_OF) -> DataFrame:
    """One single-case page per order, some with faults, scripts and hidden markers."""
    c = F.col("o_custkey") % 5
    number = F.col("o_orderkey").cast("string")
    date = F.when(c == BAD_DATE, F.lit(BAD_DATE_TEXT)).otherwise(F.date_format("o_orderdate", "dd/MM/yyyy"))
    case = F.concat(
        F.lit("<ul class='menu'><li>Home</li></ul><p class='address'>F"), number, F.lit(": Main St</p><p><strong>"),
        date, F.lit(f"</strong></p><ul><li><p>{party}</p></li></ul><p class='case-summary'>Works</p>"))
    case = F.when(c == UNKNOWN_SOURCE, F.replace(case, F.lit("'"), F.lit('"'))).otherwise(case)
    hidden = '<div id="no_results" style="display: none">No results found</div>'
    body = (F.when(c == NO_RECORDS, F.lit("<p>Moved</p>" + hidden))
            .when(c == NO_RESULTS, F.lit("<p>No results found</p>"))
            .otherwise(F.concat(F.lit(hidden + '<script>var a = "<li><p>x</p>";</script><!-- <p> -->'), case)))
    # Orders are dealt first: a table file has fewer splits than there are cores, and parsing follows the splits.
    dealt = orders.select("o_orderkey", "o_custkey", "o_orderdate").repartition(render_tasks(orders), "o_orderkey")
    return dealt.select(
        F.when(c == UNKNOWN_SOURCE, "nowhere").otherwise("board").alias("source_id"),
        F.lit(1).alias("source_rank"), F.lit(1).alias("site_rank"), F.lit("case1").alias("layout"),
        F.lit(None).cast("string").alias("keyword"), F.lit(0).alias("keyword_rank"), F.lit(1).alias("list_pos"),
        F.lit(None).cast("int").alias("page_no"), F.lit(1).alias("attempt"), F.lit(fetched_on).alias("fetched_on"),
        F.concat(F.lit("https://example.org/case/"), number).alias("url"),
        F.concat(F.lit("<html><body>"), body, F.lit("</body></html>")).alias("html"))


def tried_pages(orders: DataFrame, as_of=AS_OF) -> DataFrame:
    """Single-case pages, one per ten orders: retried ones, equal attempts, pages without a number, two runs.

    By page p: every third has no number; every fifth has a capture without an
    attempt; even ones were tried again, twice with the same attempt; every
    fourth was captured in a run of the week before, too.
    """
    p = orders.select(F.floor(F.col("o_orderkey") / ROWS_PER_PAGE).cast("int").alias("p")).distinct()
    early, run = as_of - _dt.timedelta(days=7), as_of
    tries = F.array(*[F.struct(F.lit(d).alias("fetched_on"), F.lit(a).cast("int").alias("attempt"),
                               F.lit(who).alias("who"), F.lit(every).alias("every"))
                      for d, a, who, every in ((run, 1, "first", 1), (run, 2, "again", 2), (run, 2, "equal", 2),
                                               (run, None, "unknown", 5), (early, 1, "early", 4))])
    rows = p.select("p", F.inline(tries)).where(F.col("p") % F.col("every") == 0)
    number = F.col("p").cast("string")
    html = F.concat(F.lit('<html><body><p class="address">F'), number, F.lit(": Main St</p><p><strong>01/07/2001</strong></p>"
                    "<ul><li><p>"), F.col("who"), F.lit('</p></li></ul><p class="case-summary">Works</p></body></html>'))
    return rows.select(
        F.lit("board").alias("source_id"), F.lit(8).alias("source_rank"), F.lit(1).alias("site_rank"),
        F.lit("case1").alias("layout"), F.lit(None).cast("string").alias("keyword"), F.lit(0).alias("keyword_rank"),
        F.lit(1).alias("list_pos"), F.when(F.col("p") % 3 != 0, F.col("p")).alias("page_no"), "attempt", "fetched_on",
        F.concat(F.lit("https://example.org/case/"), number).alias("url"), html.alias("html"))


COUNTED_LAST = 42  # what every counted page promises


def counted_pages(orders: DataFrame) -> DataFrame:
    """Definition-list pages of 31 searches with their counters: some captured twice, some never."""
    c31 = (F.col("o_custkey") % 31).cast("int")
    no = (F.floor(F.col("o_orderkey") / ROWS_PER_PAGE) % 40 + 1).cast("int")
    pages = orders.select(c31.alias("c"), no.alias("page_no")).distinct().where((F.col("page_no") * 7 + F.col("c")) % 5 != 0)
    twice = F.when(F.col("page_no") % 4 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    label = F.concat(F.lit("Page "), F.col("page_no").cast("string"), F.lit(f" of {COUNTED_LAST} (2,090 results)"))
    html = F.concat(F.lit('<html><body><h3 class="responsiveheader">S1</h3><dl><dd>1/7/2001</dd><dd>Open</dd><dd>Ann</dd>'
                          '<dd>Main St</dd></dl><ul><li class="totals">'), label, F.lit("</li></ul></body></html>"))
    return pages.select(
        F.lit("southdublin").alias("source_id"), F.lit(7).alias("source_rank"), F.lit(1).alias("site_rank"),
        F.lit("deflist4").alias("layout"), F.concat(F.lit("search "), F.col("c").cast("string")).alias("keyword"),
        F.col("c").alias("keyword_rank"), F.lit(0).alias("list_pos"), "page_no", F.explode(twice).alias("attempt"),
        F.lit(AS_OF).alias("fetched_on"), F.lit(SOUTH_DUBLIN_TEMPLATE).alias("url"), html.alias("html"))


def marked_pages(pages: DataFrame) -> DataFrame:
    """Raw pages as captures; by page_id: a shown marker, one hidden by its parent, no page at all."""
    hidden = '<div style="display: none"><div><p>No results found</p></div></div>'
    shown = '<div hidden><div>menu</div></div><div><p>No results found</p></div>'
    k = F.col("page_id") % 3
    html = F.replace(F.col("html"), F.lit("</body>"), F.concat(
        F.when(k == 0, F.lit(hidden)).when(k == 1, F.lit(shown)).otherwise(F.lit("")), F.lit("</body>")))
    return raw_captures(pages, F.when(F.col("page_id") % 7 != 0, html))


def raw_captures(pages: DataFrame, html: Column | None = None) -> DataFrame:
    """The raw pages as captures of link lists, one source per host."""
    return pages.select(
        F.regexp_extract("url", r"^https?://([^/?#]+)", 1).alias("source_id"), F.lit(9).alias("source_rank"),
        F.lit(1).alias("site_rank"), F.lit("links5").alias("layout"), F.lit(None).cast("string").alias("keyword"),
        F.lit(0).alias("keyword_rank"), F.lit(0).alias("list_pos"), F.col("page_id").cast("int").alias("page_no"),
        F.lit(1).alias("attempt"), F.lit(AS_OF).alias("fetched_on"), "url",
        (F.col("html") if html is None else html).alias("html"))
