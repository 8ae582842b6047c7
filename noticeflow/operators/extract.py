"""Record extraction from captured pages (EXT-1..EXT-8, EXT-12).

Physical shape, whatever the mix of layouts:

1. ``parse_pages`` turns each page into named string lists (``fields``) with
   native regexes and read their character references natively; only pages
   the regexes cannot be trusted with (unbalanced tags, odd attributes,
   references without a semicolon) go through an Arrow-batched Python
   reader; the HTML is dropped right away;
   (scripts, styles and comments are cut in the JVM before either reader);
2. ``page_records`` turns the lists into records, ``ARRAY<ARRAY<STRING>>`` in
   a common field order, with native strides, slices and zips;
3. one ``posexplode_outer`` and one projection give raw canonical rows.

No union of per-layout branches: every page is read exactly once.
"""

from __future__ import annotations

import json
import re
from html.entities import html5 as _html5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import html as _html
from ..functions import text as X
from ..functions.cache import per_jvm
from ..functions.html import extract_layout
from .audit import shows_no_results

try:  # ship the page reader with the task closure, so executors need no install
    from pyspark import cloudpickle as _cp
    _cp.register_pickle_by_value(_html)
    _cp.register_pickle_by_value(__import__(__name__, fromlist=["_"]))
except Exception:  # pragma: no cover - older cloudpickle: the package must be installed
    pass

# Every named list any layout produces; a layout leaves the others NULL.  A
# struct (not a map) so that reading one list never drags the others along.
FIELD_NAMES = ["headers", "cells", "file_no", "received", "applicant", "address", "dd",
               "totals", "title", "details", "party", "strong", "summary", "anchor", "href",
               "para", "counter"]
FIELDS_TYPE = T.StructType([T.StructField(n, T.ArrayType(T.StringType())) for n in FIELD_NAMES])

# Record vector positions shared by every layout (1-based for element_at).
R_FILE, R_RECEIVED, R_AUTHORITY, R_APPLICANT, R_ADDRESS, R_DESCRIPTION, R_LINK = range(1, 8)

# Header names of the standard platform's result table.
TABLE_HEADERS = [
    "File Number", "Application Status", "Decision Due Date", "Decision Date",
    "Decision Code", "Received Date", "Applicant Name", "Development Address",
    "Development Description", "Local Authority Name",
]
# Record widths per layout.
WIDTH = {"grid5": 5, "responsive7": 7, "deflist4": 4, "cards6": 6, "links5": 5}
RESPONSIVE_HEADER_CELLS = 8
CONSULTATION_DATE_ITEM = 2  # 1-based: second ';' item is the date


# Columns of a parsed page that its records and reports do not carry on.
PAGE_ONLY = ("fields", "records", "page_label", "page_ok", "parse_status", "parse_error", "tolerant", "no_results")
NO_RECORDS = "no records and no sign of an empty result"


# ---------------------------------------------------------------- stage 1
# Scripts, styles or comments begin; one literal start is found faster than alternatives under (?i).
_HIDDEN = "<(?:[sS][cC][rR][iI][pP][tT]|[sS][tT][yY][lL][eE]|!--)"


def visible_html(html: Column) -> Column:
    """The page without scripts, styles and comments, whose text may look like tags."""
    hidden = r"(?is)<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>|<!--.*?-->"
    return F.when(html.rlike(_HIDDEN), F.regexp_replace(html, hidden, "")).otherwise(html)


# Native path: regular expressions evaluated in the JVM (codegen, no Python).
def _attr_re(attr: str, value: str) -> str:
    return r"\b" + attr + r'\s*=\s*"(?:[^"]*\s)?' + value + r'(?:\s[^"]*)?"'


def _inner(src: Column, tag: str, attr: str | None = None, value: str | None = None) -> Column:
    """Inner HTML of every ``<tag>`` (optionally with a class) in document order."""
    cond = f"[^>]*{_attr_re(attr, value)}" if attr else ""
    return F.regexp_extract_all(src, F.lit(rf"(?is)<{tag}\b{cond}[^>]*>(.*?)</{tag}\s*>"), 1)


# A paragraph ends at its end tag or, without one, where the next paragraph or
# block begins or what holds it ends.
_P_END = (r"(?=</p\s*>|<p[\s>/]|</?(?:" + "|".join(sorted(_html.BLOCK_CLOSES_P)) + r")[\s>/]"
          r"|</(?:li|td|th|tr|dd|dt|main|header|footer|aside|body|html)\s*>|\z)")


def _paragraphs(attr: str | None = None, value: str | None = None) -> str:
    cond = f"[^>]*{_attr_re(attr, value)}" if attr else ""
    return rf"(?is)<p(?=[\s>/]){cond}[^>]*>(.*?){_P_END}"


def _inner_p(src: Column, attr: str | None = None, value: str | None = None) -> Column:
    return F.regexp_extract_all(src, F.lit(_paragraphs(attr, value)), 1)


def _odd_paragraph(html: Column) -> Column:
    """A paragraph that holds the start of a list item or cell, which does not end it."""
    return F.exists(_inner_p(html), lambda p: p.rlike(r"(?i)<(?:li|td|th|body)[\s>/]"))


def _inner_style(src: Column, style: str) -> Column:
    pat = r"(?is)<div\b[^>]*\bstyle\s*=\s*" + '"' + re.escape(style) + '"' + r"[^>]*>(.*?)</div\s*>"
    return F.regexp_extract_all(src, F.lit(pat), 1)


# Character references, as browsers read them: named ones by the standard
# library's table, in the order of their characters so that everyday ones are
# found first.
_NAMED = {n[:-1]: ch for n, ch in sorted(_html5.items(), key=lambda kv: (len(kv[1]), kv[1], kv[0])) if n.endswith(";")}
_OPEN_NAMES = sorted(n for n in _html5 if not n.endswith(";"))  # read without a semicolon, too
_NAME = "[A-Za-z][A-Za-z0-9]*"
# What numbers 128 to 159 stand for: the Windows-1252 character, where there is one.
_WINDOWS = "".join(bytes([n]).decode("cp1252", errors="ignore") or chr(n) for n in range(128, 160))


def page_entities(html: Column) -> Column:
    """Map of the names of a page's references (with semicolon) to their characters, NULL where unknown.

    The large table is looked up once for each distinct name of a page; the
    texts of the page only see this small map.
    """
    names = F.array_distinct(F.regexp_extract_all(html, F.lit(f"&({_NAME});"), 1))
    table = F.from_json(F.lit(json.dumps(_NAMED)), "map<string,string>")
    return F.map_from_arrays(names, F.transform(names, lambda n: F.try_element_at(table, n)))


def _character(code: Column) -> Column:
    """The character of a numeric reference; noncharacters and most controls give nothing."""
    odd = ((code < 9) | ((code > 13) & (code < 32)) | (code == 11) | (code == 127) | code.between(0xFDD0, 0xFDEF)
           | (code.bitwiseAND(F.lit(0xFFFE)) == 0xFFFE))
    return (F.when((code == 0) | code.between(0xD800, 0xDFFF) | (code > 0x10FFFF), F.lit("\ufffd"))
            .when(code.between(128, 159), F.substring(F.lit(_WINDOWS), code.cast("int") - 127, F.lit(1)))
            .when(odd, F.lit(""))
            .otherwise(F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")))


def unescape(c: Column) -> Column:
    """Text with its character references read (``_entities``: the page's names)."""
    def read(part: Column) -> Column:
        ref = F.regexp_extract(part, f"^(#[0-9]{{1,7}}|#[xX][0-9a-fA-F]{{1,6}}|{_NAME});", 1)
        number = (F.when(ref.rlike("^#[0-9]"), F.substring(ref, 2, 7).try_cast("bigint"))
                  .when(ref.rlike("^#[xX]"), F.conv(F.substring(ref, 3, 6), 16, 10).try_cast("bigint")))
        got = F.when(number.isNotNull(), _character(number)).otherwise(F.try_element_at(F.col("_entities"), ref))
        return F.when((ref == "") | got.isNull(), F.concat(F.lit("&"), part)).otherwise(
            F.concat(got, F.substr(part, F.length(ref) + 2)))

    def quick(part: Column) -> Column:
        """A name of the page and its semicolon need no expression; anything else is read in full."""
        name = F.substring_index(part, ";", 1)
        got = F.when(F.contains(part, F.lit(";")), F.try_element_at(F.col("_entities"), name))
        return F.coalesce(F.concat(got, F.substr(part, F.length(name) + 2)), read(part))

    parts = F.split(c, "&")
    rest = F.transform(F.slice(parts, 2, F.greatest(F.size(parts), F.lit(1))), quick)
    return F.when(F.contains(c, F.lit("&")), F.concat(F.get(parts, F.lit(0)), F.array_join(rest, ""))).otherwise(c)


def odd_references(html: Column) -> Column:
    """References that do not end in a semicolon, or only begin with a known name."""
    number = html.rlike("&#(?:[0-9]+(?![0-9;])|[xX][0-9a-fA-F]+(?![0-9a-fA-F;])|[0-9]{8}|[xX][0-9a-fA-F]{7})")
    names = F.array_distinct(F.regexp_extract_all(html, F.lit(f"&({_NAME};?)"), 1))
    begins = "^(?:" + "|".join(_OPEN_NAMES) + ")"
    odd = F.exists(names, lambda n: n.rlike(begins) & (~n.endswith(";") | F.try_element_at(
        F.col("_entities"), F.regexp_replace(n, ";$", "")).isNull()))
    return html.contains("&") & (number | odd)


def text_strip(c: Column) -> Column:
    """Text of an element, each text piece stripped and joined with ''.

    Plain cells (no tag, entity or outer whitespace) skip the cleanup passes.
    """
    full = X.py_strip(unescape(F.regexp_replace(c, r"(?s)\s*<[^>]*>\s*", "")))
    return F.when(c.rlike(r"[<&]|^\s|\s$"), full).otherwise(c)


def text_raw(c: Column) -> Column:
    """Text of an element as is (tags removed, entities decoded)."""
    full = unescape(F.regexp_replace(c, r"(?s)<[^>]*>", ""))
    return F.when(c.rlike(r"[<&]"), full).otherwise(c)


def text_table(c: Column) -> Column:
    """Table-cell text: tags dropped, whitespace runs collapsed, stripped
    (the result-table reader's rule, unlike the piecewise strip above)."""
    full = X.py_strip(F.regexp_replace(text_raw(c), r"[\r\n]+|\s{2,}", " "))
    return F.when(c.rlike(r"[<&\r\n]|\s\s|^\s|\s$"), full).otherwise(c)


def _texts(arr: Column, strip: bool = True) -> Column:
    return F.transform(arr, text_strip if strip else text_raw)


def _table_texts(arr: Column) -> Column:
    return F.transform(arr, text_table)


def _first(arr: Column) -> Column:
    return F.slice(arr, 1, 1)


def _fmap(**named: Column) -> Column:
    return F.struct(*[(named[n] if n in named else F.lit(None).cast("array<string>")).alias(n)
                      for n in FIELD_NAMES])


def _is_list_page(layout: Column, html: Column) -> Column:
    return layout.isin("cards6", "case1") & html.rlike(r"(?i)<h2\b")


def native_fields(layout: Column, html: Column) -> Column:
    """The same named lists as the tolerant reader, from JVM regexes."""
    table_re = r"(?is)<table\b[^>]*" + _attr_re("class", "table") + r"[^>]*>(.*?)</table\s*>"
    table = F.regexp_extract(html, table_re, 1)
    title_re = r"(?is)<span\b[^>]*" + _attr_re("class", "title")
    cards = F.filter(_inner(html, "a"), lambda b: b.rlike(title_re))
    party = F.transform(cards, lambda b: X.py_strip(text_raw(
        F.regexp_extract(b, r"(?is)<ul\b[^>]*>.*?<li\b[^>]*>(.*?)</li\s*>", 1))))
    with_p = F.filter(_inner(html, "li"), lambda b: b.rlike(r"(?i)<p[\s>]"))
    li_p = F.regexp_extract(F.coalesce(F.get(with_p, F.lit(0)), F.lit("")), _paragraphs(), 1)
    uls = _inner(html, "ul")
    lst = F.coalesce(F.try_element_at(uls, F.lit(_html.CONSULTATION_LIST_INDEX + 1)), F.lit(""))
    has_list = F.size(uls) > _html.CONSULTATION_LIST_INDEX
    empty = F.array().cast("array<string>")
    href_re = r'(?is)<a\b[^>]*\bhref\s*=\s*"([^"]*)"[^>]*>.*?</a\s*>'
    return (
        F.when(layout == "table", _fmap(headers=_table_texts(_inner(table, "th")),
                                        cells=_table_texts(_inner(table, "td"))))
        .when(layout.isin("grid5", "responsive7"), _fmap(cells=_texts(_inner(html, "td"))))
        .when(layout == "columns4", _fmap(**{
            name: _texts(_inner_style(html, style)) for name, style in _html.COLUMN_STYLES.items()}))
        .when(layout == "deflist4", _fmap(
            file_no=_texts(_inner(html, "h3", "class", "responsiveheader")),
            dd=_texts(_inner(html, "dd")),
            totals=_texts(_first(_inner(html, "li", "class", "totals")))))
        .when(_is_list_page(layout, html), _fmap(
            title=_texts(_inner(html, "span", "class", "title")),
            details=_texts(_inner(html, "span", "class", "details")), party=party))
        .when(layout.isin("cards6", "case1"), _fmap(
            address=_texts(_first(_inner_p(html, "class", "address")), False),
            strong=_texts(_first(_inner(html, "strong")), False),
            summary=_texts(_first(_inner_p(html, "class", "case-summary")), False),
            party=F.when(li_p != "", F.array(text_raw(li_p))).otherwise(empty)))
        .when(layout == "links5", _fmap(
            anchor=F.when(has_list, _texts(_inner(lst, "a"), False)).otherwise(empty),
            href=F.when(has_list, F.transform(F.regexp_extract_all(lst, F.lit(href_re), 1), unescape)).otherwise(empty),
            para=F.when(has_list, _texts(_inner_p(lst), False)).otherwise(empty),
            counter=_texts(_first(_inner(html, "div", "class", "pagination")))))
    )


# Tags that must open and close in turn for the regex path to be trusted.
FLAT_TAGS = {
    "table": ["table", "th", "td"], "grid5": ["td"], "responsive7": ["td"],
    "columns4": [], "deflist4": ["dd", "h3", "li"], "cards6": ["span", "li", "a", "ul"],
    "case1": ["span", "li", "a", "ul", "strong"], "links5": ["ul", "a", "li"],
}
PARAGRAPH_LAYOUTS = ["cards6", "case1", "links5"]


def _count(html: Column, pattern: str) -> Column:
    return F.regexp_count(html, F.lit(pattern))


def _ci(tag: str) -> str:
    """Case-insensitive tag name as character classes (faster than the (?i) flag)."""
    return "".join(f"[{ch.lower()}{ch.upper()}]" for ch in tag)


def _uneven(html: Column, tag: str) -> Column:
    """Elements of this tag nested in each other, or not closed."""
    marks = F.regexp_extract_all(html, F.lit(rf"(</?){_ci(tag)}[\s>/]"), 1)
    return F.replace(F.array_join(marks, ""), F.lit("<</"), F.lit("")) != ""


def _uneven_columns(html: Column) -> Column:
    """Column pages wrap everything in ``div``: only those inside a column, or not closed, matter."""
    styles = "|".join(re.escape(s) for s in _html.COLUMN_STYLES.values())
    inner = F.regexp_extract_all(
        html, F.lit(rf'(?is)<div\b[^>]*\bstyle\s*=\s*"(?:{styles})"[^>]*>(.*?)</div\s*>'), 1)
    return (F.exists(inner, lambda s: s.rlike("(?i)<div"))
            | (_count(html, rf"<{_ci('div')}[\s>/]") != _count(html, rf"</{_ci('div')}\s*>")))


def needs_tolerant(layout: Column, html: Column) -> Column:
    """Pages the regex path cannot be sure about go to the Python reader: the
    layout's tags nested in themselves or not closed, attributes without double
    quotes or with '>' in their value, references without a semicolon, and
    scripts, styles or comments that do not end."""
    odd_entity = odd_references(html)
    hidden = html.rlike(_HIDDEN)
    odd_attribute = (html.rlike(r"(?i)<[a-z][^<>]*\s(?:class|style|href)\s*=\s*[^\s\"]")
                     | html.rlike(r"=\s*+(?:\"[^\">]*+>|'[^'>]*+>)"))
    uneven = F.when(layout == "columns4", _uneven_columns(html))
    for lay, tags in FLAT_TAGS.items():
        u = F.lit(False)
        for t in tags:
            u = u | _uneven(html, t)
        if lay in PARAGRAPH_LAYOUTS:
            u = u | _odd_paragraph(html)
        uneven = uneven.when(layout == lay, u)
    return html.isNotNull() & (odd_entity | hidden | odd_attribute | uneven.otherwise(F.lit(False)))


# Tolerant path: stdlib tree reader, Arrow-batched, fed only the flagged pages.
_TOLERANT_TYPE = T.StructType([
    T.StructField("detected_layout", T.StringType()),
    T.StructField("parse_status", T.StringType()),
    T.StructField("parse_error", T.StringType()),
    T.StructField("fields", FIELDS_TYPE),
])


def _tolerant(layout, html):
    if html is None:
        return None
    try:
        got, named = extract_layout(layout, html)
        return {"detected_layout": got, "parse_status": "ok", "parse_error": None,
                "fields": {n: named.get(n) for n in FIELD_NAMES}}
    except Exception as exc:  # one bad page must not stop the job
        return {"detected_layout": layout, "parse_status": "error",
                "parse_error": f"{type(exc).__name__}: {exc}", "fields": None}


tolerant_reader = F.udf(_tolerant, _TOLERANT_TYPE, useArrow=True)


def parse_pages(captures: DataFrame, native: bool = True) -> DataFrame:
    """Page HTML -> ``fields STRUCT<name: ARRAY<STRING>, ...>`` (+ layout, status).

    Most pages are read by native regexes; only flagged pages carry their
    HTML into the Python reader (the other rows send NULL), so the Python
    stage moves almost no data.  ``native=False`` sends every page to the
    Python reader (used by tests to compare both paths).
    """
    e = _parse_exprs(native)
    keep = [c for c in captures.columns if c != "html"]
    flagged = (captures.withColumn("html", visible_html(F.col("html")))
               .withColumn("_entities", e["entities"]).withColumn("_tolerant", e["flag"]))
    # The native parse runs below the Python stage and the HTML is dropped
    # there: the Arrow UDF node buffers its input rows, and only flagged
    # pages still carry their HTML (``_html``) into it.
    native = flagged.select(*keep, "_tolerant", e["no_results"].alias("no_results"), e["detected"].alias("_detected"),
                            e["fast"].alias("_fast"), e["slow_input"].alias("_html"))
    both = native.select(*keep, "_tolerant", "no_results", "_detected", "_fast",
                         F.col("_fast").isNotNull().alias("_native_ok"),
                         e["slow"].alias("_slow"))
    return both.select(*keep, *e["final"], "no_results")


@per_jvm
def _parse_exprs(native: bool) -> dict:
    lay, html = F.col("layout"), F.col("html")
    return {
        "entities": page_entities(html),
        "flag": needs_tolerant(lay, html) if native else html.isNotNull(),
        "no_results": F.coalesce(shows_no_results(html), F.lit(False)),
        "slow_input": F.when(F.col("_tolerant"), html),
        "slow": tolerant_reader(F.col("layout"), F.col("_html")),
        "detected": (F.when(_is_list_page(lay, html), F.lit("cards6"))
                     .when(lay.isin("cards6", "case1"), F.lit("case1")).otherwise(lay)),
        "fast": F.when(~F.col("_tolerant") & html.isNotNull(), native_fields(lay, html)),
        "final": [
            F.coalesce(F.col("_slow.detected_layout"), F.col("_detected")).alias("detected_layout"),
            F.when(F.col("_native_ok"), F.lit("ok"))
            .otherwise(F.coalesce(F.col("_slow.parse_status"), F.lit("error"))).alias("parse_status"),
            F.col("_slow.parse_error").alias("parse_error"),
            F.coalesce(F.col("_slow.fields"), F.col("_fast")).alias("fields"),
            F.col("_tolerant").alias("tolerant"),
        ],
    }


# ---------------------------------------------------------------- stage 2
def _f(name: str) -> Column:
    return F.coalesce(F.col("fields").getField(name), F.array().cast("array<string>"))


def _get(arr: Column, i) -> Column:
    """1-based safe element access (NULL when out of range or index <= 0)."""
    idx = F.lit(i) if isinstance(i, int) else i
    return F.when(idx > 0, F.try_element_at(arr, idx))


def stride(arr: Column, width) -> Column:
    """Flat list -> fixed-width records; a trailing partial record is kept (EXT-2)."""
    w = F.lit(width) if isinstance(width, int) else width
    n = F.size(arr)
    return F.when((n > 0) & (w > 0), F.transform(
        F.sequence(F.lit(0), F.ceil(n / w).cast("int") - 1),
        lambda i: F.slice(arr, i * w + 1, w),
    )).otherwise(F.array().cast("array<array<string>>"))


def _rec(*items) -> Column:
    return F.array(*[F.lit(None).cast("string") if x is None else x for x in items])


def responsive_cells(cells: Column) -> Column:
    """Drop the leading header cells and the header cells between the two copies (EXT-3)."""
    h = RESPONSIVE_HEADER_CELLS
    body = F.slice(cells, h + 1, F.greatest(F.size(cells) - h, F.lit(0)))
    start = F.floor((F.size(body) - h) / 2).cast("int")
    return F.when(F.size(body) >= h, F.concat(
        F.slice(body, 1, start), F.slice(body, start + h + 1, F.greatest(F.size(body), F.lit(1)))
    )).otherwise(F.array().cast("array<string>"))


def consultation_items(paras: Column) -> Column:
    """Details joined on ';' and re-split, stray organisation token removed first (EXT-8)."""
    cleaned = F.transform(paras, lambda p: F.replace(p, F.lit(X.STRAY_ORGANISATION), F.lit("")))
    items = F.split(F.array_join(cleaned, ";"), ";")
    return F.when(F.size(paras) > 0, items).otherwise(F.array().cast("array<string>"))


@per_jvm
def _flat_exprs() -> dict:
    """Step 1: the flat list each layout strides over, and its record width."""
    lay = F.col("detected_layout")
    flat = (F.when(lay.isin("table", "grid5"), _f("cells"))
            .when(lay == "responsive7", responsive_cells(_f("cells")))
            .when(lay == "deflist4", _f("dd"))
            .when(lay == "cards6", _f("details"))
            .when(lay == "links5", consultation_items(_f("para")))
            .otherwise(F.array().cast("array<string>")))
    width = (F.when(lay == "table", F.size(_f("headers")))
             .when(lay == "grid5", F.lit(WIDTH["grid5"]))
             .when(lay == "responsive7", F.lit(WIDTH["responsive7"]))
             .when(lay == "deflist4", F.lit(WIDTH["deflist4"]))
             .when(lay == "cards6", F.lit(WIDTH["cards6"]))
             .when(lay == "links5", F.lit(WIDTH["links5"]))
             .otherwise(F.lit(1)))
    return {"_flat": flat, "_width": width}


@per_jvm
def _record_exprs():
    """Step 3: records in the common field order, from the strided chunks."""
    lay = F.col("detected_layout")
    ch = F.col("_chunks")
    headers = _f("headers")

    def pos(name):
        return F.array_position(headers, F.lit(name)).cast("int")

    table = F.transform(ch, lambda r: _rec(
        _get(r, pos("File Number")), _get(r, pos("Received Date")),
        _get(r, pos("Local Authority Name")), _get(r, pos("Applicant Name")),
        _get(r, pos("Development Address")), _get(r, pos("Development Description")), None))
    grid = F.transform(ch, lambda r: _rec(
        _get(r, 1), _get(r, 5), _get(r, 2), _get(r, 3), _get(r, 4), None, None))
    # Two renderings of the same rows: exact distinct within the page collapses
    # them (array_distinct keeps first occurrences in order).
    resp = F.transform(F.array_distinct(ch), lambda r: _rec(
        _get(r, 1), _get(r, 4), None, _get(r, 7), _get(r, 3), _get(r, 2), None))
    cols = F.transform(
        F.arrays_zip(_f("file_no").alias("a"), _f("received").alias("b"),
                     _f("applicant").alias("c"), _f("address").alias("d")),
        lambda s: _rec(s["a"], s["b"], None, s["c"], s["d"], None, None))
    dl = F.transform(F.arrays_zip(_f("file_no").alias("a"), ch.alias("r")), lambda s: _rec(
        s["a"], _get(s["r"], 1), None, _get(s["r"], 3), _get(s["r"], 4), None, None))
    cards = F.transform(
        F.arrays_zip(ch.alias("r"), _f("title").alias("t"), _f("party").alias("p")),
        lambda s: _rec(
            X.remove_literal(_get(s["r"], 1), X.BOARD_LABELS["file_number"]),
            X.prefix(X.remove_literal(_get(s["r"], 4), X.BOARD_LABELS["received_date"]), 10),
            None, s["p"], s["t"],
            X.remove_literal(_get(s["r"], 3), X.BOARD_LABELS["development_description"]), None))
    line = _get(_f("address"), 1)
    case = F.when(F.size(_f("address")) > 0, F.array(_rec(
        X.split_take(line, ":", 0), X.py_strip(_get(_f("strong"), 1)), None,
        _get(_f("party"), 1), X.split_take(line, ":", 1), _get(_f("summary"), 1), None,
    ))).otherwise(F.array().cast("array<array<string>>"))
    dates = F.transform(ch, lambda r: _get(r, CONSULTATION_DATE_ITEM))
    links = F.transform(
        F.arrays_zip(_f("anchor").alias("a"), _f("href").alias("h"), dates.alias("d")),
        lambda s: _rec(F.lit(X.NA_DECC), s["d"], None, F.lit("Gov Consultation"),
                       F.lit(X.NA_DECC), s["a"], s["h"]))
    recs = (F.when(lay == "table", table).when(lay == "grid5", grid)
            .when(lay == "responsive7", resp).when(lay == "columns4", cols)
            .when(lay == "deflist4", dl).when(lay == "cards6", cards)
            .when(lay == "case1", case).when(lay == "links5", links))
    # Parallel lists must line up; the original raised on a mismatch (EXT-4..8).
    n_cols = [F.size(_f(n)) for n in ("file_no", "received", "applicant", "address")]
    agree = (F.when(lay == "columns4", F.greatest(*n_cols) == F.least(*n_cols))
             .when(lay == "deflist4", F.size(_f("file_no")) == F.size(ch))
             .when(lay == "cards6", (F.size(_f("title")) == F.size(ch))
                   & (F.size(_f("title")) == F.size(_f("party"))))
             .when(lay == "links5", F.size(_f("anchor")) == F.size(ch))
             .otherwise(F.lit(True)))
    ok = (F.col("parse_status") == "ok") & agree
    return recs, ok


def page_records(parsed: DataFrame) -> DataFrame:
    """Add ``records ARRAY<ARRAY<STRING>>`` and ``page_ok`` to parsed pages.

    Three projections on purpose: the flat list and width are computed once
    as columns before the stride, because a lambda that refers to a derived
    array would re-derive it for every record.
    """
    flat = parsed.withColumns(_flat_exprs())
    chunks = flat.withColumn("_chunks", stride(F.col("_flat"), F.col("_width"))).drop("_flat")
    recs, ok = _record_exprs()
    # Bad pages get no records (they are reported by ``quarantine_pages``);
    # no Filter here, so the optimizer never copies the parse into a predicate.
    empty = F.array().cast("array<array<string>>")
    return (chunks.withColumn("page_ok", ok)
            .withColumn("records", F.when(F.col("page_ok"), recs).otherwise(empty))
            .withColumn("page_label", F.coalesce(_get(_f("totals"), 1), _get(_f("counter"), 1)))
            .drop("_chunks", "_width"))


def explode_records(pages: DataFrame) -> DataFrame:
    """One row per record with raw string fields and ``row_pos`` (0-based)."""
    keep = [c for c in pages.columns if c not in PAGE_ONLY]
    # The *_outer form: a plain explode makes the optimizer infer
    # ``size(records) > 0`` and push that predicate (with the whole parse
    # inlined) below the parse.  Empty pages give one NULL row, dropped here.
    rows = pages.select(*keep, F.posexplode_outer("records").alias("row_pos", "r")) \
        .where(F.col("r").isNotNull())
    r = F.col("r")
    return rows.select(
        *keep, F.col("row_pos").cast("int").alias("row_pos"),
        F.element_at(r, R_FILE).alias("raw_file_number"),
        F.element_at(r, R_RECEIVED).alias("raw_received"),
        F.element_at(r, R_AUTHORITY).alias("raw_authority"),
        F.element_at(r, R_APPLICANT).alias("raw_applicant"),
        F.element_at(r, R_ADDRESS).alias("raw_address"),
        F.element_at(r, R_DESCRIPTION).alias("raw_description"),
        F.element_at(r, R_LINK).alias("raw_link"),
    )


def quarantine_pages(pages: DataFrame) -> DataFrame:
    """Pages that failed to parse, whose parallel lists disagree, or that hold
    no records without saying that nothing was found (EXT-12)."""
    reason = (F.when(F.col("parse_status") != "ok", F.coalesce("parse_error", F.lit("no HTML")))
              .when(~F.col("page_ok"), F.lit("misaligned lists"))
              .when((F.size("records") == 0) & ~F.col("no_results"), F.lit(NO_RECORDS)))
    keep = [c for c in pages.columns if c not in PAGE_ONLY]
    return pages.select(*keep, F.explode_outer(F.array(reason)).alias("error")).where(F.col("error").isNotNull())
