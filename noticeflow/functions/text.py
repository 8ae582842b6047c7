"""Scalar text functions (S-*) as native Column expressions.

All of these stay inside whole-stage codegen; none needs Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Literal labels stripped from the national-board cards and the
# organisation token removed from consultation details, and sentinel texts.
BOARD_LABELS = {
    "file_number": "Case reference:",
    "received_date": "Date lodged:",
    "development_description": "Description:",
}
STRAY_ORGANISATION = "Department of Agriculture, Food and the Marine;"
NO_DESCRIPTION = "No Description"
NA_SID = "N/A for SID"
NA_DECC = "N/A for DECC"
DETAIL_FROM = "SearchExact/Description"
DETAIL_TO = "AppFileRefDetails/"

# Authority by URL substring (agile platform councils).
AUTHORITY_BY_URL = [
    ("dublincity", "Dublin City Council"),
    ("fingal", "Fingal Co. Co."),
    ("dunlaoghaire", "Dun Laoghaire Co. Co."),
]


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c: ColumnOrName) -> Column:
    """Strip leading/trailing whitespace like Python ``str.strip`` (S-8).

    Spark ``trim`` only removes spaces; Python strips tabs and newlines too.
    """
    return F.regexp_replace(F.regexp_replace(_c(c), r"^\s+", ""), r"\s+$", "")


def remove_literal(c: ColumnOrName, literal: str) -> Column:
    """Remove every occurrence of a literal label (S-5); NULL stays NULL."""
    return F.replace(_c(c), F.lit(literal), F.lit(""))


def prefix(c: ColumnOrName, n: int) -> Column:
    """First ``n`` characters (S-6)."""
    return F.substring(_c(c), 1, n)


def split_take(c: ColumnOrName, delimiter: str, k: int) -> Column:
    """``trim(text.split(delimiter)[k])`` with 0-based ``k`` (S-7).

    Like the original, a value that itself contains the delimiter is cut at
    the next delimiter.  Missing parts give ''.
    """
    return py_strip(F.split_part(_c(c), F.lit(delimiter), F.lit(k + 1)))


def digits_to_int(c: ColumnOrName) -> Column:
    """Keep the digits and read them as an integer (S-9); no digits -> NULL."""
    d = F.regexp_replace(_c(c), r"\D", "")
    return F.when(d != "", d.try_cast("bigint"))


def authority_from_url(c: ColumnOrName) -> Column:
    """if/elif chain on URL substrings (S-4); unmatched -> NULL."""
    expr = None
    for needle, name in AUTHORITY_BY_URL:
        cond = _c(c).contains(needle)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr


def detail_url(url: ColumnOrName, file_number: ColumnOrName) -> Column:
    """Search link -> detail page link for the standard platform (S-10)."""
    return F.concat(F.replace(_c(url), F.lit(DETAIL_FROM), F.lit(DETAIL_TO)),
                    _c(file_number), F.lit("/0"))


def absolute_url(base: str | Column, href: ColumnOrName) -> Column:
    """Prefix a relative link with a base (S-11)."""
    b = F.lit(base) if isinstance(base, str) else base
    return F.concat(b, _c(href))


def encode_spaces(c: ColumnOrName) -> Column:
    """Space -> %20 only (S-12); ``url_encode`` would also turn spaces into '+'."""
    return F.replace(_c(c), F.lit(" "), F.lit("%20"))


def fill_human_columns(df: DataFrame) -> DataFrame:
    """Missing annotations: comments '', show_public '-', announcement_sent '-' (S-14)."""
    return df.na.fill({"comments": "", "show_public": "-", "announcement_sent": "-"})


def clean_columns(df: DataFrame, rules: dict[str, tuple[str, str]]) -> DataFrame:
    """Column-scoped regex find/replace (S-17): ``{column: (pattern, replacement)}``."""
    return df.withColumns({c: F.regexp_replace(F.col(c), pat, rep)
                           for c, (pat, rep) in rules.items()})
