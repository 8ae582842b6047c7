"""Date functions (D-*).

Parsing never infers a format: each source declares its list of patterns and
values that match none become NULL (and are reported by the quarantine step).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import DAY_FIRST, LONG_MONTH
from .text import py_strip

ColumnOrName = Column | str

# The master sheet spells September "Sept".
SEPT_SHEET = "Sept"
SEPT_JAVA = "Sep"
WINDOW_DAYS = 365


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _as_date(d) -> Column:
    if isinstance(d, Column):
        return d
    if isinstance(d, str):
        d = _dt.date.fromisoformat(d)
    return F.lit(d)


def parse_with(c: ColumnOrName, patterns: list[str]) -> Column:
    """First pattern that parses wins (never throws)."""
    s = _c(c)
    return F.coalesce(*[F.try_to_date(s, p) for p in patterns])


def parse_day_first(c: ColumnOrName) -> Column:
    """``%d/%m/%Y`` (D-1).  ``d/M`` accepts one- and two-digit fields."""
    return F.try_to_date(py_strip(c), DAY_FIRST)


def parse_long_month(c: ColumnOrName) -> Column:
    """``%d %B %Y`` after stripping (D-2)."""
    return F.try_to_date(py_strip(c), LONG_MONTH)


def parse_declared(c: ColumnOrName, patterns: list[str]) -> Column:
    """Per-source declared formats instead of inference (D-3)."""
    return parse_with(py_strip(c), patterns)


def parse_by_formats(c: ColumnOrName, formats: ColumnOrName, known: list[str]) -> Column:
    """First format of an array column that parses (D-3), a fold over the array.

    ``known`` formats are literals, whose parsers are built once; any other
    format of a row is built for that row.  A format that Spark refuses parses
    nothing.
    """
    text = py_strip(c)

    def one(pattern: Column) -> Column:
        out = None
        for k in known:
            out = F.when(pattern == k, F.try_to_date(text, k)) if out is None else out.when(pattern == k, F.try_to_date(text, k))
        other = F.try_to_timestamp(text, pattern).cast("date")
        return other if out is None else out.otherwise(other)

    return F.aggregate(_c(formats), F.lit(None).cast("date"), lambda got, pattern: F.coalesce(got, one(pattern)))


def parse_master_date(c: ColumnOrName) -> Column:
    """Master sheet dialects: ISO, day-first, ``dd Mon yyyy`` with ``Sept`` (D-4, D-5)."""
    s = py_strip(c)
    return F.coalesce(
        F.try_to_date(s, "yyyy-MM-dd"),
        F.try_to_date(s, DAY_FIRST),
        F.try_to_date(F.replace(s, F.lit(SEPT_SHEET), F.lit(SEPT_JAVA)), "d MMM yyyy"),
    )


def deadline(received: ColumnOrName, days: ColumnOrName | int) -> Column:
    """Submission deadline = received + N days (D-6)."""
    n = F.lit(days) if isinstance(days, int) else _c(days)
    return F.date_add(_c(received), n)


def days_overdue(deadline_col: ColumnOrName, as_of) -> Column:
    """Days from deadline to the as-of date, as BIGINT (D-7)."""
    return F.datediff(_as_date(as_of), _c(deadline_col)).cast("bigint")


def display_date(c: ColumnOrName) -> Column:
    """``dd Mon yyyy`` with ``Sep`` -> ``Sept`` applied once to a DATE (D-8)."""
    return F.replace(F.date_format(_c(c), "dd MMM yyyy"), F.lit(SEPT_JAVA), F.lit(SEPT_SHEET))


def window_start(as_of, days: int = WINDOW_DAYS) -> Column:
    """as_of - 365 days (D-9): a fixed job parameter, never ``current_date``."""
    return F.date_sub(_as_date(as_of), days)


def as_of_texts(as_of) -> dict[str, Column]:
    """The window bounds in the three text forms the sites expect (D-9)."""
    a, s = _as_date(as_of), window_start(as_of)
    return {
        "from_iso": F.date_format(s, "yyyy-MM-dd"), "to_iso": F.date_format(a, "yyyy-MM-dd"),
        "from_dmy": F.date_format(s, "dd/MM/yyyy"), "to_dmy": F.date_format(a, "dd/MM/yyyy"),
        "from_compact": F.date_format(s, "ddMMyyyy"), "to_compact": F.date_format(a, "ddMMyyyy"),
    }
