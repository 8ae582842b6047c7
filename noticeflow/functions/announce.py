"""Draft announcement rule (S-18, PIPE-4), evaluated natively per row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .dates import days_overdue
from .text import NA_DECC

# Texts of the announcement rule.
HEADLINE = "\U0001F4E2 New - Public Submissions Needed \U0001F4E2 "
PROPOSED_FOR = " proposed for "
DEADLINE_LABEL = "Deadline for submissions: "
REF_LABEL = "Ref No: "
LINK_LABEL = "Link: "
HOW_LABEL = "How to submit: "
CONSULTATION_SHORT = "DECC"
NO_ANNOUNCEMENT_OLD = "No Tweet"
NO_ANNOUNCEMENT = "No tweet"
STALE_AFTER_DAYS = 50
FRESH_WITHIN_DAYS = 3
# Deployment-specific values (the help page and hashtag of the publisher) are
# parameters; these neutral defaults keep the layout of the message.
DEFAULT_HELP_URL = "https://example.org/how-to-submit/"
DEFAULT_TAG = "#submission"


def announcement_text(help_url: str = DEFAULT_HELP_URL, tag: str = DEFAULT_TAG) -> Column:
    is_decc = F.coalesce(F.col("development_address") == NA_DECC, F.lit(False))
    nl = F.lit("\n")

    def txt(c):  # a missing piece reads as empty text, as in the sheet
        return F.coalesce(F.col(c).cast("string"), F.lit(""))

    return F.concat(
        F.lit(HEADLINE), nl, F.coalesce(F.col("comments"), F.lit("")), F.lit(PROPOSED_FOR),
        F.when(is_decc, F.lit(CONSULTATION_SHORT)).otherwise(txt("development_address")), nl,
        F.lit(DEADLINE_LABEL), F.date_format(F.col("deadline"), "dd MMM"), nl,
        F.when(is_decc, F.lit("")).otherwise(
            F.concat(nl, F.lit(REF_LABEL), txt("file_number"))),
        nl, F.lit(LINK_LABEL), txt("url"), nl, F.lit(HOW_LABEL), F.lit(help_url),
        nl, nl, F.lit(tag))


def draft_announcement(as_of, help_url: str = DEFAULT_HELP_URL, tag: str = DEFAULT_TAG,
                       existing: str = "draft_announcement") -> Column:
    """The rule of section 2.10: stale, not public / not fresh, or the text."""
    age = days_overdue("deadline", as_of)
    public = F.lower(F.col("show_public")) == "yes"
    return (F.when(F.col("deadline").isNull(), F.col(existing))
            .when(age > STALE_AFTER_DAYS, F.lit(NO_ANNOUNCEMENT_OLD))
            .when(public & (age <= FRESH_WITHIN_DAYS), announcement_text(help_url, tag))
            .otherwise(F.lit(NO_ANNOUNCEMENT)))
