import datetime as dt

from pyspark.sql import functions as F

from noticeflow.functions import dates as D
from noticeflow.functions import text as X
from noticeflow.functions.announce import draft_announcement


def one(spark, expr, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


def test_py_strip_removes_all_whitespace(spark):
    assert one(spark, X.py_strip("v"), " \t a b \n") == "a b"


def test_split_take_truncates_like_original(spark):
    assert one(spark, X.split_take("v", ":", 0), "ABP-1: Main St: Unit 2") == "ABP-1"
    assert one(spark, X.split_take("v", ":", 1), "ABP-1: Main St: Unit 2") == "Main St"
    assert one(spark, X.split_take("v", ":", 1), "no colon") == ""


def test_remove_literal_and_prefix(spark):
    assert one(spark, X.remove_literal("v", "Case reference:"), "Case reference:314") == "314"
    assert one(spark, X.prefix(X.remove_literal("v", "Date lodged:"), 10),
               "Date lodged:05/09/2021 10:15") == "05/09/2021"
    assert one(spark, X.remove_literal("v", "x"), None) is None


def test_digits_to_int(spark):
    assert one(spark, X.digits_to_int("v"), "1,234 (of 9)") == 12349
    assert one(spark, X.digits_to_int("v"), "none") is None


def test_authority_from_url(spark):
    assert one(spark, X.authority_from_url("v"), "https://x/fingal/search") == "Fingal Co. Co."
    assert one(spark, X.authority_from_url("v"), "https://x/dublincity/a") == "Dublin City Council"
    assert one(spark, X.authority_from_url("v"), "https://x/meath") is None


def test_urls(spark):
    df = spark.createDataFrame([("http://h/CarlowCC/SearchExact/Description", "21/123")], "u string, f string")
    r = df.select(X.detail_url("u", "f").alias("d"), X.encode_spaces(F.lit("a b  c")).alias("e")).first()
    assert r.d == "http://h/CarlowCC/AppFileRefDetails/21/123/0"
    assert r.e == "a%20b%20%20c"


def test_parse_day_first(spark):
    f = D.parse_day_first("v")
    assert one(spark, f, "5/6/2021") == dt.date(2021, 6, 5)
    assert one(spark, f, "05/06/2021") == dt.date(2021, 6, 5)
    assert one(spark, f, " 05/06/2021 ") == dt.date(2021, 6, 5)
    assert one(spark, f, "2021-06-05") is None
    assert one(spark, f, "31/02/2021") is None


def test_parse_long_month_and_master_dialects(spark):
    assert one(spark, D.parse_long_month("v"), " 5 September 2021\n") == dt.date(2021, 9, 5)
    m = D.parse_master_date("v")
    for text in ["2021-09-05", "05/09/2021", "05 Sept 2021", "5 Sep 2021"]:
        assert one(spark, m, text) == dt.date(2021, 9, 5), text
    assert one(spark, m, "garbage") is None


def test_display_date_applies_sept_once(spark):
    assert one(spark, D.display_date("v"), dt.date(2021, 9, 5), "v date") == "05 Sept 2021"
    assert one(spark, D.display_date("v"), dt.date(2021, 10, 5), "v date") == "05 Oct 2021"


def test_deadline_and_age(spark):
    df = spark.createDataFrame([(dt.date(2021, 1, 1),)], "d date")
    r = df.select(D.deadline("d", 32).alias("x"), D.days_overdue("d", dt.date(2021, 1, 11)).alias("a")).first()
    assert r.x == dt.date(2021, 2, 2) and r.a == 10


def test_announcement_rule(spark):
    as_of = dt.date(2021, 9, 10)
    rows = [
        # deadline, show_public, address, existing draft -> expected prefix
        (dt.date(2021, 9, 8), "Yes", "Main St", None, "\U0001F4E2"),
        (dt.date(2021, 9, 8), "yes", "N/A for DECC", None, "\U0001F4E2"),
        (dt.date(2021, 9, 8), "-", "Main St", None, "No tweet"),
        (dt.date(2021, 9, 1), "Yes", "Main St", None, "No tweet"),
        (dt.date(2021, 7, 1), "Yes", "Main St", None, "No Tweet"),
        (None, "Yes", "Main St", "kept", "kept"),
    ]
    df = spark.createDataFrame(
        [(d, s, a, e, "note", "F1", "http://u") for d, s, a, e, _ in rows],
        "deadline date, show_public string, development_address string, draft_announcement string, "
        "comments string, file_number string, url string")
    got = [r[0] for r in df.select(draft_announcement(as_of)).collect()]
    for g, (_, _, addr, _, want) in zip(got, rows):
        assert g.startswith(want)
    text = got[0]
    assert "note proposed for Main St\nDeadline for submissions: 08 Sep\n\nRef No: F1\nLink: http://u" in text
    assert "proposed for DECC\nDeadline for submissions: 08 Sep\n\nLink: http://u" in got[1]


def test_search_plan_over_sources_dimension(spark):
    from noticeflow.schema import sources_df
    from noticeflow.sources.plan import search_plan
    from noticeflow.operators.keywords import keyword_list, keywords_df
    kws = keyword_list(" data centre, gas,, data centre ,tunnel")
    assert kws == ["data centre", "gas", "tunnel"]
    assert [tuple(r) for r in keywords_df(spark, "a, b ,a").collect()] == [(1, "a"), (2, "b")]
    plan = search_plan(sources_df(spark), kws, dt.date(2021, 9, 10)).collect()
    keyed = [r for r in plan if r.keyword is not None]
    assert len(keyed) == 31 * 3 and len(plan) == 31 * 3 + 2
    agile = [r.request_url for r in plan if r.source_id == "fingal" and r.keyword == "gas"][0]
    assert "%22proposal%22:%22gas%22" in agile and "2020-09-10" in agile and "2021-09-10" in agile
    board = [r.request_url for r in plan if r.source_id == "board"][0]
    assert board.endswith("year=2021")
    spaced = [r.request_url for r in plan if r.source_id == "fingal" and r.keyword == "data centre"][0]
    assert "%22data%20centre%22" in spaced and " " not in spaced
    assert search_plan(sources_df(spark), [], dt.date(2021, 9, 10)).count() == 2
