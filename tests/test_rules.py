"""Rules that round trips over clean pages don't reach."""

import datetime as dt

from pyspark.sql import functions as F

from noticeflow.operators import dedup, filters
from noticeflow.plans import pipeline as P
from noticeflow.schema import KEY6, LINEAGE

OLD, NEW = dt.date(2019, 3, 1), dt.date(2021, 9, 1)


def test_take_while_without_page_numbers(spark):
    df = spark.createDataFrame([("s", None, 0, 2021), ("s", None, 1, 2018), ("s", None, 2, 2021)],
                               "source_id string, page_no int, row_pos int, year int")
    got = filters.take_while(df, ["source_id"], ["page_no", "row_pos"], F.col("year") < 2020).collect()
    assert [r.row_pos for r in got] == [0]


def test_blank_and_missing_keys_are_one(spark):
    cols = [*KEY6, *LINEAGE, "is_existing", "note"]
    types = dict.fromkeys(KEY6, "string") | {"received_date": "date"} | dict.fromkeys(LINEAGE, "int") \
        | {"is_existing": "boolean", "note": "string"}
    row = {c: "x" for c in KEY6} | {"received_date": NEW} | {c: 1 for c in LINEAGE}
    name = next(c for c in KEY6 if types[c] == "string" and c != "file_number")
    fresh = row | {name: "", "is_existing": False, "note": None}
    kept = row | {name: None, "is_existing": True, "note": "mine"}
    df = spark.createDataFrame([tuple(r[c] for c in cols) for r in (fresh, kept)],
                               ", ".join(f"{c} {types[c]}" for c in cols))
    got = dedup.keep_existing(df)
    assert got.columns == cols and [r.note for r in got.collect()] == ["mine"]


def test_board_cases_have_no_window(spark):
    df = spark.createDataFrame(
        [(lay, d, "s", 1, i) for i, (lay, d) in enumerate([("cards6", OLD), ("case1", OLD), ("table", OLD), ("table", NEW)])],
        "detected_layout string, received_date date, source_id string, page_no int, row_pos int")
    got = sorted((r.detected_layout, r.received_date) for r in P.apply_window(df, dt.date(2021, 9, 10)).collect())
    assert got == [("cards6", OLD), ("case1", OLD), ("table", NEW)]


def test_latest_attempt_is_lazy_and_the_same_by_broadcast_and_by_shuffle(spark):
    rows = [("s", None, None, 1, 1, "a"), ("s", None, None, 1, 2, "b"), ("s", None, None, 1, 2, "c"),
            ("s", "k", 0, None, 1, "d"), ("s", "k", 0, None, None, "e"), ("s", "k", 0, None, 1, "d"), ("t", "k", 0, 2, None, "f")]
    df = spark.createDataFrame(rows, "source_id string, keyword string, list_pos int, page_no int, attempt int, url string")
    want = ["b", "c", "d", "d", "e", "f"]  # d and e have no page number: their URLs tell them apart
    got = P.drop_superseded(df.withColumn("url", F.coalesce("url", F.raise_error(F.lit("read")))))  # no job yet
    assert sorted(r.url for r in got.collect()) == want and got.columns == df.columns
    was = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        got = P.drop_superseded(df)
        assert "SortMergeJoin" in got._jdf.queryExecution().executedPlan().toString()
        assert sorted(r.url for r in got.collect()) == want
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)


def test_newest_lists_go_by_source_and_run(spark):
    rows = [(d, s, lay, p) for d in ("2021-09-01", "2021-09-08") for s, lay, top in (("board", "cards6", 6), ("std", "table", 6))
            for p in range(1, top)] + [("2021-09-01", "board", "case1", None), (None, "small", "cards6", 9)]
    df = spark.createDataFrame(rows, "fetched_on string, source_id string, layout string, list_pos int") \
        .withColumn("fetched_on", F.col("fetched_on").cast("date"))
    gone = set(map(tuple, df.collect())) - set(map(tuple, P.newest_lists(df).collect()))
    assert sorted((str(d), s, p) for d, s, _, p in gone) == [("2021-09-01", "board", 5), ("2021-09-08", "board", 5)]


def test_newest_lists_do_not_shuffle_the_pages(spark):
    df = spark.range(1000).selectExpr("'board' AS source_id", "'cards6' AS layout", "CAST(id % 7 AS INT) + 1 AS list_pos",
                                      "CAST(id AS INT) AS page_no")
    got = P.newest_lists(df)
    assert "hashpartitioning" not in got._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.page_no for r in got.collect()) == [i for i in range(1000) if i % 7 < 4]
    few = P.newest_lists(df.where("list_pos <= 4"))
    assert "Join" not in few._jdf.queryExecution().executedPlan().toString() and few.count() == 572


def test_take_while_does_not_shuffle_the_listing(spark):
    df = spark.range(1000).selectExpr("IF(id % 3 = 0, 'hot', concat('s', id)) AS source_id", "CAST(id AS INT) AS page_no",
                                      "0 AS row_pos", "IF(id > 900, 1, 0) AS old")
    got = filters.take_while(df, ["source_id"], ["page_no", "row_pos"], F.col("old") == 1)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    kept = {r.page_no for r in got.collect()}
    assert kept == set(range(901))


def test_source_listed_twice_is_an_error(spark):
    import pytest
    from noticeflow.schema import SOURCES_SCHEMA, source_rows
    twice = spark.createDataFrame(source_rows() + source_rows()[:1], SOURCES_SCHEMA)
    with pytest.raises(Exception, match="source listed twice"):
        P.source_rules(twice).collect()
    assert P.source_rules(spark.createDataFrame(source_rows(), SOURCES_SCHEMA)).count() == 33


def test_date_formats_by_source(spark):
    from noticeflow.functions import dates as D
    rows = [("05/06/2021", ["d/M/yyyy"]), ("05/06/2021", ["M/d/yyyy", "d/M/yyyy"]), ("25/06/2021", ["M/d/yyyy", "d/M/yyyy"]),
            ("2021.06.07", ["d/M/yyyy", "yyyy.MM.dd"]), (" 5 June 2021\n", ["d MMMM yyyy"]), ("x", ["d/M/yyyy"]), ("1/2/2021", []),
            (None, ["d/M/yyyy"])]
    df = spark.createDataFrame(rows, "t string, f array<string>")
    got = [r.d for r in df.select(D.parse_by_formats("t", "f", ["d/M/yyyy", "d MMMM yyyy"]).alias("d")).collect()]
    assert got == [dt.date(2021, 6, 5), dt.date(2021, 5, 6), dt.date(2021, 6, 25), dt.date(2021, 6, 7), dt.date(2021, 6, 5),
                   None, None, None]


def test_rendering_tasks_grow_with_the_orders(spark, monkeypatch):
    from noticeflow.plans import fixtures as FX
    monkeypatch.setattr(FX, "ORDERS_A_TASK", 20)
    orders = spark.range(1, 1001, numPartitions=1).selectExpr(
        "id AS o_orderkey", "id AS o_custkey", "DATE'2001-07-01' AS o_orderdate", "'F' AS o_orderstatus", "'1-URGENT' AS o_orderpriority")
    assert FX.render_tasks(orders) == 50
    faulty = FX.case_pages(orders)
    assert faulty.count() == 1000 and "hashpartitioning(o_orderkey#" in faulty._jdf.queryExecution().toString()
    for pages in (faulty, FX.render_captures(orders, "grid5")):
        assert ", 50)" in pages._jdf.queryExecution().executedPlan().toString()
