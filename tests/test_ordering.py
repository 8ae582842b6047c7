import datetime as dt
import random

from pyspark.sql import functions as F

from noticeflow.operators import filters, ordering
from noticeflow.plans import fixtures as FX
from tests.conftest import SF0001


def test_positions_are_dense_and_ordered(spark):
    apps = FX.apps(FX.table(spark, SF0001, "orders"))
    order = ordering.sort_columns("deadline", ["file_number"])
    got = ordering.with_positions(apps, order, partitions=5).select("position", "file_number").collect()
    pos = sorted(r.position for r in got)
    assert pos == list(range(len(got)))
    expected = [r.file_number for r in apps.orderBy(*order).select("file_number").collect()]
    by_pos = [r.file_number for r in sorted(got, key=lambda r: r.position)]
    assert by_pos == expected


def test_positions_have_no_global_window(spark):
    apps = FX.apps(FX.table(spark, SF0001, "orders"))
    df = ordering.with_positions(apps, ordering.sort_columns("deadline", ["file_number"]))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Window" not in plan


def test_take_while_matches_brute_force(spark):
    rnd = random.Random(3)
    rows = [(s, p, r, rnd.random() < 0.15) for s in ("a", "b", "c") for p in range(4) for r in range(5)]
    rows = [x for x in rows if not (x[0] == "c" and x[3])]  # source c never stops
    df = spark.createDataFrame(rows, "src string, page int, pos int, old boolean")
    got = sorted(tuple(r) for r in filters.take_while(df, ["src"], ["page", "pos"], F.col("old")).collect())
    want = []
    for s in ("a", "b", "c"):
        for x in sorted([x for x in rows if x[0] == s], key=lambda x: (x[1], x[2])):
            if x[3]:
                break
            want.append(x)
    assert got == sorted(want)


def test_latest_k_per_group(spark):
    df = spark.createDataFrame([(g, m) for g in ("x", "y") for m in range(1, 8)] + [("z", 1)],
                               "g string, m int")
    got = sorted(tuple(r) for r in ordering.latest_k(df, ["g"], "m", 4).collect())
    assert got == sorted([("x", m) for m in (4, 5, 6, 7)] + [("y", m) for m in (4, 5, 6, 7)] + [("z", 1)])


def test_windows_on_dates(spark):
    as_of = dt.date(2021, 9, 10)
    ds = [dt.date(2020, 9, 10), dt.date(2020, 9, 11), dt.date(2021, 1, 1), dt.date(2021, 9, 11)]
    df = spark.createDataFrame([(d,) for d in ds], "received_date date")
    n = lambda f: f(df, as_of).count()
    assert n(filters.recent) == 4  # 2020-09-10 is exactly 365 days back: kept
    assert n(filters.strictly_newer) == 3
    assert n(filters.closed_range) == 3
    assert n(filters.current_year) == 2
