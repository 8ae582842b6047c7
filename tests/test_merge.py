"""Keep-last, merge and announcement properties."""

import datetime as dt

from pyspark.sql import functions as F

from noticeflow.operators import dedup
from noticeflow.plans import fixtures as FX
from noticeflow.plans import pipeline as P
from noticeflow.schema import CANONICAL9, LINEAGE, MASTER13, MASTER_SCHEMA
from tests.conftest import SF0001


def _rows(df, cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def test_keep_last_follows_lineage_and_null_keys(spark):
    df = spark.createDataFrame(
        [(None, "a", 1, 1), (None, "b", 1, 2), ("k", "c", 2, 1), ("k", "d", 1, 9)],
        "key string, val string, source_rank int, row_pos int")
    got = set(_rows(dedup.keep_last(df, ["key"], ["source_rank", "row_pos"]), ["key", "val"]))
    assert got == {(None, "b"), ("k", "c")}


def test_keep_last_plans_partial_top1_before_shuffle(spark):
    fresh = FX.fresh(FX.table(spark, SF0001, "orders"))
    plan = dedup.keep_last_key6(fresh)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def _fixture(spark):
    o = FX.table(spark, SF0001, "orders")
    return FX.fresh(o), P.master_from_text(FX.existing_master_text(o))


def test_merge_keeps_annotations(spark):
    fresh, master = _fixture(spark)
    merged = P.merge_master(fresh, master)
    notes = merged.where(F.col("comments").startswith("note ")).count()
    assert notes == master.count()
    assert merged.count() == fresh.select(*CANONICAL9[:3]).select("file_number").distinct().count()


def test_merge_with_empty_master_is_dedup(spark):
    fresh, _ = _fixture(spark)
    empty = spark.createDataFrame([], MASTER_SCHEMA)
    merged = P.merge_master(fresh, empty)
    deduped = dedup.keep_last_key6(fresh).select(*CANONICAL9)
    assert _rows(merged, CANONICAL9) == _rows(deduped, CANONICAL9)
    assert merged.where("comments <> '' OR show_public <> '-' OR announcement_sent <> '-'").count() == 0


def test_merge_is_idempotent(spark):
    fresh, master = _fixture(spark)
    once = P.merge_master(fresh, master)
    twice = P.merge_master(fresh, once)
    assert _rows(once, MASTER13) == _rows(twice, MASTER13)


def test_merge_independent_of_partitioning(spark):
    fresh, master = _fixture(spark)
    a = P.merge_master(fresh, master)
    b = P.merge_master(fresh.repartition(3).sortWithinPartitions(F.rand(7)), master.repartition(5))
    assert _rows(a, MASTER13) == _rows(b, MASTER13)


def test_flagship_entry_runs(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.columns == MASTER13
    rows = df.collect()
    assert len(rows) > 0
    drafts = {r.draft_announcement.split("\n")[0] if r.draft_announcement else None for r in rows}
    assert "No Tweet" in drafts


def test_duplicate_keys_inside_master_keep_the_later_row(spark, tmp_dir):
    from noticeflow.schema import MASTER_TEXT_SCHEMA
    from noticeflow.sources import files
    row = ["7", "05/09/2021", "C", "07/10/2021", "A", "B", "D", "u", "gas"]
    df = spark.createDataFrame([tuple(row + ["first", "Yes", "-", None]),
                                tuple(row + ["second", "Yes", "-", None])], MASTER_TEXT_SCHEMA)
    files.write_csv(df.coalesce(1), f"{tmp_dir}/m")
    master = P.master_from_text(files.read_csv(spark, f"{tmp_dir}/m", MASTER_TEXT_SCHEMA), keep_order=True)
    fresh = FX.fresh(FX.table(spark, SF0001, "orders")).limit(0)
    merged = P.merge_master(fresh, master).collect()
    assert [r.comments for r in merged] == ["second"]


def test_later_file_of_a_sheet_wins_whatever_its_size(spark, tmp_dir):
    from noticeflow.schema import MASTER_TEXT_SCHEMA
    from noticeflow.sources import files
    row = ["7", "05/09/2021", "C", "07/10/2021", "A", "B", "D", "u", "gas"]
    other = ["8", "05/09/2021", "C", "07/10/2021", "A", "B", "D" * 5000, "u", "gas", "-", "Yes", "-", None]
    parts = {"a": [tuple(row + ["first", "Yes", "-", None])],
             "b": [tuple(other), tuple(row + ["second", "Yes", "-", None])]}
    for name, rows in parts.items():
        files.write_csv(spark.createDataFrame(rows, MASTER_TEXT_SCHEMA).coalesce(1), f"{tmp_dir}/s/part={name}")
    sheet = files.read_csv(spark, f"{tmp_dir}/s/*", MASTER_TEXT_SCHEMA, position=True)
    fresh = FX.fresh(FX.table(spark, SF0001, "orders")).limit(0)
    merged = {r.file_number: r.comments for r in P.merge_master(fresh, P.master_from_text(sheet)).collect()}
    assert merged == {"7": "second", "8": "-"}
