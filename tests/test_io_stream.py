import datetime as dt
from pathlib import Path

from pyspark.sql import functions as F
from pyspark.sql import types as T

from noticeflow.plans import fixtures as FX
from noticeflow.plans import pipeline as P
from noticeflow.schema import CANONICAL9, LINEAGE, MASTER13, MASTER_SCHEMA, MASTER_TEXT_SCHEMA, sources_df
from noticeflow.sources import files
from noticeflow.sources.master_store import MasterStore
from noticeflow.streaming import refresh
from tests.conftest import SF0001


def test_csv_round_trip_keeps_quotes_commas_newlines_and_zeros(spark, tmp_dir):
    row = ("0012", "05/09/2021", "Council", "05 Sept 2021", "A, B", 'Say "hi"', "line1\nline2",
           "http://u", "gas", 'c, "q"\nx', None, "-", None)
    df = spark.createDataFrame([row], MASTER_TEXT_SCHEMA)
    files.write_csv(df, f"{tmp_dir}/m")
    back = files.read_csv(spark, f"{tmp_dir}/m", MASTER_TEXT_SCHEMA).first()
    assert tuple(back) == row
    parsed = P.master_from_text(files.read_csv(spark, f"{tmp_dir}/m", MASTER_TEXT_SCHEMA)).first()
    assert parsed.received_date == dt.date(2021, 9, 5) and parsed.deadline == dt.date(2021, 9, 5)


def test_master_store_versions(spark, tmp_dir):
    store = MasterStore(spark, f"{tmp_dir}/master")
    assert store.read().count() == 0 and store.versions() == []
    one = spark.createDataFrame([("1", None, "A", None, "x", "y", "z", "u", "s", "", "-", "-", None)],
                                MASTER_SCHEMA)
    assert store.publish(one) == 1
    assert store.publish(one.union(one)) == 2
    assert store.read().count() == 2 and store.read(1).count() == 1
    # a publish that died after writing data but before its manifest is skipped
    one.write.parquet(f"{tmp_dir}/master/data/v=000003")
    assert store.versions() == [1, 2] and store.publish(one) == 4
    assert store.versions() == [1, 2, 4] and store.read().count() == 1


def test_master_merge_rewrites_only_touched_months(spark, tmp_dir):
    o = FX.table(spark, SF0001, "orders")
    master = P.master_from_text(FX.existing_master_text(o)).select(*MASTER13)
    store = MasterStore(spark, f"{tmp_dir}/master")
    store.publish(master)
    before = store.manifest()
    fresh = FX.fresh(o).where(F.year("received_date") == 1998)
    v = store.merge(fresh.select(*CANONICAL9, *LINEAGE), P.merge_master)
    after = store.manifest()
    assert v == 2
    assert {m for m, ver in after.items() if ver == 2} == {m for m in after if m.startswith("1998")}
    assert all(after[m] == before[m] for m in before if not m.startswith("1998"))
    want = P.merge_master(fresh, master)
    assert sorted((tuple(r) for r in store.read().collect()), key=repr) == \
        sorted((tuple(r) for r in want.collect()), key=repr)
    assert store.read(1).count() == master.count()


def test_stream_equals_batch_and_replay_is_harmless(spark, tmp_dir):
    o = FX.table(spark, SF0001, "orders")
    fresh = FX.fresh(o)
    master = P.master_from_text(FX.existing_master_text(o)).select(*MASTER13)
    batch = P.merge_master(fresh, master)
    store = MasterStore(spark, f"{tmp_dir}/master")
    store.publish(master)
    inbox = f"{tmp_dir}/inbox"
    for status in ("F", "O", "P"):
        fresh.where(F.col("o_orderstatus") == status).select(*CANONICAL9, *LINEAGE) \
            .write.mode("append").parquet(inbox)
        refresh.run_available(spark, inbox, store, f"{tmp_dir}/ckpt")
    streamed = store.read()
    key = sorted((tuple(r) for r in batch.collect()), key=repr)
    assert sorted((tuple(r) for r in streamed.collect()), key=repr) == key
    # a second run with nothing new publishes nothing
    before = store.versions()
    refresh.run_available(spark, inbox, store, f"{tmp_dir}/ckpt")
    assert store.versions() == before
    # replaying every file against the result changes nothing
    again = P.merge_master(spark.read.schema(refresh.FRESH_SCHEMA).parquet(inbox), streamed)
    assert sorted((tuple(r) for r in again.collect()), key=repr) == key


def test_vacuum_keeps_what_a_kept_manifest_names(spark, tmp_dir):
    store = MasterStore(spark, f"{tmp_dir}/master")
    row = lambda n, d: spark.createDataFrame([(n, d, "A", None, "x", "y", "z", "u", "s", "", "-", "-", None)], MASTER_SCHEMA)
    store.publish(row("1", dt.date(2020, 1, 5)).union(row("2", dt.date(2020, 2, 5))))
    for n in range(3, 7):
        store.merge(row(str(n), dt.date(2020, 2, n)).select(*CANONICAL9), P.merge_master)
    want = sorted(r.file_number for r in store.read().collect())
    row("9", None).write.parquet(f"{tmp_dir}/master/data/v=000099")  # a write under way
    gone = store.vacuum(keep=2)
    assert store.versions() == [4, 5] and sorted(r.file_number for r in store.read().collect()) == want
    assert "data/v=000001/received_month=2020-02" in gone and "data/v=000001" not in gone
    assert store.read(4).count() == 5 and store.vacuum(keep=2) == []
    assert store._next_version() == 100


def test_a_publish_evaluates_its_input_once(spark, tmp_dir):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    df = spark.range(100).selectExpr(
        "CAST(id AS STRING) AS file_number", "DATE'2020-01-01' + CAST(id AS INT) AS received_date", "'A' AS local_authority_name",
        "CAST(NULL AS DATE) AS deadline", "'x' AS applicant_name", "'y' AS development_address", "'z' AS development_description",
        "'u' AS url", "'s' AS search_term")
    store = MasterStore(spark, f"{tmp_dir}/master")
    full = df.selectExpr("*", "'' AS comments", "'-' AS show_public", "'-' AS announcement_sent", "CAST(NULL AS STRING) AS draft_announcement")
    store.publish(full.mapInArrow(count, MASTER_SCHEMA))
    assert seen.value == 100
    store.merge(df.mapInArrow(count, df.schema), P.merge_master)
    assert seen.value == 200 and store.read().count() == 100


def test_stream_of_captures_and_its_replay(spark, tmp_dir):
    o = FX.table(spark, SF0001, "orders")
    from noticeflow.schema import sources_df
    sources, caps = sources_df(spark), FX.render_captures(o)
    store, inbox = MasterStore(spark, f"{tmp_dir}/master"), f"{tmp_dir}/inbox"
    for layouts in (["table", "grid5", "responsive7", "columns4"], ["deflist4", "cards6", "case1", "links5"]):
        caps.where(F.col("layout").isin(layouts)).write.mode("append").parquet(inbox)
        refresh.run_available_captures(spark, inbox, sources, store, f"{tmp_dir}/ckpt", FX.AS_OF)
    want = P.merge_master(P.fresh_notices(caps, sources, FX.AS_OF), spark.createDataFrame([], MASTER_SCHEMA))
    rows = lambda df: sorted((tuple(r) for r in df.select(*MASTER13).collect()), key=repr)
    assert rows(store.read()) == rows(want)
    versions = store.versions()
    # the same batch again, as after a failure between publishing and the stream's own record
    handle = refresh.merge_batch(store, f"{tmp_dir}/ckpt", refresh.capture_batch(sources, FX.AS_OF))
    handle(caps, 1)
    assert store.versions() == versions
    handle(caps, 2)
    assert rows(store.read()) == rows(want)


def test_source_files_one_folder_each(spark, tmp_dir):
    tmp_dir = Path(tmp_dir)
    captures = FX.render_captures(FX.table(spark, SF0001, "orders"))
    run = lambda rows, name, **kw: P.source_files(rows, sources_df(spark), FX.AS_OF, f"{tmp_dir}/{name}", **kw)
    run(captures.union(captures), "all")  # captured twice: equal rows stay once
    schema = T.StructType([T.StructField(c, T.StringType()) for c in P.SOURCE_FILE])
    whole = files.read_csv(spark, f"{tmp_dir}/all", schema)
    assert whole.count() == P.fresh_notices(captures, sources_df(spark), FX.AS_OF, None).count()
    run(captures, "one", only=["fingal"])
    assert [p.name for p in sorted((tmp_dir / "one").iterdir()) if p.name.startswith("source_id")] == ["source_id=fingal"]
    dates = [r[0] for r in files.read_csv(spark, f"{tmp_dir}/one/source_id=fingal", schema).select("received_date").collect()]
    assert dates and dates == sorted(dates, reverse=True)
    assert sorted(map(tuple, files.read_csv(spark, f"{tmp_dir}/one/source_id=fingal", schema).collect())) == sorted(
        map(tuple, files.read_csv(spark, f"{tmp_dir}/all/source_id=fingal", schema).collect()))
