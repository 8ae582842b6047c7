
import corpus_pipeline
import numpy as np
import public_tokenizers

from pyspark.sql import functions as F

from noticeflow.llm import decontaminate, packing, simhash_dedup, suffix_dedup, toxicity
from noticeflow.llm.common import held_out, table

SF = "/root/testdata/sf0.001"


def test_stages_compose(spark):
    docs = table(spark, SF, "documents")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, SF)
    want = {r.component_id for r in simhash_dedup.near_duplicates(docs).select("component_id").distinct().collect()}
    assert {r.doc_id for r in kept.collect()} == want and kept.columns == docs.columns
    cut = corpus_pipeline.cut_repeated_passages(spark, kept, SF)
    assert cut.columns == docs.columns and cut.count() == len(want)
    spans = {r.doc_id: bytes(r.kept) for r in suffix_dedup.repeated_passages(kept).collect()}
    assert all(r.text.encode() == spans[r.doc_id] for r in cut.collect() if "�" not in r.text)
    assert all(r.n_chars == len(r.text) for r in cut.collect())


def test_run_packs_what_the_stages_keep(spark):
    got = corpus_pipeline.run(spark, SF)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash_near_dedup", "suffix_array_dedup",
                                                      "decontamination", "packing"]
    rows = got.collect()
    # the same decisions, taken with the operators by hand
    docs = table(spark, SF, "documents")
    model = toxicity.fit(docs, table(spark, SF, "labels").where(~held_out("doc_id", 4)))
    clean = docs.join(toxicity.score(docs, model).where(~F.col("rejected")).select("doc_id"), "doc_id", "left_semi")
    one = simhash_dedup.near_duplicates(clean).where("doc_id = component_id").select("doc_id")
    once = corpus_pipeline.cut_repeated_passages(spark, clean.join(one, "doc_id", "left_semi"), SF)
    leaks = decontaminate.contaminated(once, table(spark, SF, "benchmark")).select("doc_id").distinct()
    want = {r.doc_id for r in once.collect()} - {r.doc_id for r in leaks.collect()}
    assert {r.doc_id for r in rows} == want
    assert {"doc_id", "start", "length", "sequence_id", "offset"} <= set(got.columns)
    assert packing.LENGTH_SIZE == 2048 and public_tokenizers.path("byte_bpe_50k.json")


def test_rows_are_told_apart_whatever_their_ids_and_column_names(spark):
    rng = np.random.default_rng(11)
    vocab = [f"w{i}x" for i in range(500)]
    draw = [" ".join(rng.choice(vocab, 60)) for _ in range(5)]
    item = table(spark, SF, "benchmark").where("text is not null").orderBy(F.length("text").desc(), "item_id").first().text
    names = ["score", "threshold", "rejected", "kept", "spans", "n_bytes", "n_removed", "n_spans", "row", "_row", "_null"]
    texts = [(1, draw[0]), (2, draw[0]), (2, draw[1]),      # a clean text shares its id with a copy
             (3, draw[2]), (3, draw[2]), (4, draw[2]),      # repeated rows of the least id
             (None, draw[3]), (None, draw[3]),              # copies without an id
             (None, "before " + item), (None, draw[4])]     # a leak without an id
    docs = spark.createDataFrame([(i, t, "en", 0, *names) for i, t in texts],
                                 "doc_id long, text string, lang string, n_chars long, "
                                 + ", ".join(f"{c} string" for c in names))

    def seen(df):
        rows = df.collect()
        assert df.columns == docs.columns and all(list(r)[4:] == names for r in rows)
        return sorted(((r.doc_id, r.text) for r in rows), key=str)
    assert seen(corpus_pipeline.drop_toxic(spark, docs, SF)) == sorted(texts, key=str)
    once = corpus_pipeline.drop_near_duplicates(spark, docs, SF)
    want = [(1, draw[0]), (2, draw[1]), (3, draw[2]), (None, draw[3]), (None, "before " + item), (None, draw[4])]
    assert seen(once) == sorted(want, key=str)
    assert [i for i, _ in seen(corpus_pipeline.cut_repeated_passages(spark, once, SF))] == [i for i, _ in sorted(want, key=str)]
    assert seen(corpus_pipeline.drop_contaminated(spark, docs, SF)) == sorted(
        (x for x in texts if "before" not in x[1]), key=str)
