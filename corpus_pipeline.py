"""From raw documents to packed training sequences, stage by stage.

Every stage takes the documents its predecessor kept and works on all of
them; all but the last return the columns of ``documents``.  Rows travel whole
in a struct, so extra columns may be called like an operator's own; the stages
that drop rows by a join number the rows first, so repeated and null ids are
told apart.
Stage results are
written as Parquet under the shared folder and read back, so a lost executor
costs at most one stage's work.
"""

from __future__ import annotations

import os
import uuid

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from noticeflow.llm import decontaminate, packing, simhash_dedup, suffix_dedup, toxicity
from noticeflow.llm.common import held_out, shared_dir, table, written


def whole(docs: DataFrame, but: tuple[str, ...] = ()) -> Column:
    """All columns but ``but`` as a struct, out of reach of an operator's own names."""
    return F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in docs.columns if c not in but])


def numbered(docs: DataFrame) -> DataFrame:
    """(_row, _doc): every row whole, with a number of its own; written once, so the numbers hold."""
    return written(docs.select(F.monotonically_increasing_id().alias("_row"), whole(docs).alias("_doc")))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier rejects go; the model learns from the labels of the folds it may see."""
    labels = table(spark, sf_dir, "labels").where(~held_out("doc_id", 4))
    model = toxicity.fit(docs, labels)
    rows = docs.select(whole(docs).alias("_doc"), *[c for c in ("text", "lang") if c in docs.columns])
    return toxicity.score(rows, model, ["_doc"]).where(~F.col("rejected")).select("_doc.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each SimHash component stays: the first by (doc_id, row number), a null doc_id last."""
    rows = numbered(docs)
    doc_id = F.col("_doc.doc_id")
    found = simhash_dedup.near_duplicates(
        rows.select(F.struct(doc_id.isNull().alias("none"), doc_id.alias("id"), "_row").alias("doc_id"),
                    F.col("_doc.text").alias("text")), words=4, radius=4)
    again = found.select("doc_id._row", F.col("component_id._row").alias("_first")).where("_row <> _first")
    return rows.join(again.select("_row"), "_row", "left_anti").select("_doc.*")


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes of 50-byte strings that an earlier document holds are cut out of the text; all rows stay.

    What is left of a character cut in two becomes U+FFFD; a null text stays null.
    """
    names = docs.columns
    rows = docs.select("doc_id", "text", whole(docs, ("text",)).alias("_doc"), F.col("text").isNull().alias("_null"))
    out = suffix_dedup.repeated_passages(rows, length=50, carry=["_doc", "_null"])
    text = F.when(~F.col("_null"), F.make_valid_utf8(F.col("kept").cast("string")))
    return out.select(*[text.alias("text") if c == "text" else
                        F.length(text).cast("long").alias("n_chars") if c == "n_chars" else
                        F.col("_doc").getField(c).alias(c) for c in names])


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold a benchmark item go, whatever their doc_id."""
    rows = numbered(docs)
    found = decontaminate.contaminated(rows.select(F.col("_row").alias("doc_id"), F.col("_doc.text").alias("text")),
                                       table(spark, sf_dir, "benchmark"))
    again = found.select(F.col("doc_id").alias("_row")).distinct()
    return rows.join(again, "_row", "left_anti").select("_doc.*")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' tokens in sequences of at most 2048."""
    return packing.packed_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("suffix_array_dedup", cut_repeated_passages),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = os.path.join(shared_dir(spark), f"pipeline-{uuid.uuid4().hex}")
    for i, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{i}-{name}")
        docs = spark.read.parquet(f"{folder}/{i}-{name}")
    return docs


#: The classifier and the fingerprints are not expressible in SQL.
ORACLE_SQL = None
