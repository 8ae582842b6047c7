"""Queries of this folder's operators: ``opN_<name>`` applies operator N to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (decontaminate, hash_ring, id_files, knn_join, langid, mixing_lm, packing, prefix_trie, simhash_dedup,
               suffix_dedup, token_counts, toxicity, vector_codes)
from .common import held_out, shared_dir, table

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn(
        "held_out", held_out("doc_id", 4))
    model = langid.fit(docs.where(~F.col("held_out")))
    return langid.predict(docs, model, ["doc_id", "held_out"])


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_duplicates(table(spark, sf_dir, "documents"), words=4, radius=4).select(
        "doc_id", "fingerprint", "component_id")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn(
        "held_out", held_out("doc_id", 4))
    labels = table(spark, sf_dir, "labels").where(~held_out("doc_id", 4))
    model = toxicity.fit(docs, labels, thresholds=False)  # the contract's own threshold follows
    return toxicity.score(docs, model, ["doc_id", "held_out"]).select(
        "doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op5_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated_passages(table(spark, sf_dir, "documents"), length=50).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op6_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return knn_join.top_k(vectors, vectors.where(F.col("vec_id") % 100 == 0), k=10, scale=1024.0)


OP6_SQL = """
WITH ok AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, d.vec_id, CAST(list_dot_product(q.v, d.v) AS BIGINT) AS score
  FROM ok q JOIN ok d ON q.vec_id <> d.vec_id WHERE q.vec_id % 100 = 0
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s
)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 10
"""


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text").cast("string")
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", (F.coalesce(F.octet_length(text), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"), F.lit("rows").alias("law"))
    return hash_ring.shard_rows(rows, "doc_id", shards=40).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), WORD_BPE)


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("held_out", held_out("doc_id", 7))
    return mixing_lm.score(docs)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(table(spark, sf_dir, "documents"), BYTE_BPE)


def op11_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = id_files.folder_for(spark, shared_dir(spark))
    id_files.write_ids(table(spark, sf_dir, "documents"), folder, BYTE_BPE, end_id=0)
    return id_files.read_ids(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.product_codes(table(spark, sf_dir, "embeddings"), scale=4096.0, parts=8, entries=16, rounds=6)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_decontamination, op2_language_id, op3_simhash_near_dedup, op4_toxicity, op5_suffix_array_dedup,
    op6_exact_top_k, op7_sharding, op8_token_counts, op9_lm_scoring, op10_packing, op11_id_files, op12_vector_codes,
    op13_prefix_trie, pipeline)}

ORACLE_SQL: dict[str, str] = {"op6_exact_top_k": OP6_SQL}
