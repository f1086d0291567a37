"""One thin query per operator: ``QUERIES[name](spark, sf_dir)``."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from platewise.llm import (
    alignment,
    bpe,
    chat,
    minhash,
    mixing,
    oracle_sql,
    packing,
    pii,
    quality_model,
    quality_rules,
    search,
    sharding,
    substrings,
    vectors,
)

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substrings.remove_repeats(_table(spark, sf_dir, "documents"), window=35)
    return cut.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept"), 256).alias("kept_sha256"))


def op8_chat_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = chat.perspectives(_table(spark, sf_dir, "conversations"))
    spans = F.transform("mask", lambda m: F.concat_ws(":", m["start"].cast("string"), m["end"].cast("string")))
    return seen.withColumn("mask", F.array_join(spans, ","))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(_table(spark, sf_dir, "documents"))
    count = lambda i: F.size(F.filter("base", lambda s: s["kind"] == i)).cast("long")
    return found.select("doc_id", *[count(i).alias(f"n_{k}") for i, k in enumerate(pii.KINDS)],
                        F.sha2(pii.as_text(F.col("base")), 256).alias("base_sha256"), pii.as_text(F.col("spans")).alias("spans"))


def op10_bpe_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = bpe.encode_documents(_table(spark, sf_dir, "documents"), BYTE_BPE)
    text = bpe.decode_documents(ids, BYTE_BPE)
    return text.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                       F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"), k=3, percent=85)


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_model.train(docs, _table(spark, sf_dir, "labels"))
    scored = quality_model.score(docs, model, out="score")
    return scored.select("doc_id", quality_model.held_out("doc_id").alias("held_out"), "score",
                         (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op4_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.link_vectors(_table(spark, sf_dir, "embeddings"), threshold=0.93)


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"), BYTE_BPE, capacity=1024, end_id=2)


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_documents(_table(spark, sf_dir, "documents"), shards=24)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_documents(_table(spark, sf_dir, "documents"), BYTE_BPE, PIECE_BPE)


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(_table(spark, sf_dir, "benchmark"), _table(spark, sf_dir, "documents"), k=20)


def op13_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, sf_dir, "documents"), weights=(5, 2, 1), max_repeat=3)
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_minhash_near_dedup": op2_minhash_near_dedup,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_embedding_near_dedup": op4_embedding_near_dedup,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_sharding": op6_sharding,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_chat_perspectives": op8_chat_perspectives,
    "op9_pii": op9_pii,
    "op10_bpe_roundtrip": op10_bpe_roundtrip,
    "op11_token_alignment": op11_token_alignment,
    "op12_ranked_search": op12_ranked_search,
    "op13_source_mix": op13_source_mix,
}
ORACLE = {
    "op1_quality_rules": quality_rules.oracle(),
    "op2_minhash_near_dedup": oracle_sql.near_duplicates(),
    "op4_embedding_near_dedup": oracle_sql.linked_vectors(),
    "op7_substring_dedup": oracle_sql.removed_repeats(),
    "op8_chat_perspectives": chat.oracle(),
    "op12_ranked_search": search.oracle(),
    "op13_source_mix": mixing.oracle(),
}
