"""The corpus pipeline over ``documents``: every stage is one of the llm operators.

A stage takes (spark, docs, sf_dir) and returns a DataFrame that is written and
read again as the next one's ``docs``.  All but the last return the columns of
``documents``; the last returns the packed pieces.

Defined cases, in every stage: NULL and empty texts pass as the operator defines
them, further columns are kept, an empty table gives no rows, and equal rows are
copies of each other.  A row without an id passes unchanged through the stages that
change texts.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from platewise.llm import minhash, packing, pii, quality_model, substrings
from platewise.llm.common import drop_stored, stored, stored_so_far, with_rows

KEEP_SCORE = 0.7  # a document stays from this score on
SHINGLE_WORDS, SIMILAR_PERCENT = 5, 80
REPEAT_WORDS = 50  # passages of at least so many words that occur elsewhere go


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it learns from ``labels`` beside the documents."""
    model = quality_model.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_model.score(docs, model, out="_score").where(F.col("_score") >= KEEP_SCORE).select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every group of near copies (once, if its row
    repeats).  Raises where an id has two texts, since the operators tell texts by their ids."""
    found = stored(minhash.near_duplicates(docs, k=SHINGLE_WORDS, percent=SIMILAR_PERCENT), "found")
    gone = stored(found.where("NOT kept").select("doc_id").distinct(), "near-copies")
    # only rows whose id repeats are dealt by id, so the other texts aren't moved
    many = stored(found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id"), "repeated-ids")
    _one_text_each(with_rows(docs, many, "doc_id", keep=True))
    left = with_rows(docs, gone, "doc_id", keep=False)
    once = with_rows(left, many, "doc_id", keep=True).dropDuplicates(["doc_id"])
    return with_rows(left, many, "doc_id", keep=False).unionByName(once)


def _one_text_each(docs: DataFrame) -> None:
    digest = F.sha2(F.coalesce(F.col("text"), F.lit("")), 256)
    several = docs.groupBy("doc_id").agg(F.min(digest).alias("a"), F.max(digest).alias("b")).where("a <> b")
    found = [r.doc_id for r in several.select("doc_id").limit(5).collect()]
    if found:
        raise ValueError(f"documents: several texts with one doc_id: {found}")


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that occur elsewhere; untouched texts stay as they are."""
    cut = substrings.remove_repeats(docs, window=REPEAT_WORDS).where("n_removed > 0").select("doc_id", "kept")
    return _replaced(docs, stored(cut, "cut"), F.col("_kept"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind."""
    found = pii.find(docs).where("size(spans) > 0").select("doc_id", "spans")
    return _replaced(docs, stored(found, "spans"), pii.mask(F.col("text"), F.col("_spans")))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in sequences of at most 1024 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), capacity=1024, end_id=2)


def _replaced(docs: DataFrame, changes: DataFrame, text) -> DataFrame:
    """``docs`` with ``text`` for the ids in ``changes`` (doc_id and columns that get a leading
    underscore); only the changed documents are joined, the others are passed on."""
    ids = changes.select("doc_id").distinct()
    own = changes.dropDuplicates(["doc_id"])
    own = own.select(F.col("doc_id").alias("_doc"), *[F.col(c).alias(f"_{c}") for c in own.columns if c != "doc_id"])
    changed = with_rows(docs, ids, "doc_id", keep=True).join(own, F.col("doc_id") == F.col("_doc"))
    changed = changed.withColumn("text", text).select(docs.columns)
    if "n_chars" in docs.columns:
        changed = changed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return with_rows(docs, ids, "doc_id", keep=False).unionByName(changed)


STAGES = [
    ("quality classifier", quality),
    ("near dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("pii", redact),
    ("packing", pack),
]
ORACLE_SQL = None  # the classifier, MinHash and the tokenizer can't be put in SQL; see tests/llm/test_pipeline.py


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, start = spark.read.parquet(f"{sf_dir}/documents.parquet"), stored_so_far()
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        drop_stored(spark, start, keep=1)  # the stage's own tables and its input
    return docs
