import pytest

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs_rows(spark):
    """(doc_id, text) of the smallest table, plus hard texts with ids from 10**6 on."""
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    hard = [None, "", " \n\t ", "one", "a b", "<|endoftext|>", "x" * 5000, "word " * 3000, "it's 'll we've don''t",
            "é中\U0001f642   \x1c tail  ", "line\nline\n\nline\n", "a b c a b c a b c", rows[0][1], rows[0][1]]
    return rows + [(10**6 + i, t) for i, t in enumerate(hard)]


@pytest.fixture(scope="session")
def docs(spark, docs_rows):
    """Those rows as documents, with further columns whose names clash with the operators' own."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(docs_rows, "doc_id long, text string")
    return df.select("doc_id", "text", F.lit("en").alias("lang"), F.lit("src").alias("source"),
                     F.length("text").cast("long").alias("n_chars"), F.lit(7).alias("shard"), F.lit("x").alias("ids"),
                     F.lit(1).alias("_key"), F.lit(2).alias("component_id"), F.lit(3).alias("score"))
