import pytest

import corpus_pipeline as pipeline
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def test_near_dedup_raises_on_an_id_with_two_texts(spark, docs):
    docs = docs.where("doc_id < 20")
    same = docs.unionByName(docs.where("doc_id = 3"))
    ids = [r.doc_id for r in pipeline.near_dedup(spark, same, SF).collect()]
    assert len(ids) == len(set(ids)) and set(ids) <= set(range(20))
    other = docs.where("doc_id = 3").withColumn("text", F.reverse("text"))
    with pytest.raises(ValueError, match="3"):
        pipeline.near_dedup(spark, docs.unionByName(other), SF)
