"""Micro-batch serving gives the same answers as the batch lookup."""

from pyspark.sql import functions as F

from platewise.plans import lists
from platewise.session import work_path
from platewise.streaming.micro_batch import start_serving


def test_stream_serving_matches_batch(spark):
    lst = spark.createDataFrame(
        [("default", '[{"id":1,"name":"a"}]'), ("u1", '[{"id":2,"name":"b"}]')],
        "user_id string, gd_dish_types string")
    src = work_path(spark, "requests")
    spark.createDataFrame([("u1",), ("u2",)], "user_id string").write.parquet(src)
    stream = spark.readStream.schema("user_id string").parquet(src)
    sink, ckpt = work_path(spark, "answers"), work_path(spark, "ckpt")
    q = start_serving(stream, lambda: lst, sink, ckpt)
    q.awaitTermination(120)
    got = sorted(map(tuple, spark.read.parquet(sink).drop("batch_id").collect()))
    want = sorted(map(tuple, lists.serve(spark.read.parquet(src), lst).collect()))
    assert got == want
    assert dict((r[0], r[2]) for r in got) == {"u1": False, "u2": True}


def test_stream_tagging_per_batch(spark):
    from platewise.plans import tagging
    from platewise.sources.fixtures import TAGGING_RUN_DATE, Fixtures
    from platewise.streaming.micro_batch import start_tagging

    from conftest import SF_SMALL

    f = Fixtures(spark, SF_SMALL)
    src = work_path(spark, "menus")
    f.menu().write.parquet(src)

    def tag(batch):
        new = tagging.new_menus(batch, f.dish_tagging())
        scored = new.join(f.dish_type_encoder().withColumnRenamed("dish_type_l3", "_n"),
                          F.replace(F.lower("menu_name"), F.lit(" "), F.lit("_")) == F.col("_n")).drop("_n")
        return tagging.decode_tags(scored.withColumn("prob", F.lit(1.0)), f.dish_type_encoder(),
                                   f.category_name_mapper(), f.category_id_mapper(), TAGGING_RUN_DATE,
                                   on_missing="null")

    sink, ckpt = work_path(spark, "tags"), work_path(spark, "ckpt")
    q = start_tagging(spark.readStream.schema(f.menu().schema).parquet(src), tag, sink, ckpt)
    q.awaitTermination(120)
    out = spark.read.parquet(sink)
    assert out.count() == tagging.new_menus(f.menu(), f.dish_tagging()).count()
    first = f.dish_type_encoder().where("category_id = 0").first().dish_type_l3
    zero = tagging.new_menus(f.menu(), f.dish_tagging()).where(F.replace(F.lower("menu_name"), F.lit(" "), F.lit("_")) == first)
    assert out.where(F.col("dish_type_l3") == "other").count() == zero.count()
    assert out.where(F.col("dish_type_l3") == first).count() == 0
