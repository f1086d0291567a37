"""Two business days in order, and a rerun of the second."""

import datetime as dt

from pyspark.sql import functions as F

from platewise.plans import daily
from platewise.session import work_path
from platewise.sources.fixtures import EXCLUDE, PREV_CUTOFF, PREV_RUN_DATE, RUN_DATE, Fixtures

from conftest import SF_SMALL


def _inputs(f, cutoff=None):
    o = f.order_transaction()
    if cutoff is not None:
        o = o.where(F.col("order_date") < F.lit(cutoff))
    return daily.Inputs(o, f.order_item(), f.shop(), f.address(), f.menu(), f.dish_type_encoder(),
                        f.category_name_mapper(), f.category_id_mapper())


def test_two_days_and_a_rerun(spark):
    f = Fixtures(spark, SF_SMALL)
    out = daily.Layout(work_path(spark, "daily"))
    tags = f.dish_tagging()
    daily.run_day(spark, _inputs(f, PREV_CUTOFF), out, PREV_RUN_DATE, tags, EXCLUDE)
    first = daily.run_day(spark, _inputs(f), out, RUN_DATE, tags, EXCLUDE)
    first_changes = sorted(map(tuple, daily.sinks.read_snapshot(spark, out.path("shop_category_change")).collect()))
    again = daily.run_day(spark, _inputs(f), out, RUN_DATE, tags, EXCLUDE)

    area = spark.read.parquet(out.path("area_category"))
    per_day = {r.busi_dt: r.n for r in area.groupBy("busi_dt").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert set(per_day) == {PREV_RUN_DATE, RUN_DATE}
    one_day = daily.gold.area_category(f.order_transaction(), f.order_item(), f.shop(), f.address(), tags,
                                       [RUN_DATE]).count()
    assert per_day[RUN_DATE] == one_day  # the rerun replaced the day

    assert first.count() == again.count() == again.select("user_id").distinct().count()
    assert again.where(F.col("user_id") == "default").count() == 1

    # the rerun compares with the day before, so it finds the same changes again
    changes = daily.sinks.read_snapshot(spark, out.path("shop_category_change"))
    assert first_changes and sorted(map(tuple, changes.collect())) == first_changes
    # of the list table the newest versions stay
    assert len(daily.sinks._versions(spark, out.path("customer_category_list"))) == 2
    kv = daily.sinks.read_snapshot(spark, out.path("customer_category_kv"))
    assert kv.count() == again.count()
    assert kv.where(~F.col("key").startswith('["')).count() == 0


def test_tagging_appends_only_new_menus(spark):
    from platewise.plans import ml, tagging

    f = Fixtures(spark, SF_SMALL)
    rows = ml.encode_labels(f.dish_tagging().select("menu_name", "dish_type_l3"), "dish_type_l3", f.dish_type_encoder())
    model_path = work_path(spark, "model")
    ml.save_model(ml.train_text(rows, "menu_name", max_iter=20, num_features=1 << 11, reg=1e-6), f.dish_type_encoder(), model_path)
    src = daily.Inputs(None, None, None, None, f.menu(), None, f.category_name_mapper(), f.category_id_mapper())
    out = daily.Layout(work_path(spark, "daily-tags"))
    seed = f.dish_tagging()
    new = tagging.new_menus(f.menu(), seed)
    t1 = daily.tag_day(spark, src, out, model_path, dt.date(2001, 8, 1), seed_tags=seed, on_missing="null")
    assert t1.count() == seed.count() + new.count()
    days = {r.run_date: r.n for r in t1.groupBy("run_date").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert days == {dt.date(2001, 7, 31): seed.count(), dt.date(2001, 8, 1): new.count()}
    # the name decides the class, and seen names are known
    wrong = t1.join(seed.select("menu_name").distinct(), "menu_name", "left_semi").where((F.col("dish_type_l3") != "other") & (F.col("dish_type_l3") != F.replace(F.lower("menu_name"), F.lit(" "), F.lit("_"))))
    assert wrong.count() == 0
    before = {r[0] for r in t1.select(F.input_file_name()).distinct().collect()}
    t2 = daily.tag_day(spark, src, out, model_path, dt.date(2001, 8, 2), on_missing="null")
    # nothing new the second day: nothing is written
    assert {r[0] for r in t2.select(F.input_file_name()).distinct().collect()} == before
    assert t2.select("menu_id").distinct().count() == t2.count() == t1.count()
