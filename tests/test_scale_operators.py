"""Operators built for hot groups and one-pass windows agree with their plain forms."""

import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from platewise.operators import relational as R
from platewise.plans import gold
from platewise.sources.fixtures import RUN_DATE, WINDOWS, Fixtures
from platewise.sources import sinks
from platewise.session import work_path

from conftest import SF_SMALL


def test_rank_in_group_equals_row_number_with_a_hot_group(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(6000):
        g = "hot" if i % 3 else f"g{rnd.randint(0, 40)}"  # a third... two thirds in one group
        rows.append((g, rnd.randint(1, 5), f"u{i:05d}"))
    df = spark.createDataFrame(rows, "g string, c int, u string")
    order = [F.col("c").asc(), F.col("u").asc()]
    got = R.rank_in_group(df, "g", order, "rk", "n", num_partitions=8)
    w = Window.partitionBy("g").orderBy(*order)
    want = df.withColumn("rk", F.row_number().over(w)).withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("g")))
    a = sorted((r.g, r.u, r.rk, r.n) for r in got.collect())
    b = sorted((r.g, r.u, r.rk, r.n) for r in want.collect())
    assert a == b


def test_one_pass_area_equals_union_of_single_windows(spark):
    f = Fixtures(spark, SF_SMALL)
    args = (f.order_transaction(), f.order_item(), f.shop(), f.address(), f.dish_tagging())
    one = gold.area_category(*args, [RUN_DATE], WINDOWS)
    union = None
    for n in WINDOWS:
        part = gold.area_category(*args, [RUN_DATE], [n])
        union = part if union is None else union.unionByName(part)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, union.collect()))


def test_backfill_equals_separate_runs(spark):
    f = Fixtures(spark, SF_SMALL)
    args = (f.order_transaction(), f.order_item(), f.shop(), f.address(), f.dish_tagging())
    d2 = dt.date(2001, 6, 30)
    both = gold.area_category(*args, [d2, RUN_DATE], WINDOWS)
    sep = gold.area_category(*args, [d2], WINDOWS).unionByName(gold.area_category(*args, [RUN_DATE], WINDOWS))
    assert sorted(map(tuple, both.collect())) == sorted(map(tuple, sep.collect()))


def test_upsert_keeps_keys_unique_and_is_idempotent(spark):
    t = sinks.KeyedTable(work_path(spark, "kt"), ["k"])
    t.upsert(spark.createDataFrame([("a", 1), ("b", 1), (None, 9)], "k string, v int"))
    t.upsert(spark.createDataFrame([("b", 2), ("c", 2)], "k string, v int"))
    first = sorted(map(tuple, t.read(spark).collect()))
    t.upsert(spark.createDataFrame([("b", 2), ("c", 2)], "k string, v int"))
    assert first == sorted(map(tuple, t.read(spark).collect())) == [("a", 1), ("b", 2), ("c", 2)]


def test_upsert_rejects_duplicate_keys(spark):
    import pytest

    t = sinks.KeyedTable(work_path(spark, "kt"), ["k"])
    with pytest.raises(Exception, match="duplicate key"):
        t.upsert(spark.createDataFrame([("a", 1), ("a", 2)], "k string, v int"))
    assert t.read(spark) is None  # nothing committed
    t.upsert(spark.createDataFrame([("a", 1)], "k string, v int"))  # the next write still works
    assert [tuple(r) for r in t.read(spark).collect()] == [("a", 1)]
    with pytest.raises(sinks.DuplicateKeyError):
        sinks.check_unique(spark.createDataFrame([("a", 1), ("a", 2)], "k string, v int"), ["k"])


def test_append_rerun_does_not_double_a_day(spark):
    path = work_path(spark, "app")
    df = spark.createDataFrame([(1, dt.date(2001, 8, 1)), (2, dt.date(2001, 8, 1))], "x int, busi_dt date")
    sinks.write_append(df, path)
    sinks.write_append(df, path)
    sinks.write_append(spark.createDataFrame([(3, dt.date(2001, 8, 2))], "x int, busi_dt date"), path)
    assert sinks.read_table_dir(spark, path).count() == 3


def test_schema_evolution(spark):
    old = spark.createDataFrame([(1,)], "a int")
    new = spark.createDataFrame([(2, "x")], "a int, b string")
    out = sorted(map(tuple, sinks.union_evolve(old, new).collect()))
    assert out == [(1, None), (2, "x")]


def test_area_versions_with_different_order_dates(spark):
    """An order whose versions moved in time counts, per window, for the newest
    version whose date is inside that window."""
    d = dt.date
    orders = spark.createDataFrame(
        [(1, 100.0, 10, d(2001, 7, 30), dt.datetime(2001, 7, 30)),   # old version, recent date
         (1, 80.0, 10, d(2001, 6, 1), dt.datetime(2001, 7, 31)),     # newest version, older date
         (2, 50.0, 10, d(2001, 8, 1), dt.datetime(2001, 8, 1))],
        "order_id long, total_amount double, shop_id long, order_date date, updt_dttm timestamp")
    items = spark.createDataFrame([(1, 7), (1, 8), (2, 8)], "order_id long, menu_id long")
    tags = spark.createDataFrame([(7, "a", 1), (8, "b", 2)],
                                 "menu_id long, new_dish_type_l3 string, new_category_id int")
    shop = spark.createDataFrame([(10, 5)], "shop_id long, address_id int")
    address = spark.createDataFrame([(5, "X")], "address_id int, address_subdistrict string")
    out = gold.area_category(orders, items, shop, address, tags, [RUN_DATE], [7, 120])
    got = sorted((r.num_retro_days, r.dish_type_l3, r.total_amount, r.total_orders) for r in out.collect())
    # 7 days: order 1 only has its old version (dish a first), order 2 dish b
    # 120 days: order 1's newest version (amount 80, dish a first), order 2 dish b
    assert got == [(7, "a", 100.0, 1), (7, "b", 50.0, 1), (120, "a", 80.0, 1), (120, "b", 50.0, 1)]


def test_read_after_schema_growth(spark):
    path = work_path(spark, "grow")
    sinks.write_append(spark.createDataFrame([(1, dt.date(2001, 8, 1))], "x int, busi_dt date"), path)
    sinks.write_append(spark.createDataFrame([(2, "y", dt.date(2001, 8, 2))], "x int, y string, busi_dt date"), path)
    got = sorted(map(tuple, sinks.read_table_dir(spark, path, merge_schema=True).select("x", "y").collect()))
    assert got == [(1, None), (2, "y")]


def test_area_all_dishes_attribution(spark):
    d = dt.date
    orders = spark.createDataFrame(
        [(1, 100.0, 10, d(2001, 7, 30), dt.datetime(2001, 7, 31)),
         (1, 40.0, 10, d(2001, 7, 30), dt.datetime(2001, 7, 30))],
        "order_id long, total_amount double, shop_id long, order_date date, updt_dttm timestamp")
    items = spark.createDataFrame([(1, 7), (1, 8), (1, 8)], "order_id long, menu_id long")
    tags = spark.createDataFrame([(7, "a", 1), (8, "b", 2)],
                                 "menu_id long, new_dish_type_l3 string, new_category_id int")
    shop = spark.createDataFrame([(10, 5)], "shop_id long, address_id int")
    address = spark.createDataFrame([(5, "X")], "address_id int, address_subdistrict string")
    one = gold.area_category(orders, items, shop, address, tags, [RUN_DATE], [7])
    every = gold.area_category(orders, items, shop, address, tags, [RUN_DATE], [7], attribution="all_dishes")
    assert sorted((r.dish_type_l3, r.total_amount, r.total_orders) for r in one.collect()) == [("a", 100.0, 1)]
    # each distinct dish of the newest version counts the order once, with the newest amount
    assert sorted((r.dish_type_l3, r.total_amount, r.total_orders) for r in every.collect()) == [
        ("a", 100.0, 1), ("b", 100.0, 1)]
