"""Hand-made rows for the semantics that decide correctness."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from platewise.functions.arrays import argmax, max_prob, pad_list
from platewise.functions.text import clean_text, normalise_name, percentile_label
from platewise.operators import relational as R
from platewise.plans import gold, lists

D = dt.date(2001, 8, 1)
BASE = T.StructType([
    T.StructField("user_id", T.StringType()), T.StructField("dish_type_l3", T.StringType()),
    T.StructField("category_id", T.IntegerType()), T.StructField("count_order", T.LongType()),
    T.StructField("recent_order_dt", T.DateType())])


def base(spark, rows):
    return spark.createDataFrame(rows, BASE)


def test_one_distinct_count_is_decile_10(spark):
    b = base(spark, [("u", "a", 1, 3, D), ("u", "b", 2, 3, D)])
    out = gold.customer_category(None, None, None, D, base=b).collect()
    assert sorted(r.decile for r in out) == [10, 10]


def test_two_distinct_counts(spark):
    b = base(spark, [("u", "a", 1, 3, D), ("u", "b", 2, 5, D)])
    out = {r.dish_type_l3: r.decile for r in gold.customer_category(None, None, None, D, base=b).collect()}
    assert out == {"a": 5, "b": 10}


def test_null_user_gets_null_decile_and_bare_percentile(spark):
    b = base(spark, [(None, "a", 1, 5, D)])
    r = gold.customer_category(None, None, None, D, base=b).collect()[0]
    assert r.decile is None and r.percentile == "P" and r.rank == 1


def test_empty_dish_consumes_rank_then_is_dropped(spark):
    b = base(spark, [("u", "", 1, 3, dt.date(2001, 1, 1)), ("u", "b", 2, 3, dt.date(2001, 2, 1))])
    out = gold.customer_category(None, None, None, D, base=b).collect()
    assert [(r.dish_type_l3, r.rank) for r in out] == [("b", 2)]


def test_recency_rank_least_recent_first(spark):
    b = base(spark, [("u", "a", 1, 3, dt.date(2001, 3, 1)), ("u", "b", 2, 3, dt.date(2001, 1, 1))])
    out = {r.dish_type_l3: r.rank for r in gold.customer_category(None, None, None, D, base=b).collect()}
    assert out == {"b": 1, "a": 2}


def test_decile_never_ntile():
    # ceil(10 * r / n) for n = 3: 4, 7, 10 (ntile would give 1, 2, 3)
    import math
    for n in range(1, 30):
        for r in range(1, n + 1):
            assert (r * 10 + n - 1) // n == math.ceil(10 * r / n)


def _ids(spark, vals):
    return spark.createDataFrame([(v,) for v in vals], "menu_id long")


def test_not_in_null_aware(spark):
    new = _ids(spark, [1, 2, None])
    assert R.not_in(new, _ids(spark, [1, None]), "menu_id").count() == 0
    plain = sorted(R.not_in(new, _ids(spark, [1, None]), "menu_id", null_aware=False).collect(),
                   key=lambda r: (r[0] is not None, r[0]))
    assert [r[0] for r in plain] == [None, 2]
    assert [r[0] for r in R.not_in(new, _ids(spark, [1]), "menu_id").collect()] == [2]
    assert R.not_in(new, _ids(spark, []), "menu_id").count() == 3


def test_padding_keeps_own_duplicates(spark):
    df = spark.createDataFrame([(["a", "b", "a"], ["b", "c", "d"], 3)], "own array<string>, top array<string>, n long")
    assert df.select(pad_list("own", "top", "n", 10)).first()[0] == ["a", "b", "a", "c", "d"]
    full = spark.createDataFrame([([str(i) for i in range(10)], ["x"], 10)], "own array<string>, top array<string>, n long")
    assert full.select(pad_list("own", "top", "n", 10)).first()[0] == [str(i) for i in range(10)]


def test_character_filter(spark):
    df = spark.createDataFrame([("Pad Thai 100% ‘ผัดไทย’ ฦ๑ é-x",),
                                (None,)], "s string")
    out = [r[0] for r in df.select(clean_text("s")).collect()]
    assert out == ["Pad Thai  ‘ผัดไทย’  x", None]


def test_character_filter_every_bmp_code_point(spark):
    keep = set([0x20, *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x0E01, 0x0E26), *range(0x0E27, 0x0E3B),
                *range(0x0E40, 0x0E4E), 0x2018, 0x2019, 0xFEFF])
    cps = [c for c in range(1, 0x10000) if not (0xD800 <= c <= 0xDFFF)]
    text = "".join(chr(c) for c in cps)
    got = spark.createDataFrame([(text,)], "s string").select(clean_text("s")).first()[0]
    assert got == "".join(chr(c) for c in cps if c in keep)
    assert len(keep) == 127


def test_argmax_tie_and_nan(spark):
    df = spark.createDataFrame([([0.4, 0.4, 0.2],), ([0.1, float("nan"), 0.9],), ([],)], "p array<double>")
    assert [r[0] for r in df.select(argmax("p")).collect()] == [0, 1, None]
    assert df.select(max_prob("p")).first()[0] == 0.4


def test_two_ids_of_one_dish_menu_modes(spark):
    b = base(spark, [("u", "d", 1, 2, D), ("u", "d", 1001, 1, D)])
    faithful = gold.menu_category(None, None, None, D, mode="faithful", base=b)
    by_count = gold.menu_category(None, None, None, D, mode="by_count", base=b)
    assert faithful.count() == 4
    assert by_count.count() == 2


def test_normalise_and_percentile(spark):
    df = spark.createDataFrame([("Tiny Ring", 7), ("x", None)], "n string, d int")
    out = df.select(normalise_name("n"), percentile_label("d")).collect()
    assert [tuple(r) for r in out] == [("tiny_ring", "P7"), ("x", "P")]


def test_decode_label_class_zero_and_strict(spark):
    enc = spark.createDataFrame([(0, "zero"), (1, "one")], "category_id int, dish_type_l3 string")
    df = spark.createDataFrame([(0,), (1,)], "category_id int")
    got = {r.category_id: r.dish_type_l3 for r in R.decode_label(df, enc).collect()}
    assert got == {0: "other", 1: "one"}
    bad = spark.createDataFrame([(5,)], "category_id int")
    with pytest.raises(Exception):
        R.decode_label(bad, enc).collect()
    assert R.decode_label(bad, enc, strict=False).first().dish_type_l3 is None


def test_map_strict_and_passthrough(spark):
    m = spark.createDataFrame([("a", 1)], "category_name string, category_id int")
    df = spark.createDataFrame([("a",), ("b",)], "n string")
    with pytest.raises(Exception):
        R.map_strict(df, "n", m, "category_name", "category_id", "id").collect()
    got = {r.n: r.id for r in R.map_strict(df, "n", m, "category_name", "category_id", "id", "null").collect()}
    assert got == {"a": 1, "b": None}
    ren = spark.createDataFrame([("a", "z")], "k string, v string")
    got = {r.n for r in R.map_or_self(df, "n", ren, "k", "v").collect()}
    assert got == {"z", "b"}


def test_changed_rows_null_semantics(spark):
    today = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    prev = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    assert R.changed_rows(today, prev, ["a", "b"]).count() == 1
    assert R.changed_rows(today, prev, ["a", "b"], null_safe=True).count() == 0


def test_list_ids_strict_fails_on_unknown_dish(spark):
    cc = spark.createDataFrame([("u", "mystery", 1, 10, 1)],
                               "user_id string, dish_type_l3 string, category_id int, decile int, rank int")
    pop = spark.createDataFrame([("mystery", 5)], "dish_type_l3 string, total_orders long")
    idm = spark.createDataFrame([("known", 1)], "category_name string, category_id int")
    with pytest.raises(Exception):
        lists.customer_lists(cc, pop, idm, D).collect()
    out = {r.user_id: r.gd_dish_types for r in lists.customer_lists(cc, pop, idm, D, strict=False).collect()}
    assert out["u"] == '[{"name":"mystery"}]'


def test_default_row_is_never_padded(spark):
    cc = spark.createDataFrame([("u", "a", 1, 10, 1)],
                               "user_id string, dish_type_l3 string, category_id int, decile int, rank int")
    pop = spark.createDataFrame([(f"d{i}", 100 - i) for i in range(3)], "dish_type_l3 string, total_orders long")
    idm = spark.createDataFrame([("a", 1)] + [(f"d{i}", 10 + i) for i in range(3)],
                                "category_name string, category_id int")
    out = {r.user_id: r for r in lists.customer_lists(cc, pop, idm, D).collect()}
    assert out["default"].sv_dish_count == 10 and out["default"].sv_dish_types == ["d0", "d1", "d2"]
    assert out["u"].sv_dish_types == ["a"]
    assert out["u"].gd_dish_types.startswith('[{"id":1,"name":"a"},{"id":10,"name":"d0"}')


def test_retro_window_inclusive_both_ends(spark):
    days = [dt.date(2001, 7, 24), dt.date(2001, 7, 25), dt.date(2001, 8, 1), dt.date(2001, 8, 2)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = [r.d for r in df.where(R.in_retro("d", D, 7)).orderBy("d").collect()]
    assert got == [dt.date(2001, 7, 25), dt.date(2001, 8, 1)]


def test_exclude_list_drops_null_too(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "d string")
    assert [r.d for r in R.exclude_values(df, "d", ["a"]).collect()] == ["b"]


def test_renamed_shop_splits_counts_and_one_row_survives(spark):
    orders = spark.createDataFrame(
        [(1, 10, "Old name", dt.datetime(2001, 1, 1)), (2, 10, "New name", dt.datetime(2001, 1, 2)),
         (3, 10, "New name", dt.datetime(2001, 1, 3))],
        "order_id long, shop_id long, shop_name string, updt_dttm timestamp")
    items = spark.createDataFrame([(1, 7), (1, 7), (2, 7), (3, 8)], "order_id long, menu_id long")
    tags = spark.createDataFrame([(7, "a", 1), (8, "b", 2)],
                                 "menu_id long, new_dish_type_l3 string, new_category_id int")
    out = gold.shop_category(orders, items, tags, D).collect()
    # counts are lines: (Old, a) 2, (New, a) 1, (New, b) 1 -> one row per shop_id
    assert [(r.shop_id, r.shop_name, r.shop_category, r.order_count) for r in out] == [(10, "Old name", "a", 2)]


def test_null_users_left_out_of_lists(spark):
    cc = spark.createDataFrame([(None, "a", 1, None, 1), ("u", "a", 1, 10, 1)],
                               "user_id string, dish_type_l3 string, category_id int, decile int, rank int")
    pop = spark.createDataFrame([("a", 5)], "dish_type_l3 string, total_orders long")
    idm = spark.createDataFrame([("a", 1)], "category_name string, category_id int")
    users = sorted(r.user_id for r in lists.customer_lists(cc, pop, idm, D).collect())
    assert users == ["default", "u"]


def test_literal_row_and_safe_conform(spark):
    from platewise.schemas import CUSTOMER_CATEGORY_LIST
    from platewise.sources.tables import literal_row

    row = literal_row(spark, CUSTOMER_CATEGORY_LIST, user_id="default", sv_dish_types=["a", "b"],
                      sv_dish_count=10).first()
    assert (row.user_id, row.sv_dish_types, row.sv_dish_count, row.gd_dish_types) == ("default", ["a", "b"], 10, None)
    df = spark.createDataFrame([("7",), ("x",)], "category_id string")
    schema = T.StructType([T.StructField("category_id", T.IntegerType())])
    assert [r[0] for r in R.conform(df, schema, safe=True).collect()] == [7, None]
    with pytest.raises(Exception):
        R.conform(df, schema).collect()


def test_pad_list_properties_on_random_cases(spark):
    import random

    rnd = random.Random(3)
    names = [f"d{i}" for i in range(25)]
    cases = []
    for _ in range(500):
        own = rnd.choices(names, k=rnd.randint(0, 12))
        cases.append((own, rnd.sample(names, rnd.randint(0, 25)), rnd.choice([len(own), 10])))
    df = spark.createDataFrame(cases, "own array<string>, top array<string>, n long")
    for own, top, n, got in df.select("own", "top", "n", pad_list("own", "top", "n", 10)).collect():
        kept, added = got[:len(own)], got[len(own):]
        assert kept == own[:10] and len(got) <= 10
        if n >= 10:
            assert added == []
        else:  # the unseen popular names in their order, as many as fit
            unseen = sorted(set(top) - set(own), key=top.index)
            assert added == unseen[:len(added)]
            assert len(got) == 10 or len(added) == len(unseen)


def test_recency_rank_goes_by_time_of_day(spark):
    t = dt.datetime
    orders = spark.createDataFrame([(1, "u", t(2001, 8, 1, 18), "COMPLETE"), (2, "u", t(2001, 8, 1, 9), "COMPLETE")],
                                   "order_id long, user_id string, order_date timestamp, order_status string")
    items = spark.createDataFrame([(1, 10), (2, 20)], "order_id long, menu_id long")
    tags = spark.createDataFrame([(10, "a", 1), (20, "b", 2)], "menu_id long, new_dish_type_l3 string, new_category_id int")
    got = {r.dish_type_l3: (r["rank"], r.recent_order_dt) for r in gold.customer_category(orders, items, tags, D).collect()}
    assert got == {"b": (1, D), "a": (2, D)}


def test_area_counts_the_whole_run_date(spark):
    t = dt.datetime
    rows = [(1, 20.0, 5, t(2001, 8, 1, 0), t(2001, 8, 1)), (2, 10.0, 5, t(2001, 8, 1, 13), t(2001, 8, 1)),
            (3, 7.0, 5, t(2001, 8, 2, 0), t(2001, 8, 2)), (4, 3.0, 5, t(2001, 7, 31, 23), t(2001, 8, 1)),
            (5, 9.0, 5, t(2001, 7, 30, 23), t(2001, 8, 1))]
    schema = "order_id long, total_amount double, shop_id long, order_date {}, updt_dttm timestamp"
    items = spark.createDataFrame([(i, 10) for i in range(1, 6)], "order_id long, menu_id long")
    tags = spark.createDataFrame([(10, "a", 1)], "menu_id long, new_dish_type_l3 string, new_category_id int")
    shop = spark.createDataFrame([(5, 1)], "shop_id long, address_id long")
    address = spark.createDataFrame([(1, "x")], "address_id long, address_subdistrict string")
    times = spark.createDataFrame(rows, schema.format("timestamp"))
    for orders in (times, times.withColumn("order_date", F.to_date("order_date"))):
        r = gold.area_category(orders, items, shop, address, tags, [D], [1]).collect()
        assert [(x.total_amount, x.total_orders) for x in r] == [(33.0, 3)]
