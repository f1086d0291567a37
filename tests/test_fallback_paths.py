"""The paths taken above the size bounds give the same rows as the small paths."""

import pytest
import pyspark.sql.functions as F

from platewise.operators import relational as R
from platewise.plans import gold, lists
from platewise.sources.fixtures import RUN_DATE, Fixtures

from conftest import SF_SMALL


def _rows(df):
    return sorted(map(lambda r: tuple(str(x) for x in r), df.collect()))


def test_shuffle_join_when_tags_exceed_broadcast_bound(spark, monkeypatch):
    f = Fixtures(spark, SF_SMALL)
    small = gold.customer_category(f.order_transaction(), f.order_item(), f.dish_tagging(), RUN_DATE)
    want = _rows(small)
    monkeypatch.setattr(R, "BROADCAST_MAX_ROWS", 1)
    monkeypatch.setattr(gold, "sized_broadcast", lambda df, max_rows=1: R.sized_broadcast(df, 1))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = gold.customer_category(f.order_transaction(), f.order_item(), f.dish_tagging(), RUN_DATE)
        plan = big._jdf.queryExecution().executedPlan().toString()
        got = _rows(big)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == want
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan


def test_menu_and_shop_counts_when_tags_exceed_broadcast_bound(spark, monkeypatch):
    f = Fixtures(spark, SF_SMALL)
    args = f.order_transaction(), f.order_item(), f.dish_tagging(), RUN_DATE
    want = _rows(gold.menu_category(*args)), _rows(gold.shop_category(*args))
    monkeypatch.setattr(gold, "sized_broadcast", lambda df, max_rows=1: R.sized_broadcast(df, 1))
    assert (_rows(gold.menu_category(*args)), _rows(gold.shop_category(*args))) == want


def test_repeated_and_null_mapper_names_at_either_size(spark, monkeypatch):
    cc = spark.createDataFrame([("u", "a", 1, 10, 1), ("u", "b", 1, 9, 1)],
                               "user_id string, dish_type_l3 string, category_id int, decile int, rank int")
    pop = spark.createDataFrame([("a", 5), ("c", 4)], "dish_type_l3 string, total_orders long")
    ids = spark.createDataFrame([("a", 1), ("a", 7), ("b", 2), ("c", 3), (None, 9)], "category_name string, category_id int")
    want = [("default", '[{"id":7,"name":"a"},{"id":3,"name":"c"}]'),
            ("u", '[{"id":7,"name":"a"},{"id":2,"name":"b"},{"id":3,"name":"c"}]')]
    for bound in (1_000_000, 1):
        monkeypatch.setattr(lists, "sized_broadcast", lambda df, max_rows=0, n=bound: R.sized_broadcast(df, n))
        got = lists.customer_lists(cc, pop, ids, RUN_DATE).select("user_id", "gd_dish_types")
        assert sorted(map(tuple, got.collect())) == want
        names = spark.createDataFrame([("u", ["a", "b"]), ("v", [])], "user_id string, names array<string>")
        items = {r.user_id: [tuple(x) for x in r["items"]] for r in lists.dish_structs(names, ids, "names", "items").collect()}
        assert items == {"u": [(7, "a"), (2, "b")], "v": []}
        for missing in (lists.customer_lists(cc, pop, ids.where("category_id <> 2"), RUN_DATE),
                        lists.dish_structs(names, ids.where("category_id <> 2"), "names", "items")):
            with pytest.raises(Exception, match="no category id for b"):
                missing.collect()


def test_rank_blocks_without_broadcast(spark, monkeypatch):
    df = spark.range(3000).select((F.col("id") % 3).alias("g"), F.col("id").alias("v"))
    want = _rows(R.rank_in_group(df, "g", [F.col("v").asc()], "rk", "n", num_partitions=6))
    monkeypatch.setattr(R, "BROADCAST_MAX_ROWS", 1)
    orig = R.sized_broadcast
    monkeypatch.setattr(R, "sized_broadcast", lambda d, max_rows=1: orig(d, 1))
    got = _rows(R.rank_in_group(df, "g", [F.col("v").asc()], "rk", "n", num_partitions=6))
    assert got == want
    assert {r for r in want if r[0] == "0"} and all(1 <= int(r[2]) <= 1000 for r in want)


def test_serve_paths_agree(spark, monkeypatch):
    lst = spark.createDataFrame([("default", "[d]"), ("u1", "[a]"), ("u2", "[b]")],
                                "user_id string, gd_dish_types string")
    req = spark.createDataFrame([("u1",), ("u1",), ("u3",), (None,)], "user_id string")
    small = lists.serve(req, lst)
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
    want = sorted(map(lambda r: tuple(str(x) for x in r), small.collect()))
    orig = R.sized_broadcast
    monkeypatch.setattr(lists, "sized_broadcast", lambda d, max_rows=1: orig(d, 1))
    got = sorted(map(lambda r: tuple(str(x) for x in r), lists.serve(req, lst).collect()))
    assert got == want
    assert ("u3", "[d]", "True") in want and ("u1", "[a]", "False") in want and ("None", "[d]", "True") in want


def test_broadcast_bound_counts_bytes(spark):
    df = spark.createDataFrame([(i, "x" * 1000, ["y" * 100]) for i in range(10)], "k long, v string, a array<string>")
    assert R.sized_broadcast(df) is not df
    assert R.sized_broadcast(df, max_bytes=10_000) is df and R.sized_broadcast(df, max_rows=9) is df
    assert R.sized_broadcast(df.limit(0), max_bytes=0) is not df


def _above_the_bound(monkeypatch):
    monkeypatch.setattr(gold, "sized_broadcast", lambda df, max_rows=1: R.sized_broadcast(df, 1))


def test_lines_meet_large_tags_in_one_shuffle(spark, monkeypatch):
    """Orders meet their lines first; no count per menu is shuffled before the tags are joined."""
    f = Fixtures(spark, SF_SMALL)
    tags = f.dish_tagging().unionByName(f.dish_tagging().limit(5))  # a menu tagged twice counts twice
    items = f.order_item().unionByName(spark.range(400).select(F.lit(8).cast("long").alias("order_id"), F.lit(3).cast("long").alias("menu_id")))
    want = [_rows(gold.shop_counts(f.order_transaction(), items, tags)), _rows(gold.user_dish_counts(f.order_transaction(), items, tags, None))]
    _above_the_bound(monkeypatch)
    for conf in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled"):
        spark.conf.set(conf, "-1" if "auto" in conf else "false")
    try:
        for k, got in enumerate((gold.shop_counts(f.order_transaction(), items, tags), gold.user_dish_counts(f.order_transaction(), items, tags, None))):
            plan = got._jdf.queryExecution().executedPlan().toString()
            assert "BroadcastHashJoin" not in plan and plan.count("HashAggregate(") == 2, plan  # partial and final
            assert _rows(got) == want[k]
    finally:
        for conf in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled"):
            spark.conf.unset(conf)


def test_area_joins_large_tags_to_the_span_s_lines_only(spark, monkeypatch):
    import datetime as dt

    f = Fixtures(spark, SF_SMALL)
    args = f.order_transaction(), f.order_item(), f.shop(), f.address(), f.dish_tagging(), [RUN_DATE], (1, 7)
    want, met, split = _rows(gold.area_category(*args)), [], gold.split_hot_join
    _above_the_bound(monkeypatch)
    monkeypatch.setattr(gold, "split_hot_join", lambda big, small, key, **kw: met.append(big.count()) or split(big, small, key, **kw))
    assert _rows(gold.area_category(*args)) == want and want
    held = f.order_transaction().where((F.col("order_date") >= F.lit(RUN_DATE - dt.timedelta(days=7))) & (F.col("order_date") < F.lit(RUN_DATE + dt.timedelta(days=1))))
    assert met == [held.join(f.order_item(), "order_id").count()] and met[0] < f.order_item().count() / 10


def test_menu_fan_out_takes_one_shuffle_of_the_ranks(spark):
    """Every row once per row of its (user, dish); users and dishes that are NULL once, without a decile."""
    rows = [("u", "a", 1, 4), ("u", "a", 2, 4), ("u", "a", 1001, 1), ("v", "a", 1, 9), (None, "a", 1, 2), (None, "a", 2, 2),
            ("u", "b", 3, 1), ("w", "", 5, 1), ("v", "b", 3, 7), ("v", "b", 1003, 7)]
    base = spark.createDataFrame(rows, "user_id string, dish_type_l3 string, category_id int, count_order long")
    order = sorted(rows, key=lambda r: (r[1], r[0] is not None, r[0] or "", r[2]))
    size = {d: sum(r[1] == d for r in rows) for _, d, *_ in rows}
    rank = {r[:3]: 1 + sum(x[1] == r[1] for x in order[:i]) for i, r in enumerate(order)}
    want = [(*r[:3], r[3], -(-10 * rank[o[:3]] // size[r[1]])) for r in rows for o in rows if r[:2] == o[:2] and r[0] is not None and r[1]]
    want += [(*r[:3], r[3], None) for r in rows if r[0] is None]
    made = gold.menu_category(None, None, None, RUN_DATE, base=base)
    got = made.select("user_id", "dish_type_l3", "category_id", "count_order", "decile")
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
    assert made._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1  # the blocks' only
