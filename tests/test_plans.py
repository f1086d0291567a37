"""Plan shape: no Python in gold plans, pruned scans, one shuffle per key."""

import re

from platewise.queries import all_queries

from conftest import SF_SMALL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_gold_plans_have_no_python(spark):
    qs = all_queries()
    for k in ("customer_category", "shop_category", "area_category", "agg_popularity"):
        p = plan(qs[k](spark, SF_SMALL))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, k


def test_scan_reads_only_needed_columns(spark):
    scans = all_queries()["customer_category"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().collectLeaves().toString()
    read = [set(re.findall(r"(\w+):", cols)) for cols in re.findall(r"ReadSchema: struct<([^>]*)>", scans)]
    assert {"order_id", "user_id", "order_status", "order_date"} in read and {"order_id", "menu_id"} in read, scans


def test_decile_needs_no_self_join(spark):
    df = all_queries()["customer_category"](spark, SF_SMALL)
    p = df._jdf.queryExecution().optimizedPlan().toString()
    # the decile comes from dense_rank over the user, not distinct + join back
    assert "dense_rank" in p


def test_area_windows_reuse_the_order_join_partitioning(spark):
    """With sort-merge joins (large inputs), the per-order picks run in the
    order_id partitioning of the join: no exchange keyed by the window columns."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        p = plan(all_queries()["area_category"](spark, SF_SMALL))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    exchanges = [line.strip() for line in p.splitlines() if "Exchange hashpartitioning" in line]
    assert not any("run_date" in e.split("),")[0] and "address_subdistrict" not in e for e in exchanges), exchanges
    assert "SortMergeJoin" in p


def test_customer_windows_share_one_user_shuffle(spark):
    p = plan(all_queries()["customer_category"](spark, SF_SMALL))
    by_user = [line for line in p.splitlines() if "Exchange hashpartitioning(user_id#" in line and "," not in
               line.split("hashpartitioning(")[1].split(")")[0].replace(", 8", "").replace(", 200", "")]
    assert len(by_user) <= 1, by_user


def test_bucketed_order_tables_join_without_shuffle(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for k in ("customer_category", "shop_category", "area_category"):
            p = plan(all_queries()[k](spark, SF_SMALL))
            assert "SortMergeJoin [order_id" in p, k
            assert "Exchange hashpartitioning(order_id" not in p, k
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_area_prunes_month_partitions(spark):
    import uuid

    from pyspark.sql import functions as F

    from platewise.plans import gold
    from platewise.session import work_path
    from platewise.sources import sinks
    from platewise.sources.fixtures import RUN_DATE, WINDOWS, Fixtures

    f = Fixtures(spark, SF_SMALL)
    o = f.order_transaction().withColumn("order_month", F.trunc("order_date", "month"))
    name = f"orders_by_month_{uuid.uuid4().hex[:8]}"
    stored = sinks.write_bucketed(o, name, work_path(spark, name), ["order_id"], 8, ["order_month"])
    args = (f.order_item(), f.shop(), f.address(), f.dish_tagging(), [RUN_DATE], WINDOWS)
    pruned = gold.area_category(stored, *args, month_col="order_month")
    p = plan(pruned)
    assert "PartitionFilters: [isnotnull(order_month" in p and "order_month#" in p
    want = gold.area_category(f.order_transaction(), *args)
    assert sorted(map(tuple, pruned.collect())) == sorted(map(tuple, want.collect()))


def test_bucket_count_grows_with_the_input(spark):
    from platewise.sources import fixtures

    counts = [fixtures.bucket_count(b) for b in (0, 1 << 30, 1 << 40, 100 << 40)]
    assert counts == [8, 8, 4096, 409600]
    assert fixtures.input_bytes(spark, [f"{SF_SMALL}/orders.parquet"]) > 10_000


def test_an_order_bucket_holds_no_more_where_the_input_grows(spark):
    import uuid

    from platewise.session import work_path
    from platewise.sources import fixtures, sinks

    for stored_bytes in (1 << 30, 6 << 30, 60 << 30):
        assert stored_bytes / fixtures.order_buckets(stored_bytes) <= 16 << 20
    assert fixtures.order_buckets(1 << 50) == 100_000  # Spark takes no more
    name = f"orders_{uuid.uuid4().hex[:8]}"
    rows = spark.range(10_000).withColumnRenamed("id", "order_id").repartition(20)
    stored = sinks.write_bucketed(rows, name, work_path(spark, name), ["order_id"], 8)
    assert len(stored.inputFiles()) == 8 and stored.distinct().count() == 10_000  # a file per bucket, not per task


def test_shuffles_follow_the_order_tables(spark, monkeypatch):
    """A task of a shuffle gets no more where the tables grow, whatever number the session began with."""
    from platewise import session
    from platewise.sources import fixtures

    number, size = "spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    was = spark.conf.get(number)
    monkeypatch.setattr(fixtures, "input_bytes", lambda *_: 6 << 30)
    monkeypatch.setattr(fixtures, "_STORED", {(spark.conf.get("spark.app.id"), "big", "order_item"): ("path", f"{SF_SMALL}/lineitem.parquet")})
    try:
        fixtures.Fixtures(spark, "big").order_item()
        assert int(spark.conf.get(number)) == fixtures.order_buckets(6 << 30) > 300
        assert spark.conf.get(size) in (str(16 << 20), f"{16 << 20}b")
        session.size_shuffles(spark, 8)
        assert int(spark.conf.get(number)) > 300  # raised only
    finally:
        spark.conf.set(number, was)


def test_cluster_without_shared_folder_is_an_error():
    import pytest

    from platewise.session import ensure_checkpoint_dir, is_local

    class Nothing:
        master = "spark://host:7077"

        def get(self, *_):
            return None

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return self

    class Session:
        conf = sparkContext = Nothing()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())
    assert is_local("local[*]") and is_local("local") and not is_local("local-cluster[2,1,1024]") and not is_local("yarn")


def test_small_shuffles_stay_small(spark):
    """A session that gives a task less than 16 MB of a shuffle keeps that."""
    from platewise import session

    sizes = ["spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes"]
    was = [spark.conf.get(k) for k in sizes]
    try:
        for k in sizes:
            spark.conf.set(k, "8m")
        session.size_shuffles(spark, 8)
        assert all(spark.conf.get(k) in ("8m", f"{8 << 20}b") for k in sizes)
    finally:
        for k, v in zip(sizes, was):
            spark.conf.set(k, v)


def test_lines_are_counted_in_the_buckets_of_their_orders(spark):
    """The first shop of an order is found behind the shuffle by order, in a bucket: before it, a task's
    map of orders grew with its part of the file; orders, lines and shops need no further shuffle."""
    from platewise.sources.fixtures import Fixtures

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(Fixtures(spark, SF_SMALL, materialise=False).order_transaction())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    counted = p[p.index("HashAggregate"):].split("Exchange hashpartitioning(l_orderkey")
    assert len(counted) == 2 and "partial_min" in counted[0] and "partial_min" not in counted[1]
    assert p.count("Exchange hashpartitioning") == 2, p


def test_menu_ranks_and_fan_out_share_one_sort(spark):
    """Rows of one (user, dish) stay together in the range shuffle, so the fan-out shuffles nothing."""
    from pyspark.sql import functions as F

    from platewise.plans import gold

    rows = [(u, d, c, 1) for d in ("a", "b", None) for u in ("1", "10", "2", "30", None) for c in ((1, 2, 1001) if d == "a" else (1,))]
    base = spark.createDataFrame(rows, "user_id string, dish_type_l3 string, category_id int, count_order long")
    base = base.withColumn("recent_order_dt", F.lit("2001-01-01").cast("date")).repartition(5)
    out = gold.menu_category(None, None, None, "2001-08-01", base=base)
    got = sorted((r.dish_type_l3, r.user_id or "", r.category_id, r.decile or 0) for r in out.collect())
    want = []
    for dish in ("a", "b"):
        mine = sorted((r for r in rows if r[1] == dish), key=lambda r: (r[0] is not None, r[0] or "", r[2]))
        decile = {(r[0], r[2]): -(-10 * k // len(mine)) for k, r in enumerate(mine, 1)}
        for u, _, c, _ in mine:
            want += [(dish, u or "", c, d) for (v, _), d in decile.items() if u is not None and v == u] or [(dish, "", c, 0)]
    assert got == sorted(want) and len(got) == 4 * 9 + 3 + 5
    assert "hashpartitioning(user_id" not in plan(out)


def test_buckets_are_not_sorted_when_written(spark):
    import uuid

    from platewise.session import work_path
    from platewise.sources import sinks

    name = f"unsorted_{uuid.uuid4().hex[:8]}"
    sinks.write_bucketed(spark.range(1000).withColumnRenamed("id", "order_id"), name, work_path(spark, name), ["order_id"], 4)
    described = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
    assert described["Num Buckets"] == "4" and described.get("Sort Columns", "[]") == "[]"


def test_a_job_that_reads_the_orders_once_stores_no_copy(spark, monkeypatch):
    from platewise.queries import all_queries
    from platewise.sources import fixtures

    query = all_queries()["menu_category"]
    fixtures.Fixtures(spark, SF_SMALL).order_transaction(), fixtures.Fixtures(spark, SF_SMALL).order_item()
    want = sorted(map(str, query(spark, SF_SMALL).collect()))  # from the stored tables, as these are there
    monkeypatch.setattr(fixtures, "_STORED", {})
    got = query(spark, SF_SMALL)
    assert not {"order_transaction", "order_item"} & {name for _, _, name in fixtures._STORED}
    assert sorted(map(str, got.collect())) == want and want
    f = fixtures.Fixtures(spark, SF_SMALL, store_orders=False)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(f.order_transaction().join(f.order_item(), "order_id"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert p.count("Exchange hashpartitioning") == 3, p  # orders, lines for the first shop, lines
