"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

Every query reads the driver's tables through the fixture mapping and runs
over the whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from platewise.plans import daily, gold, incremental, lists
from platewise.session import work_path
from platewise.sources import keyed, ledger, sinks
from platewise.sources.fixtures import (
    EXCLUDE,
    LIST_K,
    PREV_CUTOFF,
    PREV_RUN_DATE,
    RUN_DATE,
    WINDOWS,
    Fixtures,
)

Query = Callable[[SparkSession, str], DataFrame]


# ------------------------------------------------------------- gold jobs ---

def customer_category(spark: SparkSession, sf: str) -> DataFrame:
    f = Fixtures(spark, sf)
    return gold.customer_category(f.order_transaction(), f.order_item(), f.dish_tagging(), RUN_DATE)


def menu_category_faithful(spark: SparkSession, sf: str) -> DataFrame:
    f = Fixtures(spark, sf, store_orders=False)  # the base reads them once
    return gold.menu_category(f.order_transaction(), f.order_item(), f.dish_tagging(), RUN_DATE,
                              mode="faithful")


def menu_category_by_count(spark: SparkSession, sf: str) -> DataFrame:
    f = Fixtures(spark, sf)
    return gold.menu_category(f.order_transaction(), f.order_item(), f.dish_tagging(), RUN_DATE,
                              mode="by_count")


def menu_category_by_histogram(spark: SparkSession, sf: str) -> DataFrame:
    f = Fixtures(spark, sf)
    return gold.menu_category(f.order_transaction(), f.order_item(), f.dish_tagging(), RUN_DATE,
                              mode="by_histogram")


def _shop(f: Fixtures, busi, cutoff=None) -> DataFrame:
    o = f.order_transaction()
    if cutoff is not None:
        o = o.where(F.col("order_date") < F.lit(cutoff))
    return gold.shop_category(o, f.order_item(), f.dish_tagging(), busi)


def shop_category(spark: SparkSession, sf: str) -> DataFrame:
    return _shop(Fixtures(spark, sf), RUN_DATE)


def shop_category_change(spark: SparkSession, sf: str) -> DataFrame:
    f = Fixtures(spark, sf)
    return gold.shop_category_change(_shop(f, RUN_DATE), _shop(f, PREV_RUN_DATE, PREV_CUTOFF), RUN_DATE)


def _area(f: Fixtures, runs=(RUN_DATE,), windows=WINDOWS) -> DataFrame:
    return gold.area_category(f.order_transaction(), f.order_item(), f.shop(), f.address(),
                              f.dish_tagging(), list(runs), windows)


def stored_area(f: Fixtures, runs=(RUN_DATE,), windows=WINDOWS) -> DataFrame:
    """The area table as the next job sees it: stored, partitioned by business day."""
    path = work_path(f.spark, "area_category")
    area = _area(f, runs, windows)
    sinks.write_append(area, path, ["busi_dt"])
    back = sinks.read_table_dir(f.spark, path)
    return back.select(*[F.col(c).cast(area.schema[c].dataType).alias(c) for c in area.columns])


def popular(f: Fixtures, busi=RUN_DATE) -> DataFrame:
    """Popularity reads one window of the latest stored day."""
    return lists.popular_dishes(stored_area(f, (busi,), (7,)), 7, EXCLUDE)


def area_category(spark: SparkSession, sf: str) -> DataFrame:
    return _area(Fixtures(spark, sf))


def backfill_days(spark: SparkSession, sf: str) -> DataFrame:
    return _area(Fixtures(spark, sf), (PREV_RUN_DATE, RUN_DATE))


# ------------------------------------------------------------------ lists ---

def _lists(f: Fixtures, busi=RUN_DATE, cutoff=None) -> DataFrame:
    o = f.order_transaction()
    if cutoff is not None:
        o = o.where(F.col("order_date") < F.lit(cutoff))
    tags = f.dish_tagging()
    cc = gold.customer_category(o, f.order_item(), tags, busi)
    return lists.customer_lists(cc, popular(f, busi), f.category_id_mapper(), busi, EXCLUDE, LIST_K)


def _stored_lists(f: Fixtures) -> DataFrame:
    """The list feature table as the serving side sees it: upserted, then read."""
    table = sinks.KeyedTable(work_path(f.spark, "customer_category_list"), keys=["user_id"])
    table.upsert(_lists(f))
    return table.read(f.spark)


def agg_popularity(spark: SparkSession, sf: str) -> DataFrame:
    f = Fixtures(spark, sf)
    return lists.ranked_popularity(popular(f)).select("dish_type_l3", "total_orders",
                                               F.col("pos").cast("int").alias("pos"))


def customer_category_list(spark: SparkSession, sf: str) -> DataFrame:
    return _lists(Fixtures(spark, sf))


def kv_export(spark: SparkSession, sf: str) -> DataFrame:
    return lists.to_kv(_lists(Fixtures(spark, sf)))


def serve_recommendations(spark: SparkSession, sf: str) -> DataFrame:
    f = Fixtures(spark, sf)
    return lists.serve(f.requests(), _stored_lists(f))


def upsert_by_key(spark: SparkSession, sf: str) -> DataFrame:
    f = Fixtures(spark, sf)
    prev = _lists(f, PREV_RUN_DATE, PREV_CUTOFF)
    today = _lists(f)
    table = sinks.KeyedTable(work_path(spark, "customer_category_list"), keys=["user_id"])
    table.upsert(prev)
    table.upsert(today)
    return table.read()


def _ordered_since(f: Fixtures, day) -> DataFrame:
    """Customers with an order on ``day`` or later."""
    o = f.order_transaction().where((F.col("order_date") >= F.lit(day)) & F.col("user_id").isNotNull())
    return o.select("user_id").distinct()


def _bucketed_lists(f: Fixtures) -> keyed.PartitionedTable:
    """Yesterday's lists, then new ones for the customers who have ordered since."""
    table = keyed.PartitionedTable(work_path(f.spark, "customer_lists"), ["user_id"])
    table.upsert(_lists(f, PREV_RUN_DATE, PREV_CUTOFF))
    table.upsert(_lists(f).join(_ordered_since(f, PREV_CUTOFF), "user_id", "left_semi"))
    return table


def upsert_touched_buckets(spark: SparkSession, sf: str) -> DataFrame:
    return _bucketed_lists(Fixtures(spark, sf)).read(spark)


def lookup_pruned(spark: SparkSession, sf: str) -> DataFrame:
    f = Fixtures(spark, sf)
    return lists.serve_keyed(f.requests(), _bucketed_lists(f))


def _two_changes(f: Fixtures) -> list[tuple[DataFrame, DataFrame, DataFrame]]:
    """(changed ids, rows before, rows after): the orders known on the previous run date, then
    the versions that have come since."""
    now = f.order_transaction()
    then = now.where(F.col("updt_dttm") <= F.lit(PREV_RUN_DATE))
    since = now.where(F.col("updt_dttm") > F.lit(PREV_RUN_DATE))
    return [(then.select("order_id"), now.limit(0), then), (since.select("order_id"), then, now)]


def area_windows_incremental(spark: SparkSession, sf: str) -> DataFrame:
    f = Fixtures(spark, sf)
    state = incremental.AreaWindows(work_path(spark, "area_windows"), WINDOWS)
    for change, (run, (ids, before, after)) in enumerate(zip((PREV_RUN_DATE, RUN_DATE), _two_changes(f)), 1):
        state.apply(change, ids, before, after, f.order_item(), f.shop(), f.address(), f.dish_tagging())
        state.advance(spark, run)
    return state.read(spark)


def customer_category_incremental(spark: SparkSession, sf: str) -> DataFrame:
    f = Fixtures(spark, sf)
    state = incremental.CustomerCategories(work_path(spark, "customer_categories"))
    for change, (ids, before, after) in enumerate(_two_changes(f), 1):
        state.apply(change, ids, before, after, f.order_item(), f.dish_tagging())
    return state.read(spark, RUN_DATE)


def _two_published_days(f: Fixtures) -> ledger.Ledger:
    """The previous run date with the orders of before, then the run date."""
    book, o = ledger.Ledger(work_path(f.spark, "published")), f.order_transaction()
    for run, orders in ((PREV_RUN_DATE, o.where(F.col("order_date") < F.lit(PREV_CUTOFF))), (RUN_DATE, o)):
        src = daily.Inputs(orders, f.order_item(), f.shop(), f.address(), f.menu(), f.dish_type_encoder(), f.category_name_mapper(),
                           f.category_id_mapper())
        daily.publish_day(f.spark, src, book, run, f.dish_tagging(), EXCLUDE, LIST_K, WINDOWS)
    return book


def published_shop_changes(spark: SparkSession, sf: str) -> DataFrame:
    """Shops whose top category changed between two published days, read through the ledger."""
    return _two_published_days(Fixtures(spark, sf)).read(spark, "shop_category_change")


def published_lists(spark: SparkSession, sf: str) -> DataFrame:
    """The list table after two published days, read through the ledger."""
    return _two_published_days(Fixtures(spark, sf)).read(spark, "customer_category_list")


def published_area_days(spark: SparkSession, sf: str) -> DataFrame:
    """The area rows of both published days."""
    return _two_published_days(Fixtures(spark, sf)).read_days(spark, "area_category", PREV_RUN_DATE, RUN_DATE)


QUERIES: dict[str, Query] = {
    "customer_category": customer_category,
    "menu_category": menu_category_faithful,
    "menu_category_by_count": menu_category_by_count,
    "menu_category_by_histogram": menu_category_by_histogram,
    "shop_category": shop_category,
    "shop_category_change": shop_category_change,
    "area_category": area_category,
    "multi_window_agg": area_category,
    "backfill_days": backfill_days,
    "agg_popularity": agg_popularity,
    "customer_category_list": customer_category_list,
    "kv_export": kv_export,
    "serve_recommendations": serve_recommendations,
    "upsert_by_key": upsert_by_key,
    "upsert_touched_buckets": upsert_touched_buckets,
    "lookup_pruned": lookup_pruned,
    "area_windows_incremental": area_windows_incremental,
    "customer_category_incremental": customer_category_incremental,
    "published_shop_changes": published_shop_changes,
    "published_lists": published_lists,
    "published_area_days": published_area_days,
    # the same jobs under the names of the operators they are made of
    "join_decile_fanout": menu_category_faithful,
    "lookup_with_default": serve_recommendations,
    "agg_area_dish": area_category,
    "win_rank_expr_partition": customer_category,
    "win_top1_group": shop_category,
    "union_positional": customer_category_list,
    "udf_list_builder": customer_category_list,
}


def all_queries() -> dict[str, Query]:
    from platewise.operator_queries import OPERATOR_QUERIES

    return {**QUERIES, **OPERATOR_QUERIES}
