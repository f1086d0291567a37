"""Per-customer category lists, their key-value export, and bulk serving."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from platewise.functions.arrays import key_json, pad_list, parse_dish_list
from platewise.operators.relational import exclude_values, latest, sized_broadcast, top_k
from platewise.sources.keyed import PartitionedTable

def popular_dishes(area: DataFrame, days: int = 7, exclude: Sequence[str] = (),
                   latest_only: bool = True) -> DataFrame:
    """Per dish: total orders over all areas in the ``days`` window of the latest
    ``busi_dt`` (partition pruning on ``busi_dt`` when the table is partitioned)."""
    a = latest(area, "busi_dt") if latest_only else area
    a = a.where(F.col("num_retro_days") == days)
    a = exclude_values(a, "dish_type_l3", list(exclude) + [""])
    return a.groupBy("dish_type_l3").agg(F.sum("total_orders").cast("long").alias("total_orders"))


def popularity_order() -> list[Column]:
    return [F.col("total_orders").desc(), F.col("dish_type_l3").asc()]


def ranked_popularity(popular: DataFrame) -> DataFrame:
    """Positions 1..n in popularity order.  The input holds one row per dish
    category (a bounded dimension), so one ordered window over it is small."""
    return popular.withColumn("pos", F.row_number().over(Window.orderBy(*popularity_order())))


def top_list(popular: DataFrame, n: int) -> Column:
    """The ``n`` most popular dishes as an ordered array, as a scalar subquery.

    A list of ``k`` own dishes skips at most ``k`` fallback entries, so ``2k``
    entries always pad exactly; the array never grows with the data.
    """
    top = popular.orderBy(*popularity_order()).limit(n)
    arr = top.agg(F.array_sort(F.collect_list(
        F.struct((-F.col("total_orders")).alias("o"), F.col("dish_type_l3").alias("d")))).alias("a"))
    return arr.select(F.transform("a", lambda x: x["d"])).scalar()


def _top_rows(customer: DataFrame, exclude: Sequence[str], k: int) -> DataFrame:
    c = exclude_values(customer, "dish_type_l3", exclude)
    # blank users become NULL keys on output, so they are left out with them, before the window
    c = c.where(F.col("user_id").isNotNull() & (F.col("user_id") != ""))
    return top_k(c, ["user_id"], [F.col("decile").desc_nulls_last(), F.col("rank").desc_nulls_last(),
                                  F.col("dish_type_l3").asc(), F.col("category_id").asc()],
                 k, rank_col="_pos")


def own_lists(customer: DataFrame, exclude: Sequence[str] = (), k: int = 10) -> DataFrame:
    """Top ``k`` dishes per customer by decile DESC, rank DESC, as an ordered array."""
    return _top_rows(customer, exclude, k).groupBy("user_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_pos", "dish_type_l3"))),
                    lambda x: x["dish_type_l3"]).alias("sv_dish_types"),
        F.count("dish_type_l3").cast("long").alias("sv_dish_count"))


def dish_ids(id_map: DataFrame) -> DataFrame:
    """(``_name``, ``_id``) with one row per category name: the largest id of a
    repeated name; a NULL name names nothing.  The same at every mapper size."""
    return (id_map.where(F.col("category_name").isNotNull()).groupBy(F.col("category_name").alias("_name"))
            .agg(F.max(F.col("category_id").cast("int")).alias("_id")))


def _strict_id(name: Column, dish_id: Column, strict: bool) -> Column:
    if not strict:
        return dish_id
    missing = F.raise_error(F.concat(F.lit("no category id for "), name)).cast("int")
    return F.when(name.isNotNull() & dish_id.isNull(), missing).otherwise(dish_id)


def dish_structs(lists: DataFrame, id_map: DataFrame, col: str = "_padded", out: str = "gd_items",
                 strict: bool = True, key: str = "user_id") -> DataFrame:
    """Names -> ``array<struct<id, name>>`` by a join with the id mapper (broadcast
    only when its size is proven small)."""
    ids = sized_broadcast(dish_ids(id_map))
    one = lists.select(F.col(key).alias("_key"), F.posexplode(col).alias("_p", "_n"))
    one = one.join(ids, F.col("_n") == F.col("_name"), "left").where(F.col("_n").isNotNull())
    item = F.struct(_strict_id(F.col("_n"), F.col("_id"), strict).alias("id"), F.col("_n").alias("name"))
    items = one.groupBy("_key").agg(F.array_sort(F.collect_list(F.struct("_p", item.alias("v")))).alias("_s"))
    items = items.select("_key", F.transform("_s", lambda x: x["v"]).alias(out))
    empty = F.array().cast("array<struct<id:int,name:string>>")
    return lists.join(items, F.col(key) == F.col("_key"), "left").drop("_key").withColumn(out, F.coalesce(out, empty))


def default_row(spark, top: Column, k: int = 10) -> DataFrame:
    """The ``default`` list: the ``k`` most popular dishes, count fixed at ``k``
    (so it is never padded)."""
    return spark.range(1).select(
        F.lit("default").alias("user_id"), F.slice(top, 1, k).alias("sv_dish_types"),
        F.lit(k).cast("long").alias("sv_dish_count"))


def padded_lists(customer: DataFrame, popular: DataFrame, exclude: Sequence[str] = (),
                 k: int = 10) -> DataFrame:
    """Own lists plus the default row, with ``_padded`` (the padded, cut list)."""
    top = top_list(popular, 2 * k)
    own = own_lists(customer, exclude, k)
    return (own.unionByName(default_row(customer.sparkSession, top, k)).withColumn("_top", top)
            .withColumn("_padded", pad_list("sv_dish_types", "_top", "sv_dish_count", k)).drop("_top"))


def customer_lists(customer: DataFrame, popular: DataFrame, id_map: DataFrame, busi_dt,
                   exclude: Sequence[str] = (), k: int = 10, strict: bool = True) -> DataFrame:
    """One row per customer: own top-``k`` dishes, padded from popularity when
    short, decorated with category ids as JSON; plus the ``default`` row.

    Ids are joined to the dishes before a customer's list is collected, and to
    the ``2k`` popular ones, so lists need no second shuffle.  NULL and blank
    customers are left out (they would be a NULL primary key).
    """
    ids = sized_broadcast(dish_ids(id_map))
    named = lambda df: df.join(ids, F.col("dish_type_l3") == F.col("_name"), "left")
    item = F.struct(F.col("_id").alias("id"), F.col("dish_type_l3").alias("name"))
    items = lambda order: F.transform(F.array_sort(F.collect_list(F.struct(*order, item.alias("v")))), lambda x: x["v"])
    top = named(popular.orderBy(*popularity_order()).limit(2 * k)).agg(
        items([(-F.col("total_orders")).alias("o"), F.col("dish_type_l3").alias("d")]).alias("t")).scalar()
    own = named(_top_rows(customer, exclude, k)).groupBy("user_id").agg(
        items([F.col("_pos")]).alias("_own"), F.count("dish_type_l3").cast("long").alias("sv_dish_count"))
    first = customer.sparkSession.range(1).select(F.lit("default").alias("user_id"), F.slice(top, 1, k).alias("_own"),
                                                  F.lit(k).cast("long").alias("sv_dish_count"))
    rows = own.unionByName(first).withColumn("_top", top).withColumn("sv_dish_types", F.transform("_own", lambda x: x["name"]))
    more = F.filter("_top", lambda t: ~F.array_contains("sv_dish_types", t["name"]))
    full = F.when(F.col("sv_dish_count") < k, F.concat("_own", more)).otherwise(F.col("_own"))
    shown = F.transform(F.slice(full, 1, k), lambda x: F.struct(_strict_id(x["name"], x["id"], strict).alias("id"), x["name"].alias("name")))
    return rows.select("user_id", "sv_dish_types", "sv_dish_count", F.to_json(shown).alias("gd_dish_types"),
                       F.lit(busi_dt).cast("date").alias("busi_dt"))


def to_kv(df: DataFrame, key: str = "user_id", value: str = "gd_dish_types") -> DataFrame:
    """Key-value items: key text ``["<id>"]`` and the value column."""
    return df.select(key_json(key).alias("key"), F.col(value).alias("value"))


def serve(requests: DataFrame, lists: DataFrame, key: str = "user_id",
          default_key: str = "default") -> DataFrame:
    """Answer every request with the customer's list, or the ``default`` list.

    The default row is fetched once as a scalar subquery (it fails if the
    keyed table holds two default rows); the rest is one equi join, with the
    requests broadcast when their size is proven small.
    """
    default = lists.where(F.col(key) == default_key).select("gd_dish_types").scalar()
    req = requests.select(key)
    table = lists.select(key, F.col("gd_dish_types").alias("_gd"))
    small = sized_broadcast(req)
    if small is not req:
        # A small batch of requests against a large table: a broadcast semi
        # join streams the table once without shuffling it and keeps the
        # requested keys.  Of the hits only their real size is trusted: Spark
        # broadcasts them at run time if they are below its byte threshold.
        hits = table.join(small, key, "left_semi")
        got = req.join(hits, key, "left")
    else:
        got = req.join(table, key, "left")
    return got.select(
        key,
        F.coalesce(F.col("_gd"), default).alias("recommended_items"),
        F.col("_gd").isNull().alias("from_default"))


def serve_keyed(requests: DataFrame, table: PartitionedTable, key: str = "user_id", default_key: str = "default") -> DataFrame:
    """:func:`serve` from a bucketed table: only the buckets that the requested keys hash to are
    read, and of those only the row groups in the keys' range (a single request reads one bucket)."""
    spark = requests.sparkSession
    default = table.lookup(spark.createDataFrame([(default_key,)], f"`{key}` string")).select("gd_dish_types").scalar()
    req = requests.select(key)
    hits = table.lookup(req).select(F.col(key).alias("_key"), F.col("gd_dish_types").alias("_gd"))
    got = req.join(hits, F.col(key) == F.col("_key"), "left")
    return got.select(key, F.coalesce(F.col("_gd"), default).alias("recommended_items"), F.col("_gd").isNull().alias("from_default"))


def serve_items(served: DataFrame) -> DataFrame:
    """Parsed form of the answers: ``array<struct<id, name>>``."""
    return served.withColumn("recommended_items", parse_dish_list("recommended_items"))
