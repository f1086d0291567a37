"""Gold aggregation jobs: orders x items x tags -> category tables.

Join order is chosen for scale: the largest table (order items) is joined to
the menu tags first, by a size-checked broadcast, so it is never shuffled on
``menu_id`` (a hot menu cannot skew that join); the result then meets the
orders in one shuffle on ``order_id`` (AQE splits a skewed order partition).
Aggregations are partial before every shuffle.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from platewise.functions.text import percentile_label
from platewise.operators.counting import decile_by_counting
from platewise.operators.relational import (
    blank_to_null,
    changed_rows,
    decile,
    decile_of_distinct,
    latest_version,
    rank_in_group,
    retro_dates,
    sized_broadcast,
    top_k,
)
from platewise.operators.skew import split_hot_join
from platewise.session import durable

SHOP_KEYS = ("shop_id", "shop_name", "shop_category", "category_id", "order_count")


def tag_view(tags: DataFrame, drop_empty: bool = False) -> DataFrame:
    """Projected tags: ``menu_id, dish_type_l3, category_id`` with a dish present."""
    t = tags.select("menu_id",
                    F.col("new_dish_type_l3").alias("dish_type_l3"),
                    F.col("new_category_id").cast("int").alias("category_id"))
    cond = F.col("dish_type_l3").isNotNull()
    if drop_empty:
        cond = cond & (F.col("dish_type_l3") != "")
    return t.where(cond)


def tagged_lines(orders: DataFrame, items: DataFrame, tags: DataFrame,
                 drop_empty: bool = False) -> DataFrame:
    """Order rows x their lines x the line's dish tag (inner: an untagged line
    never survives the original jobs' ``dish IS NOT NULL`` filter).

    Tags are broadcast when their size is proven small; otherwise the lines of
    ``orders`` alone, stored once, join them by a shuffle in which hot menus are
    split off.  ``orders`` may be a small part of all.
    """
    t = tag_view(tags, drop_empty)
    bt = sized_broadcast(t)
    it = items.select("order_id", "menu_id")
    if bt is not t:
        return orders.join(it.join(bt, "menu_id"), "order_id")
    # above the broadcast bound; the orders and their lines meet in their buckets
    lines = split_hot_join(durable(orders.join(it, "order_id")), t, "menu_id")
    return lines.select("order_id", *[c for c in orders.columns if c != "order_id"], "menu_id", "dish_type_l3", "category_id")


def line_counts(orders: DataFrame, items: DataFrame, tags: DataFrame, keys: Sequence[str],
                newest: str | None = None) -> DataFrame:
    """Order lines per (``keys``, dish, category id) as ``n``, and the latest ``newest``.

    With tags of a proven small size the lines meet them by broadcast.  Beyond
    that, orders and lines meet first, in their buckets, and the tags are joined by
    Spark's choice: a broadcast or one shuffle of lines, of which AQE splits a hot
    menu's partition (``session.size_shuffles``).  Counting per menu before would
    shuffle almost as many rows once more, as few customers or shops repeat a menu.
    """
    t = tag_view(tags)
    bt = sized_broadcast(t)
    it = items.select("order_id", "menu_id")
    last = [F.max(newest).alias("newest")] if newest else []
    lines = orders.join(it.join(bt, "menu_id"), "order_id") if bt is not t else orders.join(it, "order_id").join(t, "menu_id")
    return lines.groupBy(*keys, "dish_type_l3", "category_id").agg(F.count(F.lit(1)).alias("n"), *last)


def user_dish_counts(orders: DataFrame, items: DataFrame, tags: DataFrame,
                     status: str | None = "COMPLETE") -> DataFrame:
    """Per (user, dish, category id): order lines, the latest order date, and the
    uncut latest order time (``recent_order_at``), which the recency rank goes by."""
    o = orders.select("order_id", "user_id", "order_date", "order_status")
    if status is not None:
        o = o.where(F.col("order_status") == status)
    counts = line_counts(o.drop("order_status"), items, tags, ["user_id"], "order_date")
    return counts.select("user_id", "dish_type_l3", "category_id", F.col("n").alias("count_order"),
                         F.col("newest").cast("date").alias("recent_order_dt"), F.col("newest").alias("recent_order_at"))


def _finish(df: DataFrame, busi_dt) -> DataFrame:
    out = blank_to_null(df, ["user_id", "dish_type_l3"]).dropna(how="all", subset=["dish_type_l3"])
    return out.withColumns({"percentile": percentile_label("decile"),
                            "busi_dt": F.lit(busi_dt).cast("date")})


def customer_category(orders: DataFrame, items: DataFrame, tags: DataFrame, busi_dt,
                      status: str | None = "COMPLETE", base: DataFrame | None = None) -> DataFrame:
    """Per customer: decile of each dish's order count among the customer's
    distinct counts, and a recency rank inside (customer, decile).

    Rank 1 is the *least* recent dish of the decile, by the time of its last
    order (two orders of one day differ); ties break on dish, id.
    An empty dish keeps its rank slot and is dropped afterwards.
    """
    b = base if base is not None else user_dish_counts(orders, items, tags, status)
    return finish_customers(customer_ranks(b), busi_dt)


def customer_ranks(b: DataFrame) -> DataFrame:
    """The base with each customer's ``decile`` and ``rank``; a customer's rows depend on theirs alone."""
    d = decile_of_distinct(b, "user_id", "count_order")
    w = Window.partitionBy("user_id", "decile").orderBy(
        F.col("recent_order_at" if "recent_order_at" in b.columns else "recent_order_dt").asc(),
        F.col("dish_type_l3").asc(), F.col("category_id").asc())
    return d.withColumn("rank", F.row_number().over(w))


def finish_customers(ranked: DataFrame, busi_dt) -> DataFrame:
    out = _finish(ranked, busi_dt)
    return out.select("user_id", "count_order", "recent_order_dt", "dish_type_l3",
                      "category_id", "decile", "rank", "percentile", "busi_dt")


def menu_category(orders: DataFrame, items: DataFrame, tags: DataFrame, busi_dt,
                  mode: str = "faithful", status: str | None = "COMPLETE",
                  base: DataFrame | None = None) -> DataFrame:
    """Per customer within a dish: decile of the customer among the dish's customers.

    ``faithful`` ranks the regrouped (always 1) counts, so the order inside a
    dish is by user id, and joins back on (user, dish) only, so a dish with two
    ids multiplies rows.  ``by_count`` ranks the real counts and keeps one row
    per (user, dish, id).  The rank inside a dish is computed without sending a
    whole dish to one task (a popular dish can hold a large share of rows).
    ``by_histogram`` gives the rows of ``by_count`` from histograms of the counts,
    without the range sort (:func:`decile_by_counting`).
    """
    b = base if base is not None else user_dish_counts(orders, items, tags, status)
    order_tail = [F.col("user_id").asc_nulls_first(), F.col("category_id").asc()]
    if mode == "faithful":
        # the base has one row per (user, dish, id), so the regrouped counts are all 1 and the base itself is ranked
        ranked = rank_in_group(b.select("user_id", "dish_type_l3", "category_id", "count_order"), "dish_type_l3",
                               order_tail, rank_col="_rank", size_col="_size", subgroup="user_id", nth_col="_nth", many_col="_many")
        # each row once per row of its (user, dish), which are as many as the dish has ids; their ranks follow one another
        known = F.col("user_id").isNotNull() & F.col("dish_type_l3").isNotNull()
        before = F.col("_rank") - F.col("_nth")
        ranks = F.when(known, F.sequence(before + 1, before + F.col("_many"))).otherwise(F.array(F.lit(None).cast("long")))
        joined = ranked.withColumn("_each", F.explode(ranks)).withColumn("decile", decile("_each", "_size"))
    elif mode == "by_histogram":
        joined = decile_by_counting(b, "dish_type_l3", "count_order", "user_id", [F.col("category_id").asc()])
        joined = joined.withColumn("decile", F.when(F.col("user_id").isNotNull(), F.col("decile")))
    elif mode == "by_count":
        ranked = rank_in_group(b, "dish_type_l3", [F.col("count_order").asc(), *order_tail],
                               rank_col="_rank", size_col="_size")
        joined = ranked.withColumn(
            "decile", F.when(F.col("user_id").isNotNull(), decile("_rank", "_size")))
    else:
        raise ValueError(f"mode must be 'faithful', 'by_count' or 'by_histogram', not {mode!r}")
    out = _finish(joined, busi_dt)
    return out.select("user_id", "count_order", "dish_type_l3", "category_id", "decile",
                      "percentile", "busi_dt")


def shop_counts(orders: DataFrame, items: DataFrame, tags: DataFrame) -> DataFrame:
    """Order lines per (shop_id, shop_name, dish, id), latest order versions only."""
    ot = latest_version(orders.select("order_id", "shop_id", "shop_name", "updt_dttm"),
                        "order_id", "updt_dttm")
    counts = line_counts(ot.drop("updt_dttm"), items, tags, ["shop_id", "shop_name"])
    return counts.withColumnRenamed("n", "order_count")


def with_area(orders: DataFrame, shop: DataFrame, address: DataFrame) -> DataFrame:
    """order -> shop -> address (left, left): adds ``address_subdistrict``.

    The two dimensions are joined to each other first (Spark and AQE pick that
    strategy); the result is broadcast after a size check, so the order side is
    not shuffled for them.
    """
    place = shop.select("shop_id", "address_id").join(
        address.select("address_id", "address_subdistrict"), "address_id", "left")
    return orders.join(sized_broadcast(place.select("shop_id", "address_subdistrict")), "shop_id", "left")


def shop_category(orders: DataFrame, items: DataFrame, tags: DataFrame, busi_dt) -> DataFrame:
    """Top dish per shop by order lines, over the latest version of each order.

    Counts group by (shop_id, shop_name, dish, id) and the top row is taken per
    shop_id; ties break on shop_name, dish, id.  Empty dishes are kept.
    """
    counts = shop_counts(orders, items, tags)
    top = top_k(counts, ["shop_id"], [F.col("order_count").desc(), F.col("shop_name").asc_nulls_first(),
                                      F.col("dish_type_l3").asc(), F.col("category_id").asc()], 1)
    return top.select("shop_id", "shop_name", F.col("dish_type_l3").alias("shop_category"),
                      "category_id", "order_count", F.lit(busi_dt).cast("date").alias("busi_dt"))


def shop_category_change(today: DataFrame, prev: DataFrame, busi_dt,
                         null_safe: bool = False) -> DataFrame:
    """Shops whose top-category row differs from the previous snapshot."""
    changed = changed_rows(today, prev, SHOP_KEYS, null_safe=null_safe)
    return changed.withColumn("busi_dt", F.lit(busi_dt).cast("date"))


def area_lines(orders: DataFrame, items: DataFrame, shop: DataFrame, address: DataFrame,
               tags: DataFrame, run_dates: Iterable[dt.date] | dt.date,
               windows: Sequence[int] = (1, 7, 30, 120, 365),
               attribution: str = "one_dish", month_col: str | None = None) -> DataFrame:
    """The order lines that count, per (run date, window): the input of the area
    aggregation, with ``run_date`` and ``num_retro_days``.

    ``month_col`` names a first-of-month date column the orders are stored
    partitioned by; the same span is then also filtered on it, so Spark reads
    only the partitions of the widest window.

    One pass for every (run date, window) pair instead of one job each: rows
    are read once for the widest span, each row is tagged with the pairs whose
    inclusive window holds its order date, and one aggregation follows.  Inside
    each pair an order counts for exactly one line: the newest version's first
    dish (``one_dish``, the original numbering after the item fan-out), or
    for every distinct dish of the newest version (``all_dishes``).
    """
    runs = retro_dates([run_dates] if isinstance(run_dates, (dt.date, str)) else run_dates)
    wins = sorted(set(int(n) for n in windows))
    lo, hi = min(runs) - dt.timedelta(days=max(wins)), max(runs)
    # on the raw column (it is pushed to the scan), which may be a date or a time: the last day counts whole
    span = (F.col("order_date") >= F.lit(lo)) & (F.col("order_date") < F.lit(hi + dt.timedelta(days=1)))
    if month_col is not None:
        span = span & (F.col(month_col) >= F.lit(lo.replace(day=1))) & (F.col(month_col) <= F.lit(hi))
    o = orders.where(span).select("order_id", "total_amount", "shop_id", "order_date", "updt_dttm")
    o = o.withColumn("order_date", F.to_date("order_date"))
    lines = tagged_lines(o, items, tags, drop_empty=True)
    pairs = F.array(*[F.struct(F.lit(r).alias("run_date"), F.lit(n).alias("num_retro_days"))
                      for r in runs for n in wins])
    hit = F.filter(pairs, lambda p: (F.col("order_date") >= F.date_sub(p["run_date"], p["num_retro_days"]))
                   & (F.col("order_date") <= p["run_date"]))

    def in_windows(df: DataFrame) -> DataFrame:
        return df.withColumn("_w", F.explode(hit)).select(
            "*", F.col("_w.run_date").alias("run_date"), F.col("_w.num_retro_days").alias("num_retro_days")
        ).drop("_w")

    newest = [F.col("updt_dttm").desc(), F.col("dish_type_l3").asc(), F.col("category_id").asc()]
    if attribution == "one_dish":
        # Window membership depends only on the order date, so the newest line of
        # an order inside a window is the newest of its per-date newest lines:
        # pick per (order, date) before the windows multiply the rows.  Both
        # windows run in the order_id partitioning of the join (no exchange).
        per_date = top_k(lines, ["order_id", "order_date"], newest, 1)
        picked = top_k(in_windows(per_date), ["run_date", "num_retro_days", "order_id"], newest, 1)
    elif attribution == "all_dishes":
        w = Window.partitionBy("run_date", "num_retro_days", "order_id")
        picked = (in_windows(lines).withColumn("_top", F.max("updt_dttm").over(w)).where(F.col("updt_dttm") == F.col("_top"))
                  .dropDuplicates(["run_date", "num_retro_days", "order_id", "dish_type_l3", "category_id"]))
    else:
        raise ValueError(f"attribution must be 'one_dish' or 'all_dishes', not {attribution!r}")
    return with_area(picked, shop, address)  # a place per counted order, not per line


def area_category(orders: DataFrame, items: DataFrame, shop: DataFrame, address: DataFrame,
                  tags: DataFrame, run_dates: Iterable[dt.date] | dt.date,
                  windows: Sequence[int] = (1, 7, 30, 120, 365),
                  attribution: str = "one_dish", month_col: str | None = None) -> DataFrame:
    """Per (sub-district, dish, id): order amount and count over retro windows
    (see :func:`area_lines`); one aggregation for all windows and run dates."""
    picked = area_lines(orders, items, shop, address, tags, run_dates, windows, attribution, month_col)
    agg = picked.groupBy("address_subdistrict", "dish_type_l3", "category_id", "run_date",
                         "num_retro_days").agg(
        F.sum(F.col("total_amount").cast("decimal(28,6)")).cast("double").alias("total_amount"),
        F.count("order_id").cast("long").alias("total_orders"))
    return agg.select(F.col("address_subdistrict").alias("subdistrict"), "dish_type_l3",
                      F.col("category_id").cast("int").alias("category_id"), "total_amount",
                      "total_orders", F.col("run_date").cast("date").alias("run_date"),
                      F.col("num_retro_days").cast("int").alias("num_retro_days"),
                      F.col("run_date").cast("date").alias("busi_dt"))
