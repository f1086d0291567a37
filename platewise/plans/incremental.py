"""The daily tables kept up to date by changes instead of computed anew.

A change is a set of order ids with the orders' rows before and after it: new
orders (no rows before), late versions, changed status, withdrawn versions.  What
the old rows contributed is taken back, what the new rows contribute is added, and
state tables in buckets (:class:`PartitionedTable`) are rewritten only where that
touches them.  An order whose shop, address or tags changed is a changed order too.

Changes carry increasing numbers.  Every state table commits the number of the last
change it holds, so a change that failed halfway is repeated in full and the tables
that have it already skip it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from platewise.operators.relational import sized_broadcast, top_k
from platewise.plans import gold
from platewise.session import durable
from platewise.sources.keyed import PartitionedTable

SUMS = ("amount", "amounts", "orders")  # sum of the known amounts, their number, orders
PLACE = ("subdistrict", "dish_type_l3", "category_id")


def _of(orders: DataFrame, changed: DataFrame) -> DataFrame:
    """Rows of the changed orders; their ids are broadcast where they are proven few, and else
    meet the orders in the orders' own buckets."""
    return orders.join(sized_broadcast(changed), "order_id", "left_semi")


def _signed(before: DataFrame, after: DataFrame, sums: Sequence[str]) -> DataFrame:
    return after.unionByName(before.withColumns({c: -F.col(c) for c in sums}))


class AreaWindows:
    """Dish orders per sub-district over several retro windows (:func:`gold.area_category` with
    ``one_dish``), moved on from one run date to the next.

    * ``days``: amounts and orders per (order day, place), in buckets by day.  An order
      counts on each day that one of its versions has, with that day's newest version;
    * ``moved``: those counts one by one, for orders whose versions have several days;
    * ``windows``: per (window, place) the sum of ``days`` over the window of the last run.

    A run adds the days that enter a window and subtracts those that leave it; no other
    day is read.  A change adds its signed differences to its days and to the windows
    that hold them.  In a window an order with versions on several of its days counts
    with the newest only, so when the table is read the others are taken off again,
    from ``moved``.
    """

    def __init__(self, root: str, windows: Sequence[int] = (1, 7, 30, 120, 365), day_buckets: int | None = None):
        root, self.sizes = root.rstrip("/"), sorted(set(windows))
        self.days = PartitionedTable(f"{root}/days", ["order_date", *PLACE], ["order_date"], day_buckets)
        self.moved = PartitionedTable(f"{root}/moved", ["order_id", "order_date"], ["order_id"])
        self.windows = PartitionedTable(f"{root}/windows", ["num_retro_days", *PLACE])

    @staticmethod
    def _counted(orders: DataFrame, items: DataFrame, shop: DataFrame, address: DataFrame, tags: DataFrame) -> DataFrame:
        """The line that counts, per (order, day)."""
        o = orders.select("order_id", "total_amount", "shop_id", F.to_date("order_date").alias("order_date"), "updt_dttm")
        lines = gold.tagged_lines(o.where("order_date IS NOT NULL"), items, tags, drop_empty=True)
        newest = [F.col("updt_dttm").desc(), F.col("dish_type_l3").asc(), F.col("category_id").asc()]
        picked = gold.with_area(top_k(lines, ["order_id", "order_date"], newest, 1), shop, address)
        return picked.select("order_id", "order_date", "updt_dttm", F.col("address_subdistrict").alias("subdistrict"), "dish_type_l3",
                             "category_id", F.col("total_amount").cast("decimal(28,6)").alias("total_amount"))

    @staticmethod
    def _sums(counted: DataFrame, *keys: str) -> DataFrame:
        wide = counted.groupBy(*keys, *PLACE).agg(
            F.coalesce(F.sum("total_amount"), F.lit(0)).cast("decimal(38,6)").alias("amount"),
            F.count("total_amount").alias("amounts"), F.count(F.lit(1)).alias("orders"))
        return wide

    def apply(self, change: int, changed: DataFrame, before: DataFrame, after: DataFrame, items: DataFrame, shop: DataFrame,
              address: DataFrame, tags: DataFrame) -> None:
        """Take the changed orders (``order_id``) from their rows ``before`` to those ``after``; both
        may be the whole order table of then and now."""
        spark = after.sparkSession
        changed = durable(changed.select("order_id").where("order_id IS NOT NULL").distinct())
        old, new = (durable(self._counted(_of(o, changed), items, shop, address, tags)) for o in (before, after))
        delta = _signed(self._sums(old, "order_date"), self._sums(new, "order_date"), SUMS)
        delta = delta.groupBy("order_date", *PLACE).agg(*[F.sum(c).cast(delta.schema[c].dataType).alias(c) for c in SUMS])
        delta = durable(delta.where("amount <> 0 OR amounts <> 0 OR orders <> 0"))
        if self.days.note(spark).get("change", 0) < change:
            self.days.add(delta, SUMS, "orders", note={"change": change})
        if self.moved.note(spark).get("change", 0) < change:
            several = [o.groupBy("order_id").count().where("count > 1").select("order_id") for o in (old, new)]
            self.moved.replace_groups(new.join(several[1], "order_id", "left_semi"), several[0].union(several[1]), note={"change": change})
        held = self.windows.note(spark)
        if held.get("run") and held.get("change", 0) < change:
            run = dt.date.fromisoformat(held["run"])
            inside = self._into_windows(delta, lambda n: F.col("order_date").between(F.lit(run - dt.timedelta(days=n)), F.lit(run)))
            self.windows.add(inside, SUMS, "orders", note={"run": held["run"], "change": change})

    def _into_windows(self, days: DataFrame, counts) -> DataFrame:
        """Rows of ``days`` for every window whose ``counts`` (of its size) holds."""
        sizes = F.array_compact(F.array(*[F.when(counts(n), F.lit(n)) for n in self.sizes]))
        return days.withColumn("num_retro_days", F.explode(sizes)).select("num_retro_days", *PLACE, *SUMS)

    def advance(self, spark: SparkSession, run: dt.date) -> None:
        """Move the windows on to ``run``: read the days that enter or leave one, no other."""
        note, change = self.windows.note(spark), self.days.note(spark).get("change", 0)
        last = dt.date.fromisoformat(note["run"]) if note.get("run") else None
        if last is not None and note.get("change", 0) != change:
            raise ValueError(f"change {change} is not in the windows yet: repeat apply() first")
        if last is not None and run < last:
            raise ValueError(f"the windows are at {last} already")
        if last == run:
            return
        day = dt.timedelta(days=1)
        if last is None:
            enter, leave = {n: (run - n * day, run) for n in self.sizes}, {}
        else:  # days that neither the old nor the new window holds cancel out
            enter = {n: (max(last + day, run - n * day), run) for n in self.sizes}
            leave = {n: (last - n * day, min(last, run - n * day - day)) for n in self.sizes}
        wanted = sorted({a + i * day for a, b in [*enter.values(), *leave.values()] for i in range((b - a).days + 1)})
        days = self.days.groups(spark.createDataFrame([(d,) for d in wanted], "order_date date"))
        within = lambda spans: lambda n: F.col("order_date").between(*map(F.lit, spans[n])) if n in spans else F.lit(False)
        plus, minus = self._into_windows(days, within(enter)), self._into_windows(days, within(leave))
        self.windows.add(_signed(minus, plus, SUMS), SUMS, "orders", note={"run": run.isoformat(), "change": change})

    def read(self, spark: SparkSession) -> DataFrame:
        """The rows of :func:`gold.area_category` for the run date the windows are at."""
        run = dt.date.fromisoformat(self.windows.note(spark)["run"])
        rows = self.windows.read(spark).select("num_retro_days", *PLACE, *SUMS)
        moved = self.moved.read(spark)
        sizes = F.array_compact(F.array(*[F.when(F.col("order_date").between(F.lit(run - dt.timedelta(days=n)), F.lit(run)), F.lit(n)) for n in self.sizes]))
        inside = moved.withColumn("num_retro_days", F.explode(sizes))
        newest = [F.col("updt_dttm").desc(), F.col("dish_type_l3").asc(), F.col("category_id").asc()]
        ranked = top_k(inside, ["num_retro_days", "order_id"], newest, 1 << 30, rank_col="_place").where("_place > 1")
        less = self._sums(ranked, "num_retro_days")
        rows = _signed(less.select("num_retro_days", *PLACE, *SUMS), rows, SUMS).groupBy("num_retro_days", *PLACE).agg(*[F.sum(c).alias(c) for c in SUMS])
        day = F.lit(run)
        return rows.where("orders <> 0").select(
            "subdistrict", "dish_type_l3", F.col("category_id").cast("int").alias("category_id"),
            F.when(F.col("amounts") > 0, F.col("amount").cast("double")).alias("total_amount"), F.col("orders").alias("total_orders"),
            day.alias("run_date"), F.col("num_retro_days").cast("int").alias("num_retro_days"), day.alias("busi_dt"))


class CustomerCategories:
    """Per customer and dish: counts, deciles and ranks (:func:`gold.customer_category`), redone for
    the customers that a change touches and carried over for the others.

    * ``counts``: order lines per (customer, dish, id, time of the order), in buckets by
      customer: counts can be taken back, and the newest time that is left is a maximum;
    * ``ranked``: the customers' rows, in the same buckets.
    """

    def __init__(self, root: str, status: str | None = "COMPLETE", buckets: int | None = None):
        root, self.status = root.rstrip("/"), status
        self.counts = PartitionedTable(f"{root}/counts", ["user_id", "dish_type_l3", "category_id", "order_date"], ["user_id"], buckets)
        self.ranked = PartitionedTable(f"{root}/ranked", ["user_id", "dish_type_l3", "category_id"], ["user_id"], buckets)

    def _lines(self, orders: DataFrame, items: DataFrame, tags: DataFrame) -> DataFrame:
        o = orders if self.status is None else orders.where(F.col("order_status") == self.status)
        return gold.line_counts(o.select("order_id", "user_id", "order_date"), items, tags, ["user_id", "order_date"])

    def apply(self, change: int, changed: DataFrame, before: DataFrame, after: DataFrame, items: DataFrame, tags: DataFrame) -> None:
        """Take the changed orders (``order_id``) from their rows ``before`` to those ``after``."""
        spark = after.sparkSession
        changed = durable(changed.select("order_id").where("order_id IS NOT NULL").distinct())
        old, new = (self._lines(_of(o, changed), items, tags) for o in (before, after))
        keys = self.counts.keys
        delta = _signed(old, new, ["n"]).groupBy(*keys).agg(F.sum("n").alias("n")).where("n <> 0")
        delta = durable(delta)
        touched = durable(delta.select("user_id").distinct())
        if self.counts.note(spark).get("change", 0) < change:
            self.counts.add(delta, ["n"], "n", note={"change": change})
        if self.ranked.note(spark).get("change", 0) < change:
            own = self.counts.groups(touched).groupBy("user_id", "dish_type_l3", "category_id").agg(
                F.sum("n").alias("count_order"), F.max("order_date").alias("recent_order_at"))
            own = own.withColumn("recent_order_dt", F.col("recent_order_at").cast("date"))
            rows = gold.customer_ranks(own).drop("recent_order_at")
            self.ranked.replace_groups(rows, touched, note={"change": change})

    def read(self, spark: SparkSession, busi_dt) -> DataFrame:
        """The rows of :func:`gold.customer_category`."""
        return gold.finish_customers(self.ranked.read(spark), busi_dt)
