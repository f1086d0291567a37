"""Tables kept up to date by changes equal the full jobs after every change."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from platewise.plans import gold, incremental
from platewise.session import work_path
from platewise.sources.keyed import PartitionedTable

START = dt.date(2024, 3, 1)
ORDERS = ("order_id long, user_id string, shop_id long, total_amount double, order_status string, order_date timestamp, "
          "updt_dttm timestamp, known date")


class World:
    """Orders whose versions become known day by day: new orders, late and moved versions, changed status."""

    def __init__(self, spark, seed, days=14):
        rng, rows, self.spark = random.Random(seed), [], spark
        at = lambda day, hour: dt.datetime.combine(day, dt.time(hour))
        orders = {}
        for d in range(days):
            today = START + dt.timedelta(days=d)
            for _ in range(12):
                i = len(orders)
                orders[i] = (rng.choice(["a", "b", "c", "", None]), rng.choice([1, 2, 3, 9]), today)
                rows.append((i, orders[i][0], orders[i][1], rng.choice([None, 1.25, 10.1, 7.0]), rng.choice(["COMPLETE", "COMPLETE", "PENDING"]),
                             at(today, rng.randrange(24)), at(today, 5), today))
            for i in rng.sample(sorted(orders), 6):  # a later version, sometimes of another day
                user, shop, day = orders[i]
                moved = day + dt.timedelta(days=rng.choice([0, 0, -1, 2, -3]))
                rows.append((i, user, rng.choice([shop, 2]), rng.choice([None, 3.5, -2.0]), rng.choice(["COMPLETE", "CANCELLED"]),
                             at(moved, rng.randrange(24)), at(today, 6 + rng.randrange(3)), today))
        self.orders = spark.createDataFrame(rows, ORDERS).cache()
        lines = [(i, rng.randrange(8)) for i in orders for _ in range(rng.randrange(4))]
        self.items = spark.createDataFrame(lines, "order_id long, menu_id long").cache()
        tags = [(0, "rice", 1), (1, "rice", 1), (2, "rice", 7), (3, "soup", 2), (4, "", 3), (5, None, None), (6, "soup", 2)]
        self.tags = spark.createDataFrame(tags, "menu_id long, new_dish_type_l3 string, new_category_id int")
        self.shop = spark.createDataFrame([(1, 1), (2, 2), (3, 3)], "shop_id long, address_id long")
        self.address = spark.createDataFrame([(1, "east"), (2, "west"), (3, None)], "address_id long, address_subdistrict string")

    def at(self, day):
        """Order rows known on a day, and the ids of those that came that day."""
        return self.orders.where(F.col("known") <= F.lit(day)), self.orders.where(F.col("known") == F.lit(day)).select("order_id")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("seed", [1])
def test_ten_days_equal_ten_full_runs(spark, seed):
    w, windows = World(spark, seed), (1, 3, 7)
    area = incremental.AreaWindows(work_path(spark, "area"), windows, day_buckets=64)
    users = incremental.CustomerCategories(work_path(spark, "users"), buckets=8)
    before = w.orders.limit(0)
    for d in range(14):
        today = START + dt.timedelta(days=d)
        after, ids = w.at(today)
        area.apply(d + 1, ids, before, after, w.items, w.shop, w.address, w.tags)
        users.apply(d + 1, ids, before, after, w.items, w.tags)
        before = after
        if d < 3:
            continue  # the first days come in one go
        area.advance(spark, today)
        full = gold.area_category(after, w.items, w.shop, w.address, w.tags, [today], windows)
        assert rows(area.read(spark)) == rows(full), today
        if d % 4 == 1:
            full = gold.customer_category(after, w.items, w.tags, today)
            assert rows(users.read(spark, today)) == rows(full), today
    assert area.moved.read(spark).count() > 10 and area.read(spark).where("num_retro_days = 7").count() > 4
    # a repeated change and a repeated run change nothing
    held = rows(area.windows.read(spark)), area.windows.version(spark)["version"]
    area.apply(14, ids, before.limit(0), before, w.items, w.shop, w.address, w.tags)
    area.advance(spark, today)
    assert held == (rows(area.windows.read(spark)), area.windows.version(spark)["version"])


def test_a_run_reads_the_days_that_enter_or_leave(spark, monkeypatch):
    w = World(spark, 5)
    area = incremental.AreaWindows(work_path(spark, "area"), (1, 3, 7), day_buckets=512)
    after, _ = w.at(START + dt.timedelta(days=13))
    area.apply(1, after.select("order_id"), after.limit(0), after, w.items, w.shop, w.address, w.tags)
    area.advance(spark, START + dt.timedelta(days=10))
    read, real = [], PartitionedTable.groups
    monkeypatch.setattr(PartitionedTable, "groups", lambda self, wanted: read.append(real(self, wanted)) or read[-1])
    area.advance(spark, START + dt.timedelta(days=11))
    # day 11 enters; days 9, 7 and 3 leave
    assert {r.order_date for r in read[0].select("order_date").distinct().collect()} <= {START + dt.timedelta(days=d) for d in (11, 9, 7, 3)}
    held = {p.split("/platewise_bucket=")[1].split("/")[0] for p in area.days.read(spark).inputFiles()}
    used = {p.split("/platewise_bucket=")[1].split("/")[0] for p in read[0].inputFiles() if "/days/" in p}
    assert len(used) <= 4 < len(held)


def test_a_change_rewrites_only_its_customers_buckets(spark):
    w = World(spark, 6)
    users = incremental.CustomerCategories(work_path(spark, "users"), buckets=64)
    many = w.orders.withColumn("user_id", F.concat(F.lit("u"), (F.col("order_id") % 50).cast("string")))
    users.apply(1, many.select("order_id"), many.limit(0), many, w.items, w.tags)
    dirs = users.ranked.version(spark)["dirs"]
    one = w.items.join(w.tags.where("new_dish_type_l3 IS NOT NULL"), "menu_id").join(many.where("order_status = 'COMPLETE'"), "order_id").first().order_id
    less = many.where(F.col("order_id") != one)
    users.apply(2, spark.createDataFrame([(one,)], "order_id long"), many, less, w.items, w.tags)
    changed = [a != b for a, b in zip(dirs, users.ranked.version(spark)["dirs"])]
    assert sum(changed) == 1
    assert rows(users.read(spark, START)) == rows(gold.customer_category(less, w.items, w.tags, START))


def test_a_change_that_failed_halfway_is_repeated(spark, monkeypatch):
    w = World(spark, 7, days=4)
    last, first = START + dt.timedelta(days=3), START + dt.timedelta(days=2)
    (before, _), (after, ids) = w.at(first), w.at(last)
    area = incremental.AreaWindows(work_path(spark, "area"), (1, 3), day_buckets=16)
    area.apply(1, before.select("order_id"), before.limit(0), before, w.items, w.shop, w.address, w.tags)
    area.advance(spark, first)

    def fail(*a, **k):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(area.moved, "replace_groups", fail)
        with pytest.raises(OSError):
            area.apply(2, ids, before, after, w.items, w.shop, w.address, w.tags)
    with pytest.raises(ValueError, match="repeat"):
        area.advance(spark, last)
    area.apply(2, ids, before, after, w.items, w.shop, w.address, w.tags)
    area.advance(spark, last)
    full = gold.area_category(after, w.items, w.shop, w.address, w.tags, [last], (1, 3))
    assert rows(area.read(spark)) == rows(full.select(area.read(spark).columns))
