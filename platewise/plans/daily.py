"""One business day of the jobs, in their order, with their sinks.

Each step reads what the previous one stored (as the scheduled notebooks do):
tags are appended, gold tables are written (area by day, the others as
snapshots), shop changes are found against the previous stored snapshot, the
list table is upserted and exported.  Every step takes ``busi_dt``; a rerun of
a day replaces that day instead of adding to it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from platewise.plans import gold, lists, ml, tagging
from platewise.sources import sinks
from platewise.sources.ledger import Ledger


@dataclass
class Inputs:
    """Source tables of a day (DataFrames over the stored tables)."""

    orders: DataFrame
    items: DataFrame
    shop: DataFrame
    address: DataFrame
    menu: DataFrame
    encoder: DataFrame
    name_map: DataFrame
    id_map: DataFrame


@dataclass
class Layout:
    """Where each produced table lives (a folder per table below ``root``)."""

    root: str

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"


def tag_new_menus(spark: SparkSession, src: Inputs, out: Layout, model: PipelineModel, run_date,
                  seed_tags: DataFrame | None = None, on_missing: str = "error") -> DataFrame:
    """Append tags for menus not tagged yet; returns the stored tag table.

    The table is partitioned by run date and only the day's new rows are written
    (a rerun of a day finds its menus tagged already).  Where nothing is new the
    job stops before it scores or writes anything.
    """
    path = out.path("dish_tagging")
    if not sinks.exists(spark, path):
        if seed_tags is None:
            raise ValueError("no tag table yet: pass seed_tags for the first day")
        sinks.write_append(seed_tags, path, ["run_date"], idempotent=False)
    tagged = sinks.read_table_dir(spark, path)
    if tagging.nothing_new(src.menu, tagged):
        return tagged
    new = tagging.tag_menus(src.menu, tagged, model, src.encoder, src.name_map, src.id_map,
                            run_date, on_missing=on_missing)
    sinks.write_append(new, path, ["run_date"], idempotent=False)
    return sinks.read_table_dir(spark, path)


def tag_day(spark: SparkSession, src: Inputs, out: Layout, model_path: str, run_date,
            seed_tags: DataFrame | None = None, on_missing: str = "error") -> DataFrame:
    """:func:`tag_new_menus` with the model and the encoder that :func:`ml.save_model` stored."""
    model, encoder = ml.load_model(spark, model_path)
    return tag_new_menus(spark, replace(src, encoder=encoder), out, model, run_date, seed_tags, on_missing)


def gold_tables(spark: SparkSession, src: Inputs, tags: DataFrame, out: Layout, busi_dt,
                windows: Sequence[int] = (1, 7, 30, 120, 365)) -> dict[str, DataFrame]:
    """Write the four gold tables and the shop change table for ``busi_dt``."""
    busi = busi_dt if isinstance(busi_dt, dt.date) else dt.date.fromisoformat(str(busi_dt))
    area = gold.area_category(src.orders, src.items, src.shop, src.address, tags, [busi], windows)
    sinks.write_append(area, out.path("area_category"), ["busi_dt"])

    # Two sinks read the per-user base: keep it (memory, then disk; recomputed
    # from lineage if an executor is lost) while both are written.
    base = gold.user_dish_counts(src.orders, src.items, tags).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        sinks.write_snapshot(gold.customer_category(None, None, None, busi, base=base),
                             out.path("customer_category"))
        sinks.write_snapshot(gold.menu_category(None, None, None, busi, base=base), out.path("menu_category"))
    finally:
        base.unpersist()

    # the newest snapshot of an earlier day, so a rerun finds the day's changes again
    prev = sinks.read_snapshot_before(spark, out.path("shop_category"), "busi_dt", busi)
    shop_today = gold.shop_category(src.orders, src.items, tags, busi)
    shop_path = sinks.write_snapshot(shop_today, out.path("shop_category"))
    stored_today = spark.read.parquet(shop_path)
    if prev is not None:
        changed = gold.shop_category_change(stored_today, prev, busi)
    else:
        changed = stored_today
    sinks.write_snapshot(changed, out.path("shop_category_change"))
    return {name: sinks.read_snapshot(spark, out.path(name)) for name in
            ("customer_category", "menu_category", "shop_category", "shop_category_change")} | {
        "area_category": sinks.read_table_dir(spark, out.path("area_category"))}


def list_table(spark: SparkSession, src: Inputs, out: Layout, busi_dt, exclude: Sequence[str] = (),
               k: int = 10) -> DataFrame:
    """Upsert the per-customer lists from the stored gold tables; export key-value items."""
    cc = sinks.read_snapshot(spark, out.path("customer_category"))
    pop = lists.popular_dishes(sinks.read_table_dir(spark, out.path("area_category")), 7, exclude)
    table = sinks.KeyedTable(out.path("customer_category_list"), ["user_id"])
    table.upsert(lists.customer_lists(cc, pop, src.id_map, busi_dt, exclude, k))
    stored = table.read(spark)
    sinks.write_snapshot(lists.to_kv(stored), out.path("customer_category_kv"))
    return stored


def run_day(spark: SparkSession, src: Inputs, out: Layout, busi_dt, tags: DataFrame,
            exclude: Sequence[str] = (), k: int = 10,
            windows: Sequence[int] = (1, 7, 30, 120, 365)) -> DataFrame:
    """Gold tables then lists for one day (tagging runs before, see :func:`tag_new_menus`)."""
    gold_tables(spark, src, tags, out, busi_dt, windows)
    return list_table(spark, src, out, busi_dt, exclude, k)


def publish_day(spark: SparkSession, src: Inputs, ledger: Ledger, busi_dt, tags: DataFrame,
                exclude: Sequence[str] = (), k: int = 10,
                windows: Sequence[int] = (1, 7, 30, 120, 365)) -> int:
    """:func:`run_day` whose tables become visible by one commit; the ledger's new number.

    Readers (``ledger.read``, for the area table ``ledger.read_days``) see the day before in
    full until all tables are stored.  A rerun builds on the day before it, as the first run
    did, and takes that run's place; days after it that are published already keep their
    tables until they are rerun too.  Raises where another run was published meanwhile.
    """
    busi = busi_dt if isinstance(busi_dt, dt.date) else dt.date.fromisoformat(str(busi_dt))
    run = ledger.begin(spark, busi)
    area = run.write("area_category", gold.area_category(src.orders, src.items, src.shop, src.address, tags, [busi], windows))
    base = gold.user_dish_counts(src.orders, src.items, tags).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        customers = run.write("customer_category", gold.customer_category(None, None, None, busi, base=base))
        run.write("menu_category", gold.menu_category(None, None, None, busi, base=base))
    finally:
        base.unpersist()
    shops, earlier = run.write("shop_category", gold.shop_category(src.orders, src.items, tags, busi)), run.before("shop_category")
    run.write("shop_category_change", shops if earlier is None else gold.shop_category_change(shops, earlier, busi))
    made = lists.customer_lists(customers, lists.popular_dishes(area, 7, exclude), src.id_map, busi, exclude, k)
    made = sinks.fail_on_duplicates(made.where(F.col("user_id").isNotNull()), ["user_id"])
    made = run.write("customer_category_list_batch", made)
    stored = run.write("customer_category_list", sinks.merge_by_key(run.before("customer_category_list"), made, ["user_id"]))
    run.write("customer_category_kv", lists.to_kv(stored))
    return run.publish()
