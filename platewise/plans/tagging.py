"""Incremental menu tagging: new menus -> class -> dish type -> renamed -> id."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platewise.functions.text import normalise_name
from platewise.operators.relational import attach_id, decode_label, map_or_self, not_in
from platewise.operators.screening import not_in_screened
from platewise.plans.ml import predict
from platewise.schemas import DISH_TAGGING
from platewise.sources.tables import guard_nonempty


def new_menus(menu: DataFrame, tagged: DataFrame, null_aware: bool = True) -> DataFrame:
    """Menus whose id is not yet in the tagged table (``NOT IN`` semantics)."""
    return not_in(menu.select("menu_id", "menu_name"), tagged, "menu_id", null_aware=null_aware)


def new_menus_of_batch(batch: DataFrame, tagged: DataFrame, null_aware: bool = True) -> DataFrame:
    """:func:`new_menus` for a delivery of menus against a tag table many times its size: the tag
    table is screened where it lies and only the tags that the batch may meet are joined."""
    return not_in_screened(batch.select("menu_id", "menu_name"), tagged, "menu_id", null_aware=null_aware)


def nothing_new(menu: DataFrame, tagged: DataFrame, null_aware: bool = True) -> bool:
    """True if every menu is tagged already (reads until the first one that is not)."""
    return new_menus(menu, tagged, null_aware).isEmpty()


def decode_tags(scored: DataFrame, encoder: DataFrame, name_map: DataFrame, id_map: DataFrame,
                run_date, on_missing: str = "error", strict_class: bool = True) -> DataFrame:
    """From ``(menu_id, menu_name, category_id, prob)`` to dish_tagging rows.

    Class 0 is ``other``; names are renamed through ``name_map`` (target
    lower-cased, spaces to ``_``, unknown names pass through); the new id is
    attached by name, failing (``error``) or NULL (``null``) when missing.
    """
    dec = decode_label(scored, encoder, "category_id", "dish_type_l3", strict=strict_class)
    nm = name_map.select("dish_type_l3", normalise_name("new_dish_type").alias("new_dish_type"))
    ren = map_or_self(dec, "dish_type_l3", nm, "dish_type_l3", "new_dish_type", out="new_dish_type_l3")
    ided = attach_id(ren, id_map, on="new_dish_type_l3", out="new_category_id", on_missing=on_missing)
    out = ided.withColumn("run_date", F.lit(run_date).cast("date"))
    return out.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in DISH_TAGGING.fields])


def tag_menus(menu: DataFrame, tagged: DataFrame, model: PipelineModel, encoder: DataFrame,
              name_map: DataFrame, id_map: DataFrame, run_date, on_missing: str = "error",
              null_aware: bool = True) -> DataFrame:
    """Tag every menu not tagged yet; returns the rows to append (maybe none).

    One lazy plan from the menu table to the sink: the model scores on the
    executors, the mappers are broadcast after a size check.
    """
    guard_nonempty(menu.select("menu_id"), "menu")
    new = new_menus(menu, tagged, null_aware)
    scored = predict(model, new, text_col="menu_name")
    scored = scored.select("menu_id", "menu_name", "category_id", "prob")
    return decode_tags(scored, encoder, name_map, id_map, run_date, on_missing)
