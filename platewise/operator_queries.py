"""Registered queries for the single operators and functions of the jobs.

Each one runs a library operator over the whole fixture tables (or frames
Spark derives from them), so it can be checked alone against the oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platewise.functions.arrays import argmax, key_json, max_prob, tagged_names
from platewise.functions.text import clean_text, normalise_name, percentile_label
from platewise.operators import relational as R
from platewise.operators.screening import not_in_screened
from platewise.plans import calibration, embedding, gold, lists, ml, tagging
from platewise.schemas import DISH_TAGGING
from platewise.session import durable, work_path
from platewise.sources import sinks
from platewise.sources.fixtures import (
    EXCLUDE,
    LIST_K,
    PREV_CUTOFF,
    PREV_RUN_DATE,
    RUN_DATE,
    SEED,
    TAGGING_RUN_DATE,
    WINDOWS,
    Fixtures,
)
from platewise.sources.tables import guard_nonempty, read_table


def _f(spark, sf) -> Fixtures:
    return Fixtures(spark, sf)


def _base(f: Fixtures) -> DataFrame:
    return gold.user_dish_counts(f.order_transaction(), f.order_item(), f.dish_tagging())


def _area(f: Fixtures, runs=(RUN_DATE,)) -> DataFrame:
    return gold.area_category(f.order_transaction(), f.order_item(), f.shop(), f.address(),
                              f.dish_tagging(), list(runs), WINDOWS)


def _pop(f: Fixtures) -> DataFrame:
    from platewise.queries import popular

    return popular(f)


def _cc(f: Fixtures) -> DataFrame:
    return gold.customer_category(f.order_transaction(), f.order_item(), f.dish_tagging(), RUN_DATE)


def _shop(f: Fixtures, busi=RUN_DATE, cutoff=None) -> DataFrame:
    o = f.order_transaction()
    if cutoff is not None:
        o = o.where(F.col("order_date") < F.lit(cutoff))
    return gold.shop_category(o, f.order_item(), f.dish_tagging(), busi)


def _padded(f: Fixtures) -> DataFrame:
    return lists.padded_lists(_cc(f), _pop(f), EXCLUDE, LIST_K)


def _lists(f: Fixtures) -> DataFrame:
    from platewise.queries import _lists as stored_area_lists

    return stored_area_lists(f)


def _served(f: Fixtures) -> DataFrame:
    from platewise.queries import _stored_lists

    return lists.serve(f.requests(), _stored_lists(f))


def _distinct_ranked(f: Fixtures) -> DataFrame:
    pairs = _base(f).select("user_id", "count_order").distinct()
    return R.number_rows(pairs, ["user_id"], [F.col("count_order").asc()], "rk").withColumn(
        "n", F.count(F.lit(1)).over(R.group_window("user_id")))


# ------------------------------------------------------ sources and sinks ---

def scan_table(spark, sf):
    return read_table(spark, f"{sf}/part.parquet", ["p_partkey", "p_name"])


def source_guard(spark, sf):
    menu = guard_nonempty(_f(spark, sf).menu(), "menu")
    return menu.agg(F.count(F.lit(1)).alias("n_menu"))


def single_row_source(spark, sf):
    top = lists.top_list(_pop(_f(spark, sf)), 2 * LIST_K)
    return lists.default_row(spark, top, LIST_K)


def sink_append(spark, sf):
    path = work_path(spark, "area_category")
    area = _area(_f(spark, sf))
    sinks.write_append(area, path, ["busi_dt"])
    sinks.write_append(area, path, ["busi_dt"])  # a rerun replaces the day, never doubles it
    back = sinks.read_table_dir(spark, path)
    return back.select(*[F.col(c).cast(area.schema[c].dataType).alias(c) for c in area.columns])


def sink_overwrite(spark, sf):
    root = work_path(spark, "shop_category")
    shop = _shop(_f(spark, sf))
    sinks.write_snapshot(shop, root)
    sinks.write_snapshot(shop, root)
    return sinks.read_snapshot(spark, root)


def sink_schema_evolve(spark, sf):
    f = _f(spark, sf)
    return sinks.union_evolve(_shop(f, PREV_RUN_DATE, PREV_CUTOFF).drop("busi_dt"), _shop(f))


# ------------------------------------------------- projections and filters ---

def project_alias(spark, sf):
    return gold.tag_view(_f(spark, sf).dish_tagging())


def rename_positional(spark, sf):
    return _f(spark, sf).category_id_mapper().toDF("new_dish_type_l3", "new_category_id")


def drop_column(spark, sf):
    return _f(spark, sf).dish_tagging().drop("menu_name", "prob")


def cast_output(spark, sf):
    return R.conform(_f(spark, sf).dish_tagging(), DISH_TAGGING)


def stamp_literals(spark, sf):
    return R.stamp(_pop(_f(spark, sf)), busi_dt=RUN_DATE, run_date=RUN_DATE, num_retro_days=7)


def filter_status(spark, sf):
    o = _f(spark, sf).order_transaction()
    return o.where(F.col("order_status") == "COMPLETE").select("order_id", "user_id", "order_date")


def filter_tagged(spark, sf):
    return R.tagged_only(gold.tag_view(_f(spark, sf).dish_tagging()), drop_empty=True)


def filter_exclude_list(spark, sf):
    return R.exclude_values(_f(spark, sf).category_id_mapper(), "category_name", EXCLUDE)


def filter_retro_window(spark, sf):
    o = _f(spark, sf).order_transaction()
    return o.where(R.in_retro("order_date", RUN_DATE, 30)).select("order_id", "order_date", "total_amount")


def filter_latest_partition(spark, sf):
    from platewise.queries import stored_area

    return R.latest(stored_area(_f(spark, sf), (PREV_RUN_DATE, RUN_DATE)), "busi_dt")


def empty_to_null(spark, sf):
    return R.blank_to_null(gold.tag_view(_f(spark, sf).dish_tagging()))


def drop_null_rows(spark, sf):
    t = R.blank_to_null(gold.tag_view(_f(spark, sf).dish_tagging()))
    return t.dropna(how="all", subset=["dish_type_l3"])


def conditional_label(spark, sf):
    f = _f(spark, sf)
    return R.decode_label(f.dish_tagging().select("menu_id", "category_id"), f.dish_type_encoder())


# ------------------------------------------------------------------- joins ---

def join_order_items(spark, sf):
    f = _f(spark, sf)
    return f.order_transaction().select("order_id", "user_id").join(f.order_item(), "order_id", "left")


def join_items_right(spark, sf):
    f = _f(spark, sf)
    return f.order_transaction().select("order_id", "user_id").join(f.order_item(), "order_id", "right")


def join_dim_chain(spark, sf):
    f = _f(spark, sf)
    return gold.with_area(f.order_transaction().select("order_id", "shop_id"), f.shop(), f.address())


def join_tags(spark, sf):
    f = _f(spark, sf)
    return gold.tagged_lines(f.order_transaction().select("order_id", "user_id"), f.order_item(),
                             f.dish_tagging())


def join_decile_back(spark, sf):
    return R.decile_of_distinct(_base(_f(spark, sf)), "user_id", "count_order").drop("recent_order_dt", "recent_order_at")


def anti_changed_rows(spark, sf):
    f = _f(spark, sf)
    return gold.shop_category_change(_shop(f), _shop(f, PREV_RUN_DATE, PREV_CUTOFF), RUN_DATE,
                                     null_safe=True)


def anti_not_in_nullaware(spark, sf):
    f = _f(spark, sf)
    menu = f.menu()  # with some NULL ids: NULL NOT IN (...) is not true
    lost = menu.where(F.col("menu_id") % 100 == 0).select(F.lit(None).cast("bigint").alias("menu_id"), "menu_name")
    return tagging.new_menus(menu.unionByName(lost), f.dish_tagging())


def anti_not_in_screened(spark, sf):
    """Ordered menus that no tag names, with their order lines: counted first, then against the tag table."""
    f = _f(spark, sf)
    counts = durable(f.order_item().groupBy("menu_id").agg(F.count(F.lit(1)).alias("n_lines")))
    return not_in_screened(counts, f.dish_tagging(), "menu_id")


def lookup_strict(spark, sf):
    f = _f(spark, sf)
    m = f.menu().withColumn("_name", normalise_name("menu_name"))
    return R.map_strict(m, "_name", f.category_id_mapper(), "category_name", "category_id",
                        "category_id", on_missing="error").drop("_name")


def _renamed(f: Fixtures) -> DataFrame:
    nm = f.category_name_mapper().select("dish_type_l3", normalise_name("new_dish_type").alias("new_dish_type"))
    names = f.category_id_mapper().select(F.col("category_name").alias("dish_type_l3"))
    return R.map_or_self(names, "dish_type_l3", nm, "dish_type_l3", "new_dish_type", out="new_dish_type_l3")


def lookup_passthrough(spark, sf):
    return _renamed(_f(spark, sf))


def lookup_left_id(spark, sf):
    f = _f(spark, sf)
    return R.attach_id(_renamed(f), f.category_id_mapper(), on_missing="null")


# ------------------------------------------------------------ aggregations ---

def agg_user_dish(spark, sf):
    return _base(_f(spark, sf)).drop("recent_order_at")


def agg_shop_dish(spark, sf):
    f = _f(spark, sf)
    return gold.shop_counts(f.order_transaction(), f.order_item(), f.dish_tagging())


def agg_regroup_unique(spark, sf):
    return _base(_f(spark, sf)).groupBy("user_id", "dish_type_l3", "category_id").agg(
        F.count(F.lit(1)).alias("count_order"))


def agg_distinct_pairs(spark, sf):
    return _base(_f(spark, sf)).select("user_id", "count_order").distinct()


def agg_distinct_labels(spark, sf):
    return ml.fit_labels(_f(spark, sf).training_data(), "dish_type_l3")


def agg_collect_list(spark, sf):
    return lists.own_lists(_cc(_f(spark, sf)), EXCLUDE, LIST_K)


def agg_global(spark, sf):
    o = _f(spark, sf).order_transaction()
    return o.agg(F.count(F.lit(1)).alias("n_versions"), F.max("order_date").alias("max_order_date"))


def _softmax(c):
    ex = F.transform(c, lambda x: F.exp(x.cast("double")))
    total = F.aggregate(ex, F.lit(0.0), lambda a, x: a + x)
    return F.transform(ex, lambda x: x / total)


def agg_model_metrics(spark, sf):
    v = _f(spark, sf).vector_data()
    pred = v.withColumn("probs", _softmax("embedding")).withColumn("category_id", argmax("embedding"))
    m = ml.evaluate(pred, "label", "probs", "category_id")
    return m.select(F.round("loss", 6).alias("loss"), F.round("accuracy", 6).alias("accuracy"), "n")


# ----------------------------------------------------------------- windows ---

def win_latest_version(spark, sf):
    o = _f(spark, sf).order_transaction().select("order_id", "total_amount", "order_status", "updt_dttm")
    return R.latest_version(o, "order_id", "updt_dttm")


def win_one_line_per_order(spark, sf):
    f = _f(spark, sf)
    picked = gold.area_lines(f.order_transaction(), f.order_item(), f.shop(), f.address(),
                             f.dish_tagging(), [RUN_DATE], [30])
    return picked.select("order_id", "total_amount", "address_subdistrict", "dish_type_l3", "category_id")


def win_rank_asc(spark, sf):
    return _distinct_ranked(_f(spark, sf)).select("user_id", "count_order", "rk")


def win_partition_count(spark, sf):
    return _distinct_ranked(_f(spark, sf)).select("user_id", "count_order", "n")


def win_decile_bucket(spark, sf):
    r = _distinct_ranked(_f(spark, sf))
    return r.select("user_id", "count_order", R.decile("rk", "n").alias("decile"))


def win_topk_multi_key(spark, sf):
    cc = R.exclude_values(_cc(_f(spark, sf)), "dish_type_l3", EXCLUDE).where(F.col("user_id").isNotNull())
    return R.top_k(cc, ["user_id"], [F.col("decile").desc_nulls_last(), F.col("rank").desc_nulls_last(),
                                     F.col("dish_type_l3").asc(), F.col("category_id").asc()],
                   LIST_K, rank_col="pos").select("user_id", "dish_type_l3", "category_id", "pos")


def sort_multi_key(spark, sf):
    top = win_topk_multi_key(spark, sf)
    return top.orderBy("user_id", "pos").select("user_id", "dish_type_l3", "category_id")


# ------------------------------------------------------- sort, limit, union ---

def sort_by_aggregate(spark, sf):
    """Dish names in the order of an aggregate that is not selected."""
    return _pop(_f(spark, sf)).orderBy(*lists.popularity_order()).select("dish_type_l3")


def limit_list(spark, sf):
    f = _f(spark, sf)
    served = lists.serve_items(_served(f))
    return served.select("user_id", F.transform(F.slice("recommended_items", 1, LIST_K),
                                                lambda x: x["name"]).alias("names"))


def union_by_name(spark, sf):
    f = _f(spark, sf)
    return _shop(f).unionByName(_shop(f, PREV_RUN_DATE, PREV_CUTOFF))


# ------------------------------------------------------------------ scalars ---

def fn_clean_text(spark, sf):
    d = _f(spark, sf).raw("documents").select("doc_id", "text")
    return d.select("doc_id", clean_text("text").alias("cleaned"))


def fn_normalise_name(spark, sf):
    nm = _f(spark, sf).category_name_mapper()
    return nm.select("dish_type_l3", normalise_name("new_dish_type").alias("new_dish_type"))


def fn_percentile_label(spark, sf):
    d = R.decile_of_distinct(_base(_f(spark, sf)), "user_id", "count_order")
    return d.select("user_id", "dish_type_l3", "category_id", percentile_label("decile").alias("percentile"))


def fn_date_cast(spark, sf):
    o = _f(spark, sf).order_transaction()
    return o.select("order_id", F.to_date("updt_dttm").alias("updt_date"))


def fn_date_sub(spark, sf):
    o = _f(spark, sf).order_transaction()
    return o.select("order_id", F.date_sub("order_date", 7).alias("week_before"),
                    F.date_sub(F.lit(RUN_DATE), 1).alias("yesterday"))


def fn_ceiling(spark, sf):
    r = _distinct_ranked(_f(spark, sf))
    return r.select("user_id", "count_order",
                    F.ceil(F.col("rk") * F.lit(10.0) / F.col("n")).cast("int").alias("decile"))


def fn_argmax(spark, sf):
    v = _f(spark, sf).vector_data()
    return v.select("key", argmax("embedding").alias("category_id"))


def fn_max_prob(spark, sf):
    v = _f(spark, sf).vector_data()
    return v.select("key", max_prob("embedding").alias("prob"))


def fn_array_pad(spark, sf):
    return _padded(_f(spark, sf)).select("user_id", F.col("_padded").alias("padded"))


def _exploded(df: DataFrame, col: str) -> DataFrame:
    x = df.select("user_id", F.posexplode(col).alias("pos", "item"))
    return x.select("user_id", (F.col("pos") + 1).cast("int").alias("pos"),
                    F.col("item.id").alias("id"), F.col("item.name").alias("name"))


def fn_struct_list(spark, sf):
    f = _f(spark, sf)
    s = lists.dish_structs(_padded(f), f.category_id_mapper(), "_padded", "items")
    return _exploded(s, "items")


def fn_to_json(spark, sf):
    return _lists(_f(spark, sf)).select("user_id", "gd_dish_types")


def fn_from_json(spark, sf):
    f = _f(spark, sf)
    served = lists.serve_items(_served(f))
    return _exploded(served, "recommended_items")


def fn_tagged_list(spark, sf):
    p = _padded(_f(spark, sf))
    stored = p.select("user_id", F.transform("_padded", lambda x: F.struct(x.alias("S"))).alias("L"))
    return stored.select("user_id", F.slice(tagged_names("L"), 1, LIST_K).alias("names"))


def fn_key_json(spark, sf):
    return _lists(_f(spark, sf)).select("user_id", key_json("user_id").alias("key"))


# ---------------------------------------------------------------- ML, tags ---

_MODELS: dict = {}
ZERO_SHARE = 50  # weights of the fixed softmax layer: (i * 7 + j * 3) % 11 - 5, in fiftieths


def _tag_training(f: Fixtures) -> DataFrame:
    """Tagged menus as training rows: name -> dish, split by menu id.  A class's own
    name is an example of it too, so that every class has one."""
    enc = f.dish_type_encoder()
    rows = f.dish_tagging().select("menu_id", "menu_name", "dish_type_l3")
    rows = ml.split(ml.encode_labels(rows, "dish_type_l3", enc), "menu_id", SEED)
    own = enc.select(F.lit(None).cast("bigint").alias("menu_id"), F.replace("dish_type_l3", F.lit("_"), F.lit(" ")).alias("menu_name"),
                     "dish_type_l3", F.col("category_id").alias("label"), F.lit("train").alias("split"))
    return rows.unionByName(own)


def _tag_model(spark, sf):
    """The tagging model, trained once per application, stored and loaded with its encoder."""
    key = (sf, spark.sparkContext.applicationId)
    if key not in _MODELS:
        f, path = _f(spark, sf), work_path(spark, "tag-model")
        model, metrics = ml.train_and_validate(_tag_training(f), "menu_name", num_features=1 << 12, max_iter=30, reg=1e-6)
        ml.save_model(model, f.dish_type_encoder(), path)
        _MODELS[key] = (*ml.load_model(spark, path), metrics)
    return _MODELS[key]


def _text_data(spark, sf):
    td = _f(spark, sf).training_data()
    return ml.split(ml.encode_labels(td, "dish_type_l3", ml.fit_labels(td, "dish_type_l3")), "key", SEED)


def _softmax_layer(classes: int = 10, width: int = 64, share: float = ZERO_SHARE):
    return [[((i * 7 + j * 3) % 11 - 5) / share for j in range(width)] for i in range(classes)]


def udf_batch_predict(spark, sf):
    """An external softmax layer scored in Arrow batches; probabilities to six places."""
    v = _f(spark, sf).vector_data()
    s = ml.score(v, "embedding", ml.shipped_softmax_predict_fn(spark, _softmax_layer(), [0.0] * 10), batch_size=1024, width=64)
    return s.select("key", "category_id", F.round("prob", 5).alias("prob"))


def _softmax_bins(spark, sf) -> DataFrame:
    """Reliability of an external softmax layer, too sure of itself, on the vectors' labels."""
    v = _f(spark, sf).vector_data()
    s = ml.score(v, "embedding", ml.softmax_predict_fn(_softmax_layer(share=2.5), [0.0] * 10), batch_size=1024, width=64)
    single = F.col("prob").cast("float").cast("double")  # stored scores are in single precision
    return durable(calibration.reliability(s.withColumn("prob", F.round(single, 5)), bins=20))


def ml_reliability(spark, sf):
    return _softmax_bins(spark, sf)


def ml_calibration_error(spark, sf):
    return calibration.calibration_error(_softmax_bins(spark, sf))


def ml_calibrate(spark, sf):
    """Every bin's probability after pooling adjacent violators."""
    return calibration.calibrated_bins(_softmax_bins(spark, sf)).select("bin", "n", "hits", "calibrated")


def ml_label_encode(spark, sf):
    """Every row's label as its class id, and back to the name."""
    td = _f(spark, sf).training_data()
    enc = ml.fit_labels(td, "dish_type_l3")
    rows = ml.encode_labels(td, "dish_type_l3", enc).select("key", "label")
    return R.decode_label(rows, enc, "label", "decoded", other=False).select("key", "label", "decoded")


def ml_split(spark, sf):
    return ml.split(_f(spark, sf).training_data(), "key", SEED).select("key", "split")


def ml_split_exact(spark, sf):
    return ml.split_exact(_f(spark, sf).training_data().select("key"), "key", SEED).select("key", "split")


def ml_train_text(spark, sf):
    """Language of whole documents: fitted on the train rows, scored on the test rows."""
    data = _text_data(spark, sf)
    model, _ = ml.train_and_validate(data, "dish_name")
    pred = ml.predict(model, data.where(F.col("split") == "test"), text_col="dish_name")
    return pred.select("key", "label", "category_id", "prob")


def ml_train_embedding_bag(spark, sf):
    """``ml_train_text``'s task by an embedding bag that learns in copies, steered by the ``val`` rows."""
    data = _text_data(spark, sf)
    pred = embedding.predict(embedding.train(data, "dish_name"), data.where(F.col("split") == "test"), "dish_name")
    return pred.select("key", "label", "category_id", "prob")


def ml_evaluate(spark, sf):
    """Loss and accuracy of the tagging model on the test menus (a class is a name here, so the
    model has seen every name; ``ml_train_text`` scores unseen texts)."""
    model, _, _ = _tag_model(spark, sf)
    test = _tag_training(_f(spark, sf)).where(F.col("split") == "test")
    return ml.evaluate(ml.predict(model, test, text_col="menu_name")).select("loss", "accuracy", "n")


def ml_train_vector(spark, sf):
    v = ml.split(_f(spark, sf).vector_data(), "key", SEED)
    model = ml.train_vec(v.where(F.col("split") == "train"), "embedding", "label")
    pred = ml.predict(model, v.where(F.col("split") == "test"), vector_col="embedding")
    return pred.select("key", "label", "category_id", "prob")


def ml_predict(spark, sf):
    """Class of every menu name and its probability."""
    model, _, _ = _tag_model(spark, sf)
    menu = _f(spark, sf).menu()
    return ml.predict(model, menu, text_col="menu_name").select("menu_id", "category_id", "prob")


def ml_predict_class(spark, sf):
    return ml_predict(spark, sf).drop("prob")


def tag_menus(spark, sf):
    f = _f(spark, sf)
    model, enc, _ = _tag_model(spark, sf)
    return tagging.tag_menus(f.menu(), f.dish_tagging(), model, enc, f.category_name_mapper(),
                             f.category_id_mapper(), TAGGING_RUN_DATE, on_missing="null")


def tag_menus_without_prob(spark, sf):
    return tag_menus(spark, sf).drop("prob")


def tag_decode(spark, sf):
    """Tagging after scoring, with each new menu's class given by its own name."""
    f = _f(spark, sf)
    new = tagging.new_menus(f.menu(), f.dish_tagging())
    cls = R.map_strict(new.withColumn("_name", normalise_name("menu_name")), "_name", f.dish_type_encoder(),
                       "dish_type_l3", "category_id", "category_id").drop("_name")
    scored = cls.withColumn("prob", F.lit(1.0))
    return tagging.decode_tags(scored, f.dish_type_encoder(), f.category_name_mapper(),
                               f.category_id_mapper(), TAGGING_RUN_DATE, on_missing="null")


OPERATOR_QUERIES = {
    "scan_table": scan_table,
    "source_guard": source_guard,
    "single_row_source": single_row_source,
    "sink_append": sink_append,
    "sink_overwrite": sink_overwrite,
    "sink_schema_evolve": sink_schema_evolve,
    "project_alias": project_alias,
    "rename_positional": rename_positional,
    "drop_column": drop_column,
    "cast_output": cast_output,
    "stamp_literals": stamp_literals,
    "filter_status": filter_status,
    "filter_tagged": filter_tagged,
    "filter_exclude_list": filter_exclude_list,
    "filter_retro_window": filter_retro_window,
    "filter_latest_partition": filter_latest_partition,
    "empty_to_null": empty_to_null,
    "drop_null_rows": drop_null_rows,
    "conditional_label": conditional_label,
    "join_order_items": join_order_items,
    "join_items_right": join_items_right,
    "join_dim_chain": join_dim_chain,
    "join_tags": join_tags,
    "join_decile_back": join_decile_back,
    "anti_changed_rows": anti_changed_rows,
    "anti_not_in_nullaware": anti_not_in_nullaware,
    "anti_not_in_screened": anti_not_in_screened,
    "lookup_strict": lookup_strict,
    "lookup_passthrough": lookup_passthrough,
    "lookup_left_id": lookup_left_id,
    "agg_user_dish": agg_user_dish,
    "agg_shop_dish": agg_shop_dish,
    "agg_regroup_unique": agg_regroup_unique,
    "agg_distinct_pairs": agg_distinct_pairs,
    "agg_distinct_labels": agg_distinct_labels,
    "ml_label_encode": ml_label_encode,
    "agg_collect_list": agg_collect_list,
    "agg_global": agg_global,
    "agg_model_metrics": agg_model_metrics,
    "win_latest_version": win_latest_version,
    "win_one_line_per_order": win_one_line_per_order,
    "win_rank_asc": win_rank_asc,
    "win_partition_count": win_partition_count,
    "win_decile_bucket": win_decile_bucket,
    "win_topk_multi_key": win_topk_multi_key,
    "sort_multi_key": sort_multi_key,
    "sort_by_aggregate": sort_by_aggregate,
    "limit_list": limit_list,
    "union_by_name": union_by_name,
    "fn_clean_text": fn_clean_text,
    "fn_normalise_name": fn_normalise_name,
    "fn_percentile_label": fn_percentile_label,
    "fn_date_cast": fn_date_cast,
    "fn_date_sub": fn_date_sub,
    "fn_ceiling": fn_ceiling,
    "fn_argmax": fn_argmax,
    "fn_max_prob": fn_max_prob,
    "fn_array_pad": fn_array_pad,
    "fn_struct_list": fn_struct_list,
    "fn_to_json": fn_to_json,
    "fn_from_json": fn_from_json,
    "fn_tagged_list": fn_tagged_list,
    "fn_key_json": fn_key_json,
    "udf_batch_predict": udf_batch_predict,
    "ml_reliability": ml_reliability,
    "ml_calibration_error": ml_calibration_error,
    "ml_calibrate": ml_calibrate,
    "ml_split": ml_split,
    "ml_split_exact": ml_split_exact,
    "ml_train_text": ml_train_text,
    "ml_train_embedding_bag": ml_train_embedding_bag,
    "ml_train_vector": ml_train_vector,
    "ml_predict": ml_predict,
    "ml_predict_class": ml_predict_class,
    "ml_evaluate": ml_evaluate,
    "tag_menus": tag_menus,
    "tag_menus_without_prob": tag_menus_without_prob,
    "tag_decode": tag_decode,
}
