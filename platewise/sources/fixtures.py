"""Logical input tables over the driver's parquet files (see FIXTURES.md).

Each method returns a lazy DataFrame built from the given tables, so every job
that uses them grows with the data.  Nothing here is collected.
"""

from __future__ import annotations

import datetime as dt
import functools

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from platewise.operators.relational import sized_broadcast

# Fixed parameter values of the fixture mapping (FIXTURES.md, "Parameters").
RUN_DATE = dt.date(2001, 8, 1)
PREV_RUN_DATE = dt.date(2001, 6, 30)
PREV_CUTOFF = dt.date(2001, 7, 1)
WINDOWS = (1, 7, 30, 120, 365)
LIST_K = 10
SEED = 112
EXCLUDE = ("small_ring", "red_widget", "blue_bolt", "hot_gear",
           "small_gizmo", "small_bolt", "old_bolt", "red_bolt")
TAGGING_RUN_DATE = dt.date(2001, 7, 31)


def _norm(c):
    return F.replace(F.lower(c), F.lit(" "), F.lit("_"))


# (application id, sf dir, table) -> how to read the materialised table
_STORED: dict[tuple[str, str, str], tuple[str, str]] = {}

#: Order tables are stored bucketed by order_id, so the jobs join them without a
#: shuffle (see ``sinks.write_bucketed``); a bucket gets about so many bytes of rows.
BUCKET_BYTES = 256 << 20
UNPACKED = 16  # bytes that a task holds, sorted and counted, for a byte of compressed input
MOST_BUCKETS = 100_000  # Spark's own bound
_BUCKETED = {"order_transaction": ["order_id"], "order_item": ["order_id"]}


def bucket_count(total_bytes: int, at_least: int = 8) -> int:
    """Buckets for tables of ``total_bytes``; both tables of a join take the same number."""
    return max(at_least, -(-total_bytes // BUCKET_BYTES))


def order_buckets(stored_bytes: int) -> int:
    """Buckets for order tables made of ``stored_bytes`` of parquet, of which one task takes a bucket."""
    return min(MOST_BUCKETS, bucket_count(UNPACKED * stored_bytes))


def input_bytes(spark: SparkSession, paths: list[str]) -> int:
    """Bytes below the paths, by the file system that holds them."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    hadoop = [jvm.org.apache.hadoop.fs.Path(p) for p in paths]
    return sum(p.getFileSystem(conf).getContentSummary(p).getLength() for p in hadoop)


def stored(method):
    """Materialise a logical table once per application (see :class:`Fixtures`)."""
    @functools.wraps(method)
    def wrapper(self) -> DataFrame:
        if not self.materialise:
            return method(self)
        name = method.__name__
        if name in _BUCKETED:
            from platewise.session import size_shuffles

            buckets = self.buckets()
            size_shuffles(self.spark, buckets)  # each time: the jobs on these tables shuffle as much as they hold
        key = (self.spark.conf.get("spark.app.id"), self.sf_dir, name)
        if name in _BUCKETED and not self.store_orders and key not in _STORED:
            return method(self).repartition(self.parts(), *_BUCKETED[name])  # both tables alike, so they join as they lie
        if key not in _STORED:
            from platewise.session import work_path
            from platewise.sources.sinks import write_bucketed

            path = work_path(self.spark, f"fixture-{name}")
            df = method(self)
            if name in _BUCKETED:
                table = f"platewise_{name}_{path.rsplit('-', 1)[-1][:12]}"
                write_bucketed(df, table, path, _BUCKETED[name], buckets)
                _STORED[key] = ("table", table)
            else:
                df.write.parquet(path)
                _STORED[key] = ("path", path)
        kind, where = _STORED[key]
        return self.spark.table(where) if kind == "table" else self.spark.read.parquet(where)
    return wrapper


class Fixtures:
    """The logical tables of the pipeline, mapped onto ``sf_dir``.

    With ``materialise`` (the default) each logical table is computed from the
    driver's tables once per application and written as parquet below the
    shared checkpoint folder, as the source tables of the daily jobs would be
    stored; jobs then read real parquet scans (pushdown, pruning, size
    statistics).  ``materialise=False`` returns the lazy mapping plans.

    ``store_orders=False`` is for a job that reads the order tables once: where they
    aren't stored yet, they are mapped in the job itself, since writing and reading
    them back costs more than the one shuffle it saves.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, materialise: bool = True, store_orders: bool = True):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.materialise = materialise
        self.store_orders = store_orders

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def buckets(self) -> int:
        """Buckets of the order tables."""
        return order_buckets(input_bytes(self.spark, [f"{self.sf_dir}/{t}.parquet" for t in ("orders", "lineitem")]))

    def parts(self) -> int:
        """Parts that orders and lines are dealt to: the buckets, or twice as many where a job maps and joins both in one task."""
        return self.buckets() * (1 if self.store_orders else 2)

    # ---- ordering -------------------------------------------------------
    @stored
    def order_transaction(self) -> DataFrame:
        """Order versions: the current one, plus an older one for every tenth order."""
        # Both sides are dealt to the parts they are stored or joined in, so nothing is shuffled again.
        # Lines go there uncounted: of a part of the file a task would hold every order.
        n = self.parts()
        o = self.raw("orders").select("o_orderkey", "o_custkey", "o_orderstatus",
                                      "o_totalprice", "o_orderdate").repartition(n, "o_orderkey")
        first_shop = (self.raw("lineitem").select("l_orderkey", "l_suppkey").repartition(n, "l_orderkey")
                      .groupBy("l_orderkey").agg(F.min("l_suppkey").alias("shop_id")))
        sup = sized_broadcast(self.raw("supplier").select(F.col("s_suppkey").alias("shop_id"),
                                                          F.col("s_name").alias("shop_name")))
        base = (o.join(first_shop, o.o_orderkey == first_shop.l_orderkey, "left")
                .join(sup, "shop_id", "left"))
        status = (F.when(F.col("o_orderstatus") == "F", "COMPLETE")
                  .when(F.col("o_orderstatus") == "O", "PENDING")
                  .when(F.col("o_orderstatus") == "P", "CANCELLED"))
        user = F.when(F.col("o_custkey") % 97 == 0, F.lit(None).cast("string")) \
            .otherwise(F.col("o_custkey").cast("string"))
        # One scan: every order yields its current version, and every tenth
        # order also an older one (flag ``_old``).
        old = F.explode(F.when(F.col("o_orderkey") % 10 == 0, F.array(F.lit(False), F.lit(True)))
                        .otherwise(F.array(F.lit(False))))
        v = base.withColumn("_old", old)
        is_old = F.col("_old")
        return v.select(
            F.col("o_orderkey").alias("order_id"), user.alias("user_id"), "shop_id", "shop_name",
            F.when(is_old, F.col("o_totalprice") / 2).otherwise(F.col("o_totalprice")).alias("total_amount"),
            F.when(is_old & (F.col("o_orderkey") % 20 != 0), F.lit("PENDING")).otherwise(status)
            .alias("order_status"),
            # a time of day, as the source column may have one
            (F.col("o_orderdate") + F.make_interval(hours=F.col("o_orderkey") % 24)).alias("order_date"),
            F.when(is_old, F.col("o_orderdate")).otherwise(F.col("o_orderdate") + F.expr("INTERVAL 1 DAY"))
            .alias("updt_dttm"))

    @stored
    def order_item(self) -> DataFrame:
        return self.raw("lineitem").select(F.col("l_orderkey").alias("order_id"),
                                           F.col("l_partkey").alias("menu_id"))

    # ---- merchant -------------------------------------------------------
    @stored
    def shop(self) -> DataFrame:
        return self.raw("supplier").select(F.col("s_suppkey").alias("shop_id"),
                                           F.col("s_nationkey").alias("address_id"))

    @stored
    def address(self) -> DataFrame:
        return self.raw("nation").select(F.col("n_nationkey").alias("address_id"),
                                         F.col("n_name").alias("address_subdistrict"))

    @stored
    def menu(self) -> DataFrame:
        return self.raw("part").select(F.col("p_partkey").alias("menu_id"),
                                       F.col("p_name").alias("menu_name"))

    # ---- tagging mappers ------------------------------------------------
    @stored
    def category_id_mapper(self) -> DataFrame:
        """category_name -> 1-based id, by name order (a small dimension)."""
        names = self.raw("part").select(_norm(F.col("p_name")).alias("category_name")).distinct()
        return names.select(
            "category_name",
            F.row_number().over(Window.orderBy("category_name")).alias("category_id"))

    @stored
    def dish_type_encoder(self) -> DataFrame:
        m = self.category_id_mapper()
        return m.select((F.col("category_id") - 1).alias("category_id"),
                        F.col("category_name").alias("dish_type_l3"))

    @stored
    def category_name_mapper(self) -> DataFrame:
        """Only ``small_*`` names are renamed, to 'Tiny <Noun>' (mixed case, a space)."""
        m = self.category_id_mapper().where(F.col("category_name").startswith("small_"))
        noun = F.substring_index(F.col("category_name"), "_", -1)
        return m.select(F.col("category_name").alias("dish_type_l3"),
                        F.concat(F.lit("Tiny "), F.initcap(noun)).alias("new_dish_type"))

    @stored
    def dish_tagging(self) -> DataFrame:
        """The already-tagged menus (every part but ``p_partkey % 10 = 9``)."""
        p = self.raw("part").select("p_partkey", "p_name")
        m = self.category_id_mapper()
        j = p.join(m, _norm(p.p_name) == m.category_name).where(F.col("p_partkey") % 10 != 9)
        return j.select(
            F.col("p_partkey").alias("menu_id"),
            F.col("p_name").alias("menu_name"),
            (F.col("category_id") - 1).cast("int").alias("category_id"),
            F.lit(1.0).alias("prob"),
            F.col("category_name").alias("dish_type_l3"),
            F.when(F.col("p_partkey") % 50 == 0, F.lit("")).otherwise(F.col("category_name"))
            .alias("new_dish_type_l3"),
            (F.col("category_id") + F.when(F.col("p_partkey") % 41 == 0, 1000).otherwise(0))
            .cast("int").alias("new_category_id"),
            F.lit(TAGGING_RUN_DATE).alias("run_date"))

    # ---- training and serving ------------------------------------------
    @stored
    def training_data(self) -> DataFrame:
        return self.raw("documents").select(F.col("doc_id").alias("key"),
                                            F.col("text").alias("dish_name"),
                                            F.col("lang").alias("dish_type_l3"))

    @stored
    def vector_data(self) -> DataFrame:
        return self.raw("embeddings").select(F.col("vec_id").alias("key"), "embedding", "label")

    @stored
    def requests(self) -> DataFrame:
        e = self.raw("events").select("event_id", "user_id")
        known = e.select(F.col("user_id").cast("string").alias("user_id"))
        unknown = e.where(F.col("event_id") % 7 == 0).select(
            F.concat(F.lit("unknown-"), F.col("user_id").cast("string")).alias("user_id"))
        return known.unionByName(unknown).distinct()
