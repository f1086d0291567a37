"""Relational building blocks, each a plain ``DataFrame -> DataFrame`` function.

All are declarative DataFrame plans; Catalyst pushes filters and prunes
columns, AQE picks join strategies at run time.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnLike = Column | str

# A side is broadcast on a size check: at most so many rows and so many bytes of
# values.  Dimension tables (shops, menus, mappers) above this go through a
# shuffle join instead.
BROADCAST_MAX_ROWS = 1_000_000
BROADCAST_MAX_BYTES = 256 << 20


def _col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _value_bytes(df: DataFrame) -> Column:
    """Bytes of a row's values: the length of texts, the JSON length of nested values, else eight."""
    total = F.lit(0)
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.StringType | T.BinaryType):
            total = total + F.coalesce(F.octet_length(c), F.lit(0))
        elif isinstance(f.dataType, T.ArrayType | T.MapType | T.StructType):
            total = total + F.octet_length(F.to_json(F.struct(c.alias("v"))))
        else:
            total = total + 8
    return total.cast("long")


def sized_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Mark ``df`` for broadcast only if it has at most ``max_rows`` rows and
    ``max_bytes`` of values.

    The check reads at most ``max_rows + 1`` rows.  Above a bound the frame is
    returned unmarked, so the join shuffles (sort-merge, with AQE skew
    splitting) instead of shipping an unbounded table to every executor.
    """
    n, size = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.sum(_value_bytes(df))).first()
    return F.broadcast(df) if n <= max_rows and (size or 0) <= max_bytes else df


# ---------------------------------------------------------------- filters --

def tagged_only(df: DataFrame, col: str = "dish_type_l3", drop_empty: bool = False) -> DataFrame:
    cond = F.col(col).isNotNull()
    if drop_empty:
        cond = cond & (F.col(col) != "")
    return df.where(cond)


def exclude_values(df: DataFrame, col: str, values: Iterable[str]) -> DataFrame:
    """``col NOT IN (values)``; a NULL in ``col`` drops out, as in SQL."""
    return df.where(~F.col(col).isin(list(values)))


def in_retro(date_col: ColumnLike, run_date, days: int | Column) -> Column:
    """``run - days <= date <= run``, both ends inclusive (days + 1 calendar days)."""
    run = F.lit(run_date).cast("date") if not isinstance(run_date, Column) else run_date
    d = _col(date_col).cast("date")
    n = days if isinstance(days, Column) else F.lit(days)
    return (d >= F.date_sub(run, n)) & (d <= run)


def latest(df: DataFrame, col: str) -> DataFrame:
    """Rows holding the largest value of ``col`` (scalar subquery, run once)."""
    top = df.select(F.max(col)).scalar()
    return df.where(F.col(col) == top)


def blank_to_null(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """``''`` -> NULL in the given string columns (all string columns by default)."""
    if cols is None:
        cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.nullif(F.col(c), F.lit("")) for c in cols})


def stamp(df: DataFrame, busi_dt=None, **literals) -> DataFrame:
    """Add literal columns (run_date, num_retro_days, busi_dt, ...)."""
    cols = {k: F.lit(v) for k, v in literals.items()}
    if busi_dt is not None:
        cols["busi_dt"] = F.lit(busi_dt).cast("date")
    return df.withColumns(cols)


def conform(df: DataFrame, schema: T.StructType, safe: bool = False) -> DataFrame:
    """Select and cast to ``schema``; ANSI casts fail on bad values unless ``safe``."""
    def cast(f):
        c = F.col(f.name)
        return (c.try_cast(f.dataType) if safe else c.cast(f.dataType)).alias(f.name)
    return df.select(*[cast(f) for f in schema.fields])


def decode_label(df: DataFrame, encoder: DataFrame, id_col: str = "category_id",
                 out: str = "dish_type_l3", strict: bool = True, other: bool = True) -> DataFrame:
    """Class id -> name by the encoder table; class 0 is always ``'other'`` (unless ``other=False``).

    An id that the encoder lacks fails the job when ``strict`` (the original job
    raises on a missing dict key), otherwise gives NULL.
    """
    enc = sized_broadcast(encoder.select(F.col("category_id").alias("_enc_id"),
                                         F.col("dish_type_l3").alias("_enc_name")))
    j = df.join(enc, F.col(id_col) == F.col("_enc_id"), "left")
    name = F.col("_enc_name")
    if other:
        name = F.when(F.col(id_col) == 0, F.lit("other")).otherwise(name)
    if strict:
        name = F.when(F.col(id_col).isNotNull() & ((F.col(id_col) != 0) | F.lit(not other)) & F.col("_enc_name").isNull(),
                      F.raise_error(F.concat(F.lit("unknown class id "), F.col(id_col).cast("string"))
                                    ).cast("string")).otherwise(name)
    return j.withColumn(out, name).drop("_enc_id", "_enc_name")


# ------------------------------------------------------------- windows ------

def latest_version(df: DataFrame, key: str | Sequence[str], ts: str,
                   tie: Sequence[ColumnLike] = ()) -> DataFrame:
    """Newest row per key by ``ts`` (row_number = 1; Spark adds a partial
    WindowGroupLimit before the shuffle, so only one row per key and task moves)."""
    keys = [key] if isinstance(key, str) else list(key)
    w = Window.partitionBy(*keys).orderBy(F.col(ts).desc(), *[_col(t) for t in tie])
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def top_k(df: DataFrame, partition: Sequence[str], order: Sequence[Column], k: int,
          rank_col: str | None = None) -> DataFrame:
    """First ``k`` rows of each partition in ``order`` (row_number <= k)."""
    w = Window.partitionBy(*partition).orderBy(*order)
    name = rank_col or "_rn"
    out = df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= k)
    return out if rank_col else out.drop(name)


def number_rows(df: DataFrame, partition: Sequence[str], order: Sequence[Column], out: str) -> DataFrame:
    """``row_number()`` inside each partition, ascending in ``order`` (1-based)."""
    return df.withColumn(out, F.row_number().over(Window.partitionBy(*partition).orderBy(*order)))


def group_window(*cols: str):
    """A whole-partition window (for group sizes and maxima on each row)."""
    return Window.partitionBy(*cols)


def decile(rank: ColumnLike, size: ColumnLike, buckets: int = 10) -> Column:
    """``ceil(buckets * rank / size)`` in exact integer arithmetic (never 0 for rank >= 1).

    Not ``ntile``: ntile fills the low buckets first when a group is small.
    """
    r, n = _col(rank).cast("long"), _col(size).cast("long")
    return F.floor((r * buckets + n - 1) / n).cast("int")


def decile_of_distinct(df: DataFrame, group: str, value: str, out: str = "decile",
                       buckets: int = 10) -> DataFrame:
    """Decile of each row's ``value`` among the *distinct* values of its group.

    ``dense_rank`` over the group equals the row number over distinct values, and
    its maximum is the number of distinct values, so no distinct + self-join is
    needed: both windows share one shuffle by ``group``.  A NULL group gets a
    NULL decile, as an equi-join back on the group would give.
    """
    w = Window.partitionBy(group).orderBy(F.col(value).asc())
    ranked = df.withColumn("_dr", F.dense_rank().over(w))
    ranked = ranked.withColumn("_nd", F.max("_dr").over(Window.partitionBy(group)))
    d = F.when(F.col(group).isNotNull(), decile("_dr", "_nd", buckets))
    return ranked.withColumn(out, d).drop("_dr", "_nd")


def rank_in_group(df: DataFrame, group: str, order: Sequence[Column], rank_col: str = "rank",
                  size_col: str = "group_size", num_partitions: int | None = None,
                  subgroup: str | None = None, nth_col: str = "nth", many_col: str = "many") -> DataFrame:
    """Row number of each row inside its ``group`` in ``order``, plus the group size,
    without putting a whole group into one task.

    A plain ``row_number().over(partitionBy(group))`` sends every row of a group to
    one task; a hot group (a third of all rows) would stall.  Here the rows are
    range-partitioned and sorted on ``(group, order...)`` (Spark samples the key
    range, so a hot group spans many partitions), each row gets its position in
    its partition, and a small table of per-(partition, group) counts gives the
    offset of each block.  ``order`` must make rows unique inside a group so the
    positions are reproducible; the sorted frame is checkpointed to the shared
    folder so both uses see one materialisation.

    ``subgroup`` names the column that ``order`` begins with, ascending with NULL
    first.  Rows that agree in it too (they must be few) then stay in one partition,
    and get their number among themselves (``nth_col``) and how many they are
    (``many_col``) in the same sort, without a shuffle of their own.
    """
    from platewise.session import durable

    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    sort_keys = [F.col(group).asc_nulls_first(), *order]
    if subgroup is None:
        s = df.repartitionByRange(n, *sort_keys)
    else:
        same = Window.partitionBy(group, subgroup).orderBy(*order[1:])
        whole = same.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        s = df.repartitionByRange(n, *sort_keys[:2]).withColumns({
            nth_col: F.row_number().over(same).cast("long"), many_col: F.count(F.lit(1)).over(whole)})
    s = (s.sortWithinPartitions(*sort_keys)
         .withColumn("_pid", F.spark_partition_id())
         .withColumn("_pos", F.monotonically_increasing_id()))
    s = durable(s)
    blocks = s.groupBy("_pid", group).agg(F.count(F.lit(1)).alias("_cnt"),
                                          F.min("_pos").alias("_first"))
    wg = Window.partitionBy(group)
    blocks = blocks.select(
        F.col("_pid").alias("_bpid"), F.col(group).alias("_bgroup"), "_first",
        (F.sum("_cnt").over(wg.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)))
        .alias("_before"),
        F.sum("_cnt").over(wg).alias(size_col))
    blocks = sized_broadcast(blocks)
    cond = (F.col("_pid") == F.col("_bpid")) & F.col(group).eqNullSafe(F.col("_bgroup"))
    out = s.join(blocks, cond, "inner")
    pos = F.col("_pos") - F.col("_first") + F.coalesce(F.col("_before"), F.lit(0)) + 1
    return (out.withColumn(rank_col, pos.cast("long"))
            .withColumn(size_col, F.col(size_col).cast("long"))
            .drop("_pid", "_pos", "_bpid", "_bgroup", "_first", "_before"))


# --------------------------------------------------------------- joins ------

def changed_rows(today: DataFrame, prev: DataFrame, keys: Sequence[str],
                 null_safe: bool = False) -> DataFrame:
    """Rows of ``today`` with no identical row (on ``keys``) in ``prev``.

    Equi anti join by default, so a NULL in any key always counts as changed;
    ``null_safe`` compares with ``<=>`` instead.
    """
    if not null_safe:
        return today.join(prev.select(*keys), list(keys), "left_anti")
    p = prev.select(*[F.col(k).alias(f"_p_{k}") for k in keys])
    cond = None
    for k in keys:
        c = F.col(k).eqNullSafe(F.col(f"_p_{k}"))
        cond = c if cond is None else cond & c
    return today.join(p, cond, "left_anti")


def not_in(df: DataFrame, other: DataFrame, col: str, other_col: str | None = None,
           null_aware: bool = True) -> DataFrame:
    """``df.col NOT IN (SELECT other_col FROM other)``.

    ``null_aware`` keeps SQL's three-valued logic: one NULL in ``other`` gives
    no rows, and a NULL in ``df`` qualifies only if ``other`` is empty.  It is
    planned as an ordinary equi anti join plus two uncorrelated EXISTS checks
    (each a LIMIT 1 subquery), so it scales where Spark's own null-aware anti
    join needs a broadcastable side.  ``null_aware=False`` is the plain anti join.
    """
    oc = other_col or col
    keys = other.select(F.col(oc).alias("_ni_key"))
    anti = df.join(keys, F.col(col) == F.col("_ni_key"), "left_anti")
    if not null_aware:
        return anti
    other_has_null = keys.where(F.col("_ni_key").isNull()).exists()
    other_nonempty = keys.exists()
    return anti.where(~other_has_null & (F.col(col).isNotNull() | ~other_nonempty))


def map_or_self(df: DataFrame, col: str, mapper: DataFrame, key: str, value: str,
                out: str | None = None) -> DataFrame:
    """Replace ``col`` by ``mapper[key -> value]`` where mapped, else keep it."""
    m = sized_broadcast(mapper.select(F.col(key).alias("_m_key"), F.col(value).alias("_m_val")))
    j = df.join(m, F.col(col) == F.col("_m_key"), "left")
    return j.withColumn(out or col, F.coalesce(F.col("_m_val"), F.col(col))).drop("_m_key", "_m_val")


def map_strict(df: DataFrame, col: str, mapper: DataFrame, key: str, value: str, out: str,
               on_missing: str = "error") -> DataFrame:
    """Look ``col`` up in ``mapper``; a missing key fails (``error``) or gives NULL.

    A duplicated mapper key multiplies rows, as a left merge does.
    """
    m = sized_broadcast(mapper.select(F.col(key).alias("_m_key"), F.col(value).alias("_m_val")))
    j = df.join(m, F.col(col) == F.col("_m_key"), "left")
    v = F.col("_m_val")
    if on_missing == "error":
        v = F.when(F.col(col).isNotNull() & F.col("_m_key").isNull(),
                   F.raise_error(F.concat(F.lit("no mapping for "), F.col(col).cast("string")))
                   .cast(mapper.schema[value].dataType)).otherwise(v)
    elif on_missing != "null":
        raise ValueError(f"on_missing must be 'error' or 'null', not {on_missing!r}")
    return j.withColumn(out, v).drop("_m_key", "_m_val")


def attach_id(df: DataFrame, mapper: DataFrame, on: str = "new_dish_type_l3",
              name_col: str = "category_name", id_col: str = "category_id",
              out: str = "new_category_id", on_missing: str = "error") -> DataFrame:
    """Left-attach the category id of ``on`` (rename then id, as in tagging)."""
    return map_strict(df, on, mapper, name_col, id_col, out, on_missing)


def union_evolve(old: DataFrame, new: DataFrame) -> DataFrame:
    """Stack by column name; columns missing on one side become NULL."""
    return old.unionByName(new, allowMissingColumns=True)


def retro_dates(run_dates: Iterable[dt.date | str]) -> list[dt.date]:
    out = []
    for d in run_dates:
        out.append(d if isinstance(d, dt.date) else dt.date.fromisoformat(str(d)))
    return sorted(out)
