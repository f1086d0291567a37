"""Deciles and exact shares by counting: ranks from histograms, without sorting or moving the rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from platewise.operators.relational import decile, sized_broadcast
from platewise.session import durable

STEP = 4  # characters of a tie's text that one histogram tells apart
DIGEST = 32  # hexadecimal digits of an MD5 digest


def decile_by_counting(df: DataFrame, group: str, value: str, tie: str, rest: Sequence[Column] = (), out: str = "decile",
                       buckets: int = 10) -> DataFrame:
    """Decile of each row's place in its ``group`` by ``value``, then ``tie`` (text, NULL first), then ``rest``.

    A histogram over (group, value) gives the first and the last place of the rows with
    one value.  Where both lie in one decile, all of them have it, whatever their order.
    Only values that span a border of deciles, at most ``buckets - 1`` in a group, go on:
    a further histogram over the next ``STEP`` characters of ``tie`` cuts their rows into
    smaller sets, of which again only those that span a border go on, and so on until
    the text is used up and the rows of one ``tie`` are numbered.  The rows stay where
    they are and meet the histograms by a size-checked broadcast; what is shuffled are
    partial counts.  A group's histogram has a row per distinct value, or per distinct
    run of ``STEP`` characters behind one beginning, so no task holds a group's rows.
    """
    rows, done = durable(df), []
    names, kind = df.columns, "long"
    size = rows.groupBy(group).agg(F.count(F.lit(1)).alias("_size"))
    left = _meet(rows.withColumn("_base", F.lit(0).cast(kind)), size, [group])
    left, used = _cut(left, group, F.col(value)), 0
    while True:
        first, last = decile(F.col("_base") + 1, "_size", buckets), decile(F.col("_base") + F.col("_n"), "_size", buckets)
        done.append(left.where(first == last).select(*names, first.alias(out)))
        left = durable(left.where(first != last))
        longest = left.agg(F.max(F.length(tie))).first()[0]
        if longest is None or longest <= used:
            break
        left = _cut(left.drop("_n"), group, F.substring(F.col(tie), used + 1, STEP))
        used += STEP
    # what is left of a set has one text, or none
    place = F.row_number().over(Window.partitionBy(group, "_base", tie).orderBy(*(rest or [F.lit(0)])))
    done.append(left.select(*names, decile(F.col("_base") + place, "_size", buckets).alias(out)))
    result = done[0]
    for more in done[1:]:
        result = result.unionByName(more)
    return result


def _meet(rows: DataFrame, counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    counts = sized_broadcast(counts.select(*[F.col(k).alias(f"_met{i}") for i, k in enumerate(keys)], *[c for c in counts.columns if c not in keys]))
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_met{i}"))
    return rows.join(counts, same).drop(*[f"_met{i}" for i in range(len(keys))])


def _cut(rows: DataFrame, group: str, by: Column) -> DataFrame:
    """Cut each set of rows, named by (group, places before it), by the value of ``by``: the rows'
    new sets and their sizes ``_n``."""
    rows = rows.withColumn("_by", by)
    counts = rows.groupBy(group, "_base", "_by").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(group, "_base").orderBy(F.col("_by").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    met = _meet(rows, counts, [group, "_base", "_by"])
    return met.withColumn("_base", F.col("_base") + F.col("_before")).drop("_by", "_before")


def cut_by_counting(df: DataFrame, by: Sequence[Column], ends: Callable[[int], Sequence[int]], out: str = "part") -> DataFrame:
    """Number of each row's part when the rows, in the order of their MD5 digests, are cut behind
    the first ``ends(n)[0]``, ``ends(n)[1]``, ... of all ``n`` rows.  Sizes are exact.

    The first digest is that of ``by[0]``; rows that have one digest are told apart by the
    next one, and rows that agree in all of them are taken by position (they should be equal
    rows, so give a last digest of everything that matters).  Nothing is sorted: a histogram
    over the first ``STEP`` digits gives ``n`` and the bin that holds a border, the next
    histogram covers only that bin's rows, and so on until a border lies between two bins.
    A histogram has at most 16 ** ``STEP`` rows, the driver gets one of them per step, and every
    row finds its part by comparing its digest with the borders, where it lies.
    An empty table gives no rows; a NULL in ``by`` counts as the empty text.
    """
    keys = [F.md5(F.coalesce(c.cast("string"), F.lit(""))) for c in by]
    first = durable(_histogram(df, keys[0], 0))
    n = first.agg(F.sum("_n")).first()[0] or 0
    part, ties = F.lit(0), {}
    for end in ends(n):
        if end < n:
            below, tie = _border(df, keys, end, first) if end > 0 else (F.lit(False), None)
            part = part + F.when(below, 0).otherwise(1)
            if tie:
                ties.setdefault(tie[0], []).append(tie[1])
    rest = F.lit(True)
    found = []
    for digests, taken in ties.items():
        equal = _all_equal(keys, digests)
        rest = rest & ~equal
        numbered = _number_by_position(df.where(equal), "_place")
        # every border inside these rows has counted them as above it
        inside = sum((F.when(F.col("_place") <= t, 1).otherwise(0) for t in taken), F.lit(0))
        found.append(numbered.withColumn(out, (part - inside).cast("int")).drop("_place"))
    result = df.where(rest).withColumn(out, part.cast("int"))
    for more in found:
        result = result.unionByName(more)
    return result


def _histogram(rows: DataFrame, key: Column, used: int) -> DataFrame:
    return rows.groupBy(F.substring(key, used + 1, STEP).alias("_step")).agg(F.count(F.lit(1)).alias("_n"))


def _border(rows: DataFrame, keys: Sequence[Column], end: int, counts: DataFrame) -> tuple[Column, tuple | None]:
    """Which rows are surely among the first ``end``; and, where the border runs through rows
    that agree in all digests, those digests with how many of their rows belong below."""
    below, same, digests = F.lit(False), F.lit(True), []
    for key in keys:
        fixed = ""
        while len(fixed) < DIGEST:
            if fixed or digests:
                counts = _histogram(rows, key, len(fixed))
            reach = counts.withColumn("_upto", F.sum("_n").over(Window.orderBy("_step")))
            bin = reach.where(F.col("_upto") >= end).orderBy("_upto").first()
            rows = rows.where(F.substring(key, len(fixed) + 1, STEP) == bin["_step"])
            fixed += bin["_step"]
            if bin["_upto"] == end:
                return below | (same & (F.substring(key, 1, len(fixed)) <= fixed)), None
            end -= bin["_upto"] - bin["_n"]
            rows = durable(rows)
        digests.append(fixed)
        below, same = below | (same & (key < fixed)), same & (key == fixed)
    return below, (tuple(digests), end)


def _all_equal(keys: Sequence[Column], digests: Sequence[str]) -> Column:
    same = F.lit(True)
    for key, digest in zip(keys, digests):
        same = same & (key == digest)
    return same


def _number_by_position(df: DataFrame, out: str) -> DataFrame:
    """Rows numbered from 1 as they lie; the stored frame keeps partition and place, so a
    rerun of a task sees the same numbers."""
    lying = durable(df.withColumn("_pid", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id()))
    blocks = lying.groupBy("_pid").agg(F.count(F.lit(1)).alias("_rows"), F.min("_at").alias("_first"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(F.col("_pid").alias("_block"), "_first", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    met = lying.join(sized_broadcast(blocks), F.col("_pid") == F.col("_block"))
    return met.withColumn(out, F.col("_at") - F.col("_first") + F.col("_before") + 1).drop("_pid", "_at", "_block", "_first", "_before")
