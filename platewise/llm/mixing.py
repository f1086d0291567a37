"""Mixing sources to target weights: repetition rates per source, emitted per document.

The words of each source are added up (combined before the shuffle).  Sources share
the words of all documents by weight; a source's target stops at ``max_repeat``
times its own words, and what it leaves is shared again by weight among the others
until none is above its stop.  In each step that sharing needs two numbers, what is
left to share and the weights left, so the driver sees those two only.  A source's
rate is target / words, at most ``max_repeat``.  Each of its documents is emitted
floor(rate) times, plus once more if its own hash-seeded draw in [0, 1) falls below
the fraction.  A draw is made from seed, id and text alone, so reruns, retries and
other partitionings agree, no source is ever gathered, and no document exceeds
``max_repeat`` times its size.  A source's taken words scatter around its target
with variance sum(size**2) * f * (1 - f), f its fraction.

Defined cases: a NULL or blank text has size 0; a NULL source is a source of its own
behind all others; a source without words has target 0 and its documents are
emitted at rate 0; equal rows draw alike, rows that share an id but not the text draw
apart, and so do rows without an id; an empty table gives no rows; only the named
columns are read, and :func:`emit` keeps all columns, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platewise.llm.common import running_total, stored

BROADCAST_SOURCES, BROADCAST_BYTES = 1 << 16, 16 << 20
DRAWS = 1 << 52  # a draw is a multiple of 1 / DRAWS


def draw(seed: int, id_col: str, text_col: str) -> Column:
    """Number in [0, 1) from an MD5 over seed, id and the text's MD5 (13 hexadecimal digits)."""
    text = F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary"))
    key = F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(id_col).cast("string"), F.lit("")), text)
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 13), 16, 10).cast("long") / F.lit(DRAWS)


def source_targets(sizes: DataFrame, weights: Sequence[int], max_repeat: int) -> DataFrame:
    """(source, source_size, target) from rows (source, size)."""
    own = stored(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    # sources in code point order, NULL last; numbered over range partitions
    placed = running_total(own.withColumn("_none", F.col("source").isNull()), [], ["_none", "source"], F.lit(1), "_place")
    weight = F.get(F.array(*[F.lit(int(w)) for w in weights]), F.pmod("_place", F.lit(len(weights))).cast("int")).cast("long")
    own = stored(placed.select("source", "source_size", weight.alias("weight")), "weights")
    stop = F.col("source_size") * max_repeat
    wide = "decimal(38,0)"
    total = own.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    all_weights = own.agg(F.coalesce(F.sum("weight"), F.lit(0))).first()[0]
    left, weight_left = total, all_weights
    while True:  # what stops at this share stops at every later one, since that is larger
        stopped = stop.cast(wide) * F.lit(weight_left).cast(wide) <= F.col("weight").cast(wide) * F.lit(left).cast(wide)
        gone = own.where(stopped).agg(F.coalesce(F.sum(stop), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))).first()
        if (total - gone[0], all_weights - gone[1]) == (left, weight_left):
            break
        left, weight_left = total - gone[0], all_weights - gone[1]
    share = F.col("weight") * F.lit(left).cast("long") / F.lit(max(1, weight_left)).cast("long")
    return own.select("source", "source_size", F.when(stopped, stop.cast("double")).otherwise(share).alias("target"))


def mix(df: DataFrame, weights: Sequence[int] = (5, 2, 1), max_repeat: int = 3, seed: int = 1, id_col: str = "doc_id",
        text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(id, size, source_size, target, copies) of every row."""
    rows = df.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"),
                     F.coalesce(F.regexp_count(F.col(text_col), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long").alias("size"),
                     draw(seed, id_col, text_col).alias("draw"))
    rows = stored(rows, "sized")
    own = _targets_to_join(stored(source_targets(rows, weights, max_repeat), "targets"))
    out = rows.join(own, F.col("source").eqNullSafe(F.col("_source")))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    copies = F.floor(rate) + (F.col("draw") < rate - F.floor(rate)).cast("long")
    return out.select(F.col("id").alias(id_col), "size", "source_size", "target", copies.cast("long").alias("copies"))


def _targets_to_join(targets: DataFrame) -> DataFrame:
    """One row per source, broadcast where rows and bytes are proven small; beyond that
    Spark joins by a shuffle and splits the hot sources at run time."""
    targets = targets.withColumnRenamed("source", "_source")
    first = targets.limit(BROADCAST_SOURCES + 1)
    n, size = first.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("_source")), F.lit(0))).first()
    return F.broadcast(targets) if n <= BROADCAST_SOURCES and size <= BROADCAST_BYTES else targets


def emit(df: DataFrame, weights: Sequence[int] = (5, 2, 1), max_repeat: int = 3, seed: int = 1, id_col: str = "doc_id",
         text_col: str = "text", source_col: str = "source", out: str = "copy") -> DataFrame:
    """The mix itself: every document as often as it is taken, with the copy's number (from 0)
    in ``out``.  Texts stay where they are: only the sources' rates are sent to them."""
    sizes = df.select(F.col(source_col).cast("string").alias("source"),
                      F.coalesce(F.regexp_count(F.col(text_col), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long").alias("size"))
    own = _targets_to_join(stored(source_targets(sizes, weights, max_repeat), "targets"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    own = own.select("_source", rate.alias("_rate"))
    names = [c for c in df.columns if c != out]
    packed = df.select(F.struct(*names).alias("_row"), F.col(source_col).cast("string").alias("_own"), draw(seed, id_col, text_col).alias("_draw"))
    met = packed.join(own, F.col("_own").eqNullSafe(F.col("_source")))
    copies = (F.floor("_rate") + (F.col("_draw") < F.col("_rate") - F.floor("_rate")).cast("long")).cast("int")
    each = F.explode(F.when(copies > 0, F.sequence(F.lit(0), copies - 1)).otherwise(F.array().cast("array<int>")))
    return met.select("_row", each.alias("_copy")).select(*[F.col("_row")[c].alias(c) for c in names], F.col("_copy").alias(out))


def oracle(weights: Sequence[int] = (5, 2, 1), max_repeat: int = 3, seed: int = 1) -> str:
    """The query's rows in DuckDB SQL over ``documents``.  Sources in the order of the share at
    which they stop: those that stop are the first ones, so one pass settles the sharing."""
    weight = " ".join(f"WHEN {i} THEN {w}" for i, w in enumerate(weights))
    return rf"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5('{seed}:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))), 1, 13))::BIGINT / {DRAWS}::DOUBLE AS draw
  FROM documents),
s AS (
  SELECT source, source_size, {max_repeat} * source_size AS stop,
         CASE (row_number() OVER (ORDER BY source IS NULL, source) - 1) % {len(weights)} {weight} END AS weight
  FROM (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source)),
r AS (
  SELECT *, coalesce(sum(stop) OVER before, 0)::BIGINT AS stops, coalesce(sum(weight) OVER before, 0)::BIGINT AS weights,
         sum(source_size) OVER ()::BIGINT AS total, sum(weight) OVER ()::BIGINT AS all_weights
  FROM s WINDOW before AS (ORDER BY stop::DOUBLE / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT *, stop::HUGEINT * (all_weights - weights) <= weight::HUGEINT * (total - stops) AS stopped FROM r),
t AS (
  SELECT source, source_size, CASE WHEN stopped THEN stop::DOUBLE ELSE (weight * (
           total - coalesce((SELECT sum(stop) FROM f WHERE stopped), 0)))::DOUBLE / greatest(1, all_weights - coalesce(
           (SELECT sum(weight) FROM f WHERE stopped), 0))::DOUBLE END AS target
  FROM f)
SELECT doc_id, size, source_size, target,
       CASE WHEN source_size > 0 THEN size * (floor(target / source_size)::BIGINT + (draw < target / source_size - floor(target / source_size))::BIGINT)
            ELSE 0 END AS taken
FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source"""
