"""Helpers that several operators share."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from platewise.session import work_path

WORD_BREAK = r"[\x20\x09-\x0D]+"


_STORED: list[str] = []


ARROW_ROWS = 512  # texts are large rows: the default of 10,000 would hold 40 MB or more on both sides


def text_batches(spark: SparkSession) -> None:
    """Send fewer rows at once to Python, unless the cluster was launched with a value of its own."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not spark.sparkContext.getConf().contains(key):
        spark.conf.set(key, str(ARROW_ROWS))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` once below the shared checkpoint folder and read it back."""
    text_batches(df.sparkSession)
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    _STORED.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_so_far() -> int:
    return len(_STORED)


def drop_stored(spark: SparkSession, since: int = 0, keep: int = 0) -> None:
    """Remove the tables that :func:`stored` has written from number ``since`` on, but
    for the last ``keep``; call it when no result that reads them is needed any more."""
    gone = _STORED[since:len(_STORED) - keep]
    hadoop, conf = spark.sparkContext._jvm.org.apache.hadoop.fs, spark.sparkContext._jsc.hadoopConfiguration()
    for path in gone:
        p = hadoop.Path(path)
        p.getFileSystem(conf).delete(p, True)
    _STORED[since:len(_STORED) - keep] = []


def small_batches(batches: Iterator[pa.RecordBatch], target_bytes: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches to rows of about ``target_bytes`` (a row is never cut), so that
    a Python worker's memory doesn't follow the rows per batch of the session.  What they
    have left behind is given back after the last one."""
    for b in batches:
        yield from pieces(b, target_bytes)
        del b
    release_memory()


def pieces(b: pa.RecordBatch, target_bytes: int) -> Iterator[pa.RecordBatch]:
    """Slices of an Arrow batch, of about ``target_bytes`` each (a row is never cut)."""
    rows = max(1, b.num_rows * target_bytes // max(1, b.nbytes))
    for at in range(0, b.num_rows, rows):
        yield b.slice(at, rows)


def release_memory() -> None:
    """Give freed memory back to the system: a Python worker lives on from task to task, and
    Arrow's pool and the C library would keep what its largest batch took."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def words(text: str | Column) -> Column:
    """Words of a text; NULL and blank texts have none."""
    c = F.col(text) if isinstance(text, str) else text
    return F.filter(F.split(F.coalesce(c, F.lit("")), WORD_BREAK), lambda w: w != "")


def lower_ascii(text: str | Column) -> Column:
    """A-Z to a-z, other letters unchanged."""
    c = F.col(text) if isinstance(text, str) else text
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def parts(df: DataFrame) -> int:
    """The session's number of shuffle partitions, which the user sizes with the data."""
    return max(8, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


BROADCAST_IDS, BROADCAST_BYTES = 1 << 20, 32 << 20


def broadcast_ids(ids: DataFrame) -> DataFrame:
    """Hint a broadcast for a small stored frame if it has at most ``BROADCAST_IDS`` rows and its
    text and binary columns at most ``BROADCAST_BYTES``; beyond that Spark joins it by a shuffle."""
    wide = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in ids.schema if f.dataType.typeName() in ("string", "binary")]
    size = F.sum(sum(wide[1:], wide[0]).cast("long")) if wide else F.lit(0)
    n, size = ids.limit(BROADCAST_IDS + 1).agg(F.count(F.lit(1)), size).first()
    return F.broadcast(ids) if n <= BROADCAST_IDS and (size or 0) <= BROADCAST_BYTES else ids


def with_rows(df: DataFrame, ids: DataFrame, id_col: str, keep: bool) -> DataFrame:
    """Rows of ``df`` whose id is in the stored one-column frame ``ids`` (``keep``) or is not."""
    ids = broadcast_ids(ids.select(F.col(ids.columns[0]).alias("_only")))
    return df.join(ids, F.col(id_col) == F.col("_only"), "left_semi" if keep else "left_anti")


def number_in_groups(df: DataFrame, groups: Sequence[str], order: Sequence[str], out: str,
                     slices: int | None = None) -> DataFrame:
    """Gapless positions from 0 inside each group, without a whole group in one task.

    Rows are dealt to ``slices`` slices by a hash of ``order``, numbered inside
    (group, slice), and shifted by the sizes of the slices before.  ``order``
    should identify a row; equal rows may swap numbers, which changes no result.
    ``df`` is read twice: store it if it is dear.
    """
    n = slices or parts(df)
    sliced = df.withColumn("_slice", F.pmod(F.xxhash64(*order), F.lit(n)).cast("int"))
    size = sliced.groupBy(*groups, "_slice").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*groups).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    shift = size.select(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(groups)], F.col("_slice").alias("_s"),
                        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    inside = Window.partitionBy(*groups, "_slice").orderBy(*order)
    numbered = sliced.withColumn("_i", F.row_number().over(inside) - 1)
    same = F.col("_slice") == F.col("_s")
    for i, g in enumerate(groups):
        same &= F.col(g).eqNullSafe(F.col(f"_g{i}"))
    return (numbered.join(shift, same).withColumn(out, (F.col("_i") + F.col("_shift")).cast("long"))
            .select(*[c for c in df.columns if c != out], out))


def running_total(df: DataFrame, groups: Sequence[str], order: Sequence[str], value: Column, out: str) -> DataFrame:
    """Sum of ``value`` over the rows before this one in its group, without a whole group in one task.

    Rows are range-partitioned on group and order (a hot group spans partitions),
    summed inside each partition, and shifted by the partitions before.  The sorted
    rows are stored once, so both uses see one partitioning.
    """
    by = [F.col(c).asc_nulls_first() for c in (*groups, *order)]
    ranged = df.withColumn(out, value.cast("long")).repartitionByRange(parts(df), *by)
    ranged = stored(ranged.withColumn("_pid", F.spark_partition_id()), "ranged")
    before = Window.partitionBy(*groups).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    block = ranged.groupBy("_pid", *groups).agg(F.sum(out).alias("_block"))
    block = block.select(F.col("_pid").alias("_p"), *[F.col(g).alias(f"_g{i}") for i, g in enumerate(groups)],
                         F.coalesce(F.sum("_block").over(before), F.lit(0)).alias("_shift"))
    inside = Window.partitionBy("_pid", *groups).orderBy(*[F.col(c).asc_nulls_first() for c in order]).rowsBetween(
        Window.unboundedPreceding, -1)
    same = F.col("_pid") == F.col("_p")
    for i, g in enumerate(groups):
        same &= F.col(g).eqNullSafe(F.col(f"_g{i}"))
    summed = ranged.withColumn(out, F.coalesce(F.sum(out).over(inside), F.lit(0)))
    return summed.join(block, same).select(*[c for c in df.columns if c != out], (F.col(out) + F.col("_shift")).alias(out))


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of an undirected edge list; root is the smallest
    node reachable.  Nodes without an edge don't appear.

    Alternates two star contractions: every node hands its larger neighbours to
    its smallest one, then its smaller neighbours.  Both are a minimum per node
    (combined before the shuffle) joined back to the edges (a join whose hot keys
    Spark splits), so a hub with any number of edges is never gathered.  Each
    round is stored in the shared folder; O(log n) rounds.
    """
    e = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    e = stored(e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    seen = None
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = stored(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "low")
        large = (both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.where("m < u").select("u", F.col("m").alias("v"))).distinct())
        large = stored(large, "large-star")
        low = stored(large.groupBy("u").agg(F.min("v").alias("m")), "low")
        small = (large.join(low, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        e = stored(small, "small-star")
        mark = e.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if mark == seen:
            break
        seen = mark
    else:
        raise RuntimeError("components did not settle")
    roots = e.select("v").distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        roots.select(F.col("v").alias("node"), F.col("v").alias("root")))
