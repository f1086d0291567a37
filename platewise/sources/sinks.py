"""Sinks: idempotent partitioned append, snapshots, schema growth, keyed upsert.

Plain parquet directories in a shared file system.  A path a plan reads is
never overwritten by that plan: snapshots and keyed tables write a new
version directory and switch to it only after the write committed.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from platewise.session import work_path


class DuplicateKeyError(ValueError):
    """An upsert batch holds a key twice."""


class ConcurrentWriteError(RuntimeError):
    """Another write committed the same version first."""


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _versions(spark: SparkSession, root: str, committed_only: bool = True) -> list[str]:
    """Version directories ``v=NNNNNNNN`` of ``root``; committed ones have ``_SUCCESS``."""
    fs, p = _fs(spark, root)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if name.startswith("v=") and (not committed_only or fs.exists(st.getPath().suffix("/_SUCCESS"))):
            out.append(name)
    return sorted(out)


def read_json(spark: SparkSession, path: str) -> dict:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def commit_json(spark: SparkSession, folder: str, name: str, made: dict) -> None:
    """Make ``folder/name`` appear at once, whole; raises if another write has made it already."""
    fs, p = _fs(spark, folder)
    fs.mkdirs(p)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    draft, final = path(p, f".{uuid.uuid4().hex}"), path(p, name)
    out = fs.create(draft, False)
    out.write(bytearray(json.dumps(made).encode()))
    out.close()
    if fs.exists(final) or not fs.rename(draft, final):
        fs.delete(draft, False)
        raise ConcurrentWriteError(f"{folder}: {name} was committed by another write")


def write_append(df: DataFrame, path: str, partition_by: Sequence[str] = ("busi_dt",),
                 idempotent: bool = True) -> None:
    """Add a day (or days) to a table partitioned by ``partition_by``.

    ``idempotent`` replaces only the partitions present in ``df`` (dynamic
    partition overwrite), so a rerun of a day does not double it.
    """
    w = df.write.partitionBy(*partition_by)
    if idempotent:
        w.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    else:
        w.mode("append").parquet(path)


def write_bucketed(df: DataFrame, table: str, path: str, keys: Sequence[str], buckets: int,
                   partition_by: Sequence[str] = ()) -> DataFrame:
    """Store ``df`` as an external catalog table bucketed by ``keys``.

    Tables bucketed on the same key with the same bucket count join without a
    shuffle (Spark reads matching buckets together), so storing orders and
    order lines bucketed by ``order_id`` removes the largest shuffle from every
    daily job.  ``partition_by`` adds directory partitions (e.g. the order
    month) for pruning; buckets still line up across partitions.  The rows are dealt
    to their buckets before the write, so a bucket is one task's and one file (per
    partition), not one per task that met it.  Buckets aren't sorted: Spark doesn't rely
    on a bucket's order when it reads, and joins sort anyway.  Returns the table as read back.
    """
    w = df.repartition(buckets, *keys).write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.bucketBy(buckets, *keys).option("path", path).saveAsTable(table)
    return df.sparkSession.table(table)


def read_table_dir(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame:
    """Read a (partitioned) table directory.  ``merge_schema`` reconciles files
    written before and after a schema change, at the cost of reading every
    file footer, so it is off unless asked for."""
    return spark.read.option("mergeSchema", str(merge_schema).lower()).parquet(path)


def write_snapshot(df: DataFrame, root: str) -> str:
    """Write a full snapshot as the next version of ``root``; returns its path."""
    spark = df.sparkSession
    vs = _versions(spark, root, committed_only=False)  # a failed write's number is not reused
    nxt = f"{root.rstrip('/')}/v={int(vs[-1][2:]) + 1 if vs else 1:08d}"
    df.write.mode("errorifexists").parquet(nxt)
    return nxt


def drop_versions(spark: SparkSession, root: str, keep: int = 2) -> None:
    """Remove all but the newest ``keep`` committed versions of a table (a reader may hold the one before)."""
    fs, _ = _fs(spark, root)
    for name in _versions(spark, root)[:-keep]:
        fs.delete(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{name}"), True)


def read_snapshot(spark: SparkSession, root: str) -> DataFrame | None:
    vs = _versions(spark, root)
    return spark.read.parquet(f"{root.rstrip('/')}/{vs[-1]}") if vs else None


def read_snapshot_before(spark: SparkSession, root: str, col: str, value) -> DataFrame | None:
    """The newest version whose ``col`` (one value per version) is below ``value``."""
    for name in reversed(_versions(spark, root)):
        df = spark.read.parquet(f"{root.rstrip('/')}/{name}")
        first = df.select(col).first()
        if first is not None and first[0] < value:
            return df
    return None


def exists(spark: SparkSession, path: str) -> bool:
    """Is there a table directory with at least one entry?"""
    fs, p = _fs(spark, path)
    return fs.exists(p) and len(fs.listStatus(p)) > 0


def union_evolve(old: DataFrame, new: DataFrame) -> DataFrame:
    """Stack by name; a column present on one side only is NULL on the other."""
    return old.unionByName(new, allowMissingColumns=True)


def check_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise if a key occurs twice (a separate job; see :func:`fail_on_duplicates`)."""
    dup = df.groupBy(*keys).count().where(F.col("count") > 1).limit(1)
    if not dup.isEmpty():
        raise DuplicateKeyError(f"duplicate key in upsert batch: {dup.first()}")


def fail_on_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same rows, failing the job that writes them if a key occurs twice.

    Checked inside the job that stores the batch (a count over the key), so the
    batch is computed once, not once for a check and again for the write.
    """
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    msg = F.concat(F.lit("duplicate key in upsert batch: "),
                   F.to_json(F.struct(*[F.col(k) for k in keys])))
    return (df.withColumn("_dup_n", n)
            .where(F.when(F.col("_dup_n") > 1, F.raise_error(msg).cast("boolean")).otherwise(F.lit(True)))
            .drop("_dup_n"))


def merge_by_key(current: DataFrame | None, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Matched rows replaced, new rows inserted, the rest kept (one anti join)."""
    if current is None:
        return updates
    return union_evolve(current.join(updates.select(*keys), list(keys), "left_anti"), updates)


class KeyedTable:
    """A table with a primary key, kept as versioned parquet snapshots."""

    def __init__(self, root: str, keys: Sequence[str]):
        self.root = root.rstrip("/")
        self.keys = list(keys)

    def read(self, spark: SparkSession | None = None) -> DataFrame | None:
        spark = spark or SparkSession.getActiveSession()
        return read_snapshot(spark, self.root)

    def upsert(self, updates: DataFrame) -> str:
        """Create the table if absent, else merge ``updates`` on the key.

        Rows with a NULL key are dropped (they cannot be addressed); a key
        twice in ``updates`` is an error.
        """
        spark = updates.sparkSession
        cond = None
        for k in self.keys:
            c = F.col(k).isNotNull()
            cond = c if cond is None else cond & c
        # the batch is stored once: the merge reads its keys and its rows
        batch = f"{work_path(spark, 'batch')}"
        fail_on_duplicates(updates.where(cond), self.keys).write.parquet(batch)
        updates = spark.read.schema(updates.schema).parquet(batch)
        path = write_snapshot(merge_by_key(read_snapshot(spark, self.root), updates, self.keys), self.root)
        fs, p = _fs(spark, batch)
        fs.delete(p, True)
        drop_versions(spark, self.root)
        return path
