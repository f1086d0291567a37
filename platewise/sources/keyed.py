"""A keyed table in hash buckets, of which a write replaces only those it touches.

Layout below ``root``:

* ``data/platewise_v=<n>/platewise_bucket=<k>/*.parquet``: what write ``n`` made of
  bucket ``k``, sorted by key, so that row groups have narrow key ranges;
* ``versions/<n>.json``: the committed list of write ``n``, which names for every
  bucket the write that holds it (a number per bucket, nothing per row).

A write reads the touched buckets, combines them with its batch in one shuffle on
the bucket number, writes them under its own number and then commits a list that
names the new directories and, for all other buckets, the old ones.  Readers take
the newest committed list, so a failed write is never seen, and files that a write
doesn't touch stay as they are.  Two writers that start from one version can't both
commit: the second one's rename finds the name taken and raises.

Rows are dealt by a hash of ``bucket_by`` (the key, or leading columns of it whose
rows belong together).  Where those are NULL the whole key is hashed, so a NULL group
of any size spreads over all buckets.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from platewise.session import work_path
from platewise.sources.sinks import ConcurrentWriteError, _fs, commit_json, read_json, union_evolve

BUCKET, VERSION = "platewise_bucket", "platewise_v"
BUCKET_BYTES = 4 << 20  # of a first write's parquet in one bucket, which one task holds unpacked and sorted
MIN_BUCKETS = 8
APART = 4  # tasks per touched bucket: numbers that hash alike share one, so room keeps most of them apart
MOST_KEYS = 1000  # requested keys that are sent to the scan one by one


def _in_all_buckets(df: DataFrame, group: Sequence[str], buckets: int, only: Column | None = None) -> DataFrame:
    """A NULL group lies in all buckets, so its rows (where ``only`` holds) are repeated for each;
    for the others the bucket number stays NULL."""
    none = F.lit(False)
    for c in group:
        none = none | F.col(c).isNull()
    every = F.sequence(F.lit(0), F.lit(buckets - 1))
    return df.withColumn(BUCKET, F.explode(F.when(none if only is None else none & only, every).otherwise(F.array(F.lit(None).cast("int")))))


class PartitionedTable:
    """A table with a key, rewritten bucket by bucket."""

    def __init__(self, root: str, keys: Sequence[str], bucket_by: Sequence[str] | None = None, buckets: int | None = None):
        self.root, self.keys = root.rstrip("/"), list(keys)
        self.bucket_by, self.buckets = list(bucket_by or keys), buckets

    # ---------------------------------------------------------- versions ----

    def _numbers(self, spark: SparkSession, folder: str) -> list[int]:
        fs, p = _fs(spark, f"{self.root}/{folder}")
        if not fs.exists(p):
            return []
        names = [st.getPath().getName() for st in fs.listStatus(p)]
        return sorted(int(n.split("=")[-1].split(".")[0]) for n in names if n.endswith(".json") or n.startswith(f"{VERSION}="))

    def version(self, spark: SparkSession) -> dict | None:
        """The newest committed list."""
        done = [n for n in self._numbers(spark, "versions")]
        return self._list(spark, done[-1]) if done else None

    def _list(self, spark: SparkSession, number: int) -> dict:
        return read_json(spark, f"{self.root}/versions/{number:010d}.json")

    def _commit(self, spark: SparkSession, made: dict) -> None:
        commit_json(spark, f"{self.root}/versions", f"{made['version']:010d}.json", made)

    # ----------------------------------------------------------- reading ----

    def _paths(self, listed: dict, only: Sequence[int] | None = None) -> list[str]:
        wanted = range(len(listed["dirs"])) if only is None else only
        return [f"{self.root}/data/{VERSION}={listed['dirs'][b]}/{BUCKET}={b}" for b in wanted if listed["dirs"][b] is not None]

    def _rows(self, spark: SparkSession, listed: dict, only: Sequence[int] | None = None) -> DataFrame:
        schema = StructType.fromJson(json.loads(listed["schema"]))
        paths = self._paths(listed, only)
        if not paths:
            return spark.createDataFrame([], schema).withColumn(BUCKET, F.lit(0))
        return spark.read.schema(schema).option("basePath", f"{self.root}/data").parquet(*paths).drop(VERSION)

    def read(self, spark: SparkSession | None = None) -> DataFrame | None:
        spark = spark or SparkSession.getActiveSession()
        listed = self.version(spark)
        return None if listed is None else self._rows(spark, listed).drop(BUCKET)

    def lookup(self, requests: DataFrame) -> DataFrame | None:
        """Rows of the requested keys (``requests`` has the key columns), from the buckets they
        hash to alone.  Their key range, and few keys one by one, are pushed to the scan, which
        skips row groups by it.  Only bucket numbers, the range and ``MOST_KEYS`` keys at most
        come to the driver."""
        spark = requests.sparkSession
        listed = self.version(spark)
        if listed is None:
            return None
        wanted = requests.select(*self.keys).dropna().distinct()
        placed = wanted.withColumn(BUCKET, self._bucket(listed["buckets"]))
        first = self.keys[0]
        seen = placed.agg(F.collect_set(BUCKET).alias("buckets"), F.min(first).alias("lo"), F.max(first).alias("hi"), F.count(F.lit(1)).alias("n")).first()
        rows = self._rows(spark, listed, sorted(seen.buckets))
        if seen.n <= MOST_KEYS:
            few = sorted({r[0] for r in wanted.select(first).collect()})
            rows = rows.where(F.col(first).isin(few))
        else:
            rows = rows.where(F.col(first).between(F.lit(seen.lo), F.lit(seen.hi)))
        same = [F.col(k) == F.col(f"_want_{k}") for k in self.keys]
        wanted = wanted.select(*[F.col(k).alias(f"_want_{k}") for k in self.keys])
        return rows.drop(BUCKET).join(wanted, same, "left_semi")

    def groups(self, wanted: DataFrame) -> DataFrame:
        """Rows of the ``wanted`` groups (``bucket_by`` columns; NULL is a group too), from their
        buckets alone."""
        spark = wanted.sparkSession
        listed = self.version(spark)
        wanted = wanted.select(*self.bucket_by).distinct()
        marks = _in_all_buckets(wanted, self.bucket_by, listed["buckets"])
        marks = marks.withColumn(BUCKET, F.coalesce(F.col(BUCKET), self._group_bucket(listed["buckets"])))
        rows = self._rows(spark, listed, sorted(r[0] for r in marks.select(BUCKET).distinct().collect())).drop(BUCKET)
        same = [F.col(c).eqNullSafe(F.col(f"_want_{c}")) for c in self.bucket_by]
        return rows.join(wanted.select(*[F.col(c).alias(f"_want_{c}") for c in self.bucket_by]), same, "left_semi")

    def note(self, spark: SparkSession) -> dict:
        """What the last write said about itself."""
        listed = self.version(spark)
        return (listed or {}).get("note") or {}

    # ----------------------------------------------------------- writing ----

    def _group_bucket(self, buckets: int) -> Column:
        return F.pmod(F.xxhash64(*self.bucket_by), F.lit(buckets)).cast("int")

    def _bucket(self, buckets: int) -> Column:
        own = F.xxhash64(*self.bucket_by)
        known = F.lit(True)
        for c in self.bucket_by:
            known = known & F.col(c).isNotNull()
        return F.pmod(F.when(known, own).otherwise(F.xxhash64(*self.keys)), F.lit(buckets)).cast("int")

    def _store(self, batch: DataFrame) -> tuple[DataFrame, str]:
        """The batch, written once below the shared folder: it is read for its buckets and its rows."""
        path = work_path(batch.sparkSession, "batch")
        batch.write.parquet(path)
        return batch.sparkSession.read.schema(batch.schema).parquet(path), path

    def _start(self, spark: SparkSession, path: str) -> dict:
        """What a first write begins with: the number of buckets follows its size."""
        fs, p = _fs(spark, path)
        n = self.buckets or max(MIN_BUCKETS, -(-fs.getContentSummary(p).getLength() // BUCKET_BYTES))
        return {"version": 0, "buckets": n, "dirs": [None] * n, "schema": None}

    def _rewrite(self, batch: DataFrame, combine: Callable[[DataFrame], DataFrame], keep: int,
                 spread: Callable[[DataFrame, int], DataFrame] | None = None, note: dict | None = None) -> int:
        """Combine ``batch`` (rows with ``_new``) with the buckets it touches; returns the version.
        ``note`` is committed with it, also where the batch is empty."""
        spark = batch.sparkSession
        batch, path = self._store(batch)
        listed = self.version(spark) or self._start(spark, path)
        batch = spread(batch, listed["buckets"]) if spread else batch
        batch = batch.withColumn(BUCKET, F.coalesce(F.col(BUCKET), self._bucket(listed["buckets"])) if BUCKET in batch.columns
                                 else self._bucket(listed["buckets"]))
        touched = sorted(r[0] for r in batch.select(BUCKET).distinct().collect())  # a number per bucket
        if not touched and note is not None:
            number = max([0, *self._numbers(spark, "data"), *self._numbers(spark, "versions")]) + 1
            schema = listed["schema"] or batch.drop(BUCKET, "_new").schema.json()
            self._commit(spark, {**listed, "version": number, "schema": schema, "note": note})
        if touched:
            old = None if listed["schema"] is None else self._rows(spark, listed, touched).withColumn("_new", F.lit(0))
            both = batch if old is None else union_evolve(old, batch)
            out = combine(both.repartition(APART * len(touched), BUCKET)).drop("_new")
            number = max([0, *self._numbers(spark, "data"), *self._numbers(spark, "versions")]) + 1
            self._write(spark, listed, out, touched, number, note)
        fs, p = _fs(spark, path)
        fs.delete(p, True)
        self.drop_versions(spark, keep)
        done = self.version(spark)
        return done["version"] if done else 0

    def _write(self, spark: SparkSession, listed: dict, out: DataFrame, touched: list[int], number: int,
               note: dict | None) -> None:
        home = f"{self.root}/data/{VERSION}={number}"
        out.sortWithinPartitions(BUCKET, *self.keys).write.mode("errorifexists").partitionBy(BUCKET).parquet(home)
        fs, p = _fs(spark, home)
        made = {int(n.split("=")[1]) for n in (st.getPath().getName() for st in fs.listStatus(p)) if n.startswith(f"{BUCKET}=")}
        dirs = list(listed["dirs"])
        for b in touched:
            dirs[b] = number if b in made else None
        schema = out.drop(BUCKET).schema
        self._commit(spark, {"version": number, "buckets": listed["buckets"], "dirs": dirs, "schema": schema.json(),
                             "note": note})

    def upsert(self, updates: DataFrame, keep: int = 2) -> int:
        """Rows of ``updates`` replace those with their key, or are added.  Rows with a NULL key
        are left out (they can't be addressed); a key twice in the batch fails the write."""
        known = F.lit(True)
        for k in self.keys:
            known = known & F.col(k).isNotNull()
        msg = F.concat(F.lit("duplicate key in upsert batch: "), F.to_json(F.struct(*self.keys)))

        def newest(both: DataFrame) -> DataFrame:
            same = Window.partitionBy(BUCKET, *self.keys)
            both = both.withColumn("_rows", F.sum("_new").over(same)).withColumn("_first", F.row_number().over(same.orderBy(F.col("_new").desc())))
            once = F.when(F.col("_rows") > 1, F.raise_error(msg).cast("boolean")).otherwise(F.col("_first") == 1)
            return both.where(once).drop("_rows", "_first")

        return self._rewrite(updates.where(known).withColumn("_new", F.lit(1)), newest, keep)

    def add(self, deltas: DataFrame, sums: Sequence[str], alive: str, keep: int = 2, note: dict | None = None) -> int:
        """Add the ``sums`` columns of ``deltas`` (which may be negative, and hold a key several
        times) to the rows with their key; rows whose ``alive`` column comes to 0 go."""

        def total(both: DataFrame) -> DataFrame:
            kinds = {f.name: f.dataType for f in both.schema}
            return both.groupBy(BUCKET, *self.keys).agg(*[F.sum(c).cast(kinds[c]).alias(c) for c in sums]).where(F.col(alive) != 0)

        return self._rewrite(deltas.select(*self.keys, *sums).withColumn("_new", F.lit(1)), total, keep, note=note)

    def replace_groups(self, rows: DataFrame, groups: DataFrame, keep: int = 2, note: dict | None = None) -> int:
        """All rows of ``groups`` (``bucket_by`` columns, NULL is a group too) go and ``rows`` come."""
        marks = groups.select(*self.bucket_by).distinct().withColumn("_new", F.lit(2))

        def spread(batch: DataFrame, buckets: int) -> DataFrame:
            return _in_all_buckets(batch, self.bucket_by, buckets, F.col("_new") == 2)

        def swap(both: DataFrame) -> DataFrame:
            gone = F.max((F.col("_new") == 2).cast("int")).over(Window.partitionBy(BUCKET, *self.bucket_by))
            return both.withColumn("_gone", gone).where((F.col("_new") == 1) | ((F.col("_new") == 0) & (F.col("_gone") == 0))).drop("_gone")

        batch = rows.withColumn("_new", F.lit(1)).unionByName(marks, allowMissingColumns=True)
        return self._rewrite(batch, swap, keep, spread, note)

    def drop_versions(self, spark: SparkSession, keep: int = 2) -> None:
        """Remove all but the newest ``keep`` lists, then the directories that none of those names."""
        numbers = self._numbers(spark, "versions")
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        fs, _ = _fs(spark, self.root)
        for n in numbers[:-keep]:
            fs.delete(path(f"{self.root}/versions/{n:010d}.json"), False)
        held = {(n, b) for v in numbers[-keep:] for b, n in enumerate(self._list(spark, v)["dirs"])}
        newest = numbers[-1] if numbers else 0
        for n in self._numbers(spark, "data"):
            if n >= newest:  # the newest one, and writes that are still under way
                continue
            home = path(f"{self.root}/data/{VERSION}={n}")
            left = 0
            for st in fs.listStatus(home):
                name = st.getPath().getName()
                if name.startswith(f"{BUCKET}=") and (n, int(name.split("=")[1])) in held:
                    left += 1
                elif name.startswith(f"{BUCKET}="):
                    fs.delete(st.getPath(), True)
            if not left:
                fs.delete(home, True)
