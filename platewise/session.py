"""Session and shared-folder helpers.

The library never creates its own session inside an operator; these helpers
are for tests, the bench and the driver entry point.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "platewise") -> SparkSession:
    """A session with the settings the jobs are tuned for (AQE on, UTC, no UI)."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    parts = shuffle_partitions or int(os.environ.get("PLATEWISE_SHUFFLE_PARTITIONS", "8"))
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("PLATEWISE_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def tune_for_input(spark: SparkSession, input_bytes: int, partition_bytes: int = 256 << 20,
                   min_partitions: int = 200, max_partitions: int = 50_000) -> dict[str, str]:
    """Size shuffles and scan splits for ``input_bytes`` of input, so a task's
    share fits executor memory without spilling: about ``partition_bytes`` per
    scan split and per shuffle partition (AQE coalesces the small ones and
    splits skewed ones).  The shuffle partition count is capped at
    ``max_partitions``: shuffles carry partially aggregated rows, far less than
    the input, and map x reduce block counts grow with the square.  Settings
    the cluster was launched with are left alone.  Returns what was set.
    """
    wanted = {
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(min(max_partitions,
                                                max(min_partitions, -(-input_bytes // partition_bytes)))),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(partition_bytes),
    }
    launch = spark.sparkContext.getConf()
    done = {}
    for k, v in wanted.items():
        if not launch.contains(k):  # a value the cluster was launched with wins
            spark.conf.set(k, v)
            done[k] = v
    return done


SHUFFLE_BYTES = 16 << 20  # compressed bytes of a shuffle that one task takes: sorted and counted, about 16 times as many


def size_shuffles(spark: SparkSession, partitions: int) -> None:
    """Shuffles of at least ``partitions`` partitions, of which AQE gives one task about ``SHUFFLE_BYTES``.

    A number of partitions that is fixed for small input, or Spark's advisory 64 MB, lets a
    task's memory grow with the input.  So the number is only raised and the size only
    lowered, also where the cluster was launched with other values; AQE coalesces what is small.
    """
    number = "spark.sql.shuffle.partitions"
    if int(spark.conf.get(number)) < partitions:
        spark.conf.set(number, str(partitions))
    in_bytes = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    for name, size in (("advisoryPartitionSizeInBytes", SHUFFLE_BYTES), ("skewJoin.skewedPartitionThresholdInBytes", 4 * SHUFFLE_BYTES)):
        if in_bytes(spark.conf.get(f"spark.sql.adaptive.{name}")) > size:
            spark.conf.set(f"spark.sql.adaptive.{name}", str(size))


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, as the cluster names it.

    ``spark.checkpoint.dir`` is read from the session.  Only a ``local`` master
    without one gets a private folder; a cluster without one is an error, since
    executors would each write to their own disk.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not is_local(sc.master):
            raise ValueError(f"spark.checkpoint.dir is not set: master {sc.master} needs a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="platewise-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir()


def is_local(master: str) -> bool:
    """``local`` and ``local[...]`` run in one process; ``local-cluster`` doesn't."""
    return re.fullmatch(r"local(\[.*\])?", master) is not None


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tables/{name}-{uuid.uuid4().hex}"


def durable(df: DataFrame) -> DataFrame:
    """Cut lineage by a table in the shared folder.

    Used where a plan must be evaluated twice with identical, recomputable
    results (positions assigned after a sort).  The rows are written once and
    read back, so an executor loss loses nothing and nothing is computed twice.
    """
    path = work_path(df.sparkSession, "durable")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
