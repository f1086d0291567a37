"""Table sources: read by name or path, guards, literal rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class EmptySourceError(RuntimeError):
    """A source the job depends on holds no rows."""


def read_table(spark: SparkSession, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Read a catalog table (``db.table``) or a parquet path, pruned to ``columns``.

    Column selection is a plain projection, so Catalyst pushes it into the
    parquet ``ReadSchema``; filters applied later are pushed the same way.
    """
    if "/" in name or name.endswith(".parquet"):
        df = spark.read.parquet(name)
    else:
        df = spark.table(name)
    return df.select(*columns) if columns else df


def has_rows(df: DataFrame) -> bool:
    """True if ``df`` has at least one row; stops at the first row found."""
    return not df.isEmpty()


def guard_nonempty(df: DataFrame, name: str) -> DataFrame:
    """Stop the job when a source is empty (no full count, just one row)."""
    if df.isEmpty():
        raise EmptySourceError(f"source {name!r} has no rows")
    return df


def literal_row(spark: SparkSession, schema: T.StructType, **values) -> DataFrame:
    """A one-row frame from literals, typed by ``schema`` (e.g. the ``default`` list row)."""
    cols = []
    for field in schema.fields:
        v = values.get(field.name)
        cols.append(F.lit(v).cast(field.dataType).alias(field.name))
    return spark.range(1).select(*cols)
