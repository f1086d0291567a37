"""Bloom pre-screen for an anti join: rows that surely have no partner skip it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platewise.operators.relational import not_in
from platewise.session import durable

BLOCK_BITS = 32_768  # bits of one block; Spark's bitmap functions build blocks of this size
BLOCK_BYTES = BLOCK_BITS // 8


def bloom_filter(df: DataFrame, col: str, bits_per_key: int = 12, hashes: int = 7, max_bytes: int = 64 << 20) -> tuple[DataFrame, int]:
    """Blocked Bloom filter of the values of ``col`` (NULLs left out): a table ``(_block, _bits)``
    and its number of blocks.

    A value belongs to one block and sets ``hashes`` bits there, so a lookup needs one block.
    Every task builds its own bitmaps, which are merged by OR; what is shuffled are blocks of
    4 KiB, not values.  The number of blocks follows the row count, up to ``max_bytes``
    in all: beyond it the blocks fill up and more rows pass as "maybe", and nothing else changes.
    """
    values = df.where(F.col(col).isNotNull())
    n = values.count()
    blocks = max(1, min(-(-n * bits_per_key // BLOCK_BITS), max_bytes // BLOCK_BYTES))
    block, bits = _places(F.col(col), blocks, hashes)
    placed = values.select(block.alias("_block"), F.explode(F.array(*bits)).alias("_bit"))
    built = placed.groupBy("_block").agg(F.bitmap_construct_agg("_bit").alias("_bits"))
    return durable(built), blocks


def _places(value: Column, blocks: int, hashes: int) -> tuple[Column, list[Column]]:
    """A value's block and its bits there: double hashing with an odd step."""
    one, two = F.xxhash64(value), F.xxhash64(value, F.lit("step"))
    step = two.bitwiseOR(F.lit(1)) % BLOCK_BITS
    at = F.shiftrightunsigned(two, 32) % BLOCK_BITS
    return F.pmod(one, F.lit(blocks)), [F.pmod(at + step * i, F.lit(BLOCK_BITS)) for i in range(hashes)]


def maybe_held(df: DataFrame, col: str, bloom: tuple[DataFrame, int], hashes: int = 7, out: str = "_maybe") -> DataFrame:
    """``df`` with a boolean ``out``: false where the filter surely lacks the value of ``col`` (and for NULL).

    The filter's blocks are broadcast; their size is bounded where the filter is built.
    """
    table, blocks = bloom
    block, bits = _places(F.col(col), blocks, hashes)
    held = F.lit(True)
    for bit in bits:
        byte = F.conv(F.hex(F.substring(F.col("_bits"), F.shiftright(bit, 3).cast("int") + 1, F.lit(1))), 16, 10)
        held = held & (F.getbit(byte.cast("int"), (bit % 8).cast("int")) == 1)
    met = df.withColumn("_own", block).join(F.broadcast(table), F.col("_own") == F.col("_block"), "left")
    return met.withColumn(out, F.col(col).isNotNull() & F.col("_bits").isNotNull() & held).drop("_own", "_block", "_bits")


def not_in_screened(df: DataFrame, other: DataFrame, col: str, other_col: str | None = None, null_aware: bool = True,
                    bits_per_key: int = 12, max_bytes: int = 64 << 20) -> DataFrame:
    """The rows of :func:`not_in`, with both sides screened before the join.

    A filter of ``df``'s values leaves out the rows of ``other`` that no row of ``df`` can
    meet, in a scan of that column; a filter of what is left tells which rows of ``df``
    are surely not in ``other``.  Only the remaining rows of both sides are shuffled
    and joined, so a batch against a table many times its size moves about the batch.  The
    result is exact whatever the filters let pass.  It pays where one side holds few of
    the other's values; where almost all rows have partners, :func:`not_in` does the same
    join without the two further scans.
    """
    oc = other_col or col
    kinds = df.schema[col].dataType, other.schema[oc].dataType
    if kinds[0] != kinds[1]:
        raise TypeError(f"{col} and {oc} must have one type, not {kinds[0].simpleString()} and {kinds[1].simpleString()}")
    keys = other.select(F.col(oc).alias("_ni_key"))
    sized = {"bits_per_key": bits_per_key, "max_bytes": max_bytes}
    near = maybe_held(keys, "_ni_key", bloom_filter(df.select(col), col, **sized)).where("_maybe").drop("_maybe")
    near = durable(near)
    screened = maybe_held(df, col, bloom_filter(near, "_ni_key", **sized))
    new = screened.where(F.col(col).isNotNull() & ~F.col("_maybe")).drop("_maybe")
    maybe = screened.where(F.col(col).isNull() | F.col("_maybe")).drop("_maybe")
    result = new.unionByName(not_in(maybe, near, col, "_ni_key", null_aware=False))
    if not null_aware:
        return result
    has_null, nonempty = keys.where(F.col("_ni_key").isNull()).exists(), keys.exists()
    return result.where(~has_null & (F.col(col).isNotNull() | ~nonempty))
