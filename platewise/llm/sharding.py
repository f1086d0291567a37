"""Sharding by size with Karmarkar-Karp differencing; equal texts stay together.

A partial partition is a tuple of ``shards`` sums.  Differencing repeatedly takes
the two with the largest spread (largest sum less smallest) and adds them in
opposite order.  The rule works on partial partitions of any origin, so it runs
in a tree: groups of equal texts are dealt to cells by a hash, each cell
combines its groups into one tuple, and the tuples of ``fan_in`` cells are
combined by one task of the next level until one is left.  Groups too large for
one cell to offset are placed before the others, and as many cells as are needed
start from an equal part of the unevenness they leave.  Tasks hold
``groups_per_cell`` groups or ``fan_in`` tuples on average, whatever the data;
the driver sees one sum per shard.

Defined cases: a NULL text has no bytes and stands with the empty texts; equal
rows are one group; an empty table gives no rows; a group above the mean shard
size makes its shard larger (groups are indivisible); other columns aren't read.
"""

from __future__ import annotations

import heapq

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platewise.llm.common import number_in_groups, stored


def differencing(partials: list[list[tuple[int, object]]], shards: int) -> list[tuple[int, list]]:
    """Combine partial partitions, each a list of (sum, label), into one; returns
    ``shards`` pairs (sum, labels)."""
    heap = []
    for i, bins in enumerate(partials):
        bins = sorted(bins, key=lambda b: -b[0]) + [(0, None)] * (shards - len(bins))
        heap.append((bins[-1][0] - bins[0][0], i, bins))
    heapq.heapify(heap)
    while len(heap) > 1:
        _, i, a = heapq.heappop(heap)
        _, _, b = heap[0]
        made = [(x[0] + y[0], x[1] if y[1] is None else y[1] if x[1] is None else [x[1], y[1]])
                for x, y in zip(a, reversed(b))]
        made.sort(key=lambda x: -x[0])
        heapq.heapreplace(heap, (made[-1][0] - made[0][0], i, made))
    out = []
    for total, tree in heap[0][2] if heap else []:
        labels, todo = [], [tree]
        while todo:
            t = todo.pop()
            if isinstance(t, list):
                todo += t
            elif t is not None:
                labels.append(t)
        out.append((total, labels))
    return out


def balance(groups: DataFrame, shards: int, key: str = "key", size: str = "size",
            groups_per_cell: int = 2000, fan_in: int = 2000) -> DataFrame:
    """(key, bytes, shard) of every row of ``groups``, whose keys are distinct."""
    groups = groups.select(F.col(key).alias("key"), F.col(size).cast("long").alias("bytes"))
    kind = groups.schema["key"].dataType.simpleString()
    groups_per_cell = max(groups_per_cell, 4 * shards)
    n, total = groups.agg(F.count(F.lit(1)), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    cells, taking, share, large = max(1, -(-n // groups_per_cell)), 0, [0] * shards, None
    if cells > 1:
        # groups that one cell couldn't offset are placed first, by the same rule;
        # there are at most n * shards / groups_per_cell of them
        cut = total / (cells * shards)
        large = stored(balance(groups.where(F.col("bytes") > cut), shards, "key", "bytes", groups_per_cell, fan_in), "large")
        groups = groups.where(F.col("bytes") <= cut)
        sums = {r.shard: r.b for r in large.groupBy("shard").agg(F.sum("bytes").alias("b")).collect()}
        uneven = [sums.get(i, 0) - min([sums.get(j, 0) for j in range(shards)]) for i in range(shards)]
        lacking, small = shards * max(uneven) - sum(uneven), total - sum(sums.values())
        # so many cells even out what those left uneven, each an equal share of it
        taking = min(cells, -(-2 * lacking * cells // max(1, small))) if lacking else 0
        share = [x // taking for x in uneven] if taking else share

    def start(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["bytes", "key"]).reset_index(drop=True)
        partials = [[(int(b), i)] for i, b in enumerate(pdf["bytes"])]
        takes = int(pdf["cell"][0]) < taking
        if takes:  # a partial partition that holds the unevenness; its bins name the shards
            partials.append([(x, -1 - i) for i, x in enumerate(share)])
        to = [0] * len(pdf)
        for b, (_, rows) in enumerate(differencing(partials, shards)):
            b = -1 - min(rows) if takes else b
            for i in rows:
                if i >= 0:
                    to[i] = b
        pdf["cell"] = 0 if takes else pdf["cell"] - taking + 1
        return pdf.assign(to=to)

    def combine(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["cell", "bin"]).reset_index(drop=True)
        partials = [[(int(pdf["bytes"][i]), i) for i in at] for at in pdf.groupby("cell", sort=True).indices.values()]
        to = [0] * len(pdf)
        for b, (_, rows) in enumerate(differencing(partials, shards)):
            for i in rows:
                to[i] = b
        return pdf.assign(to=to)

    dealt = groups.select(F.pmod(F.xxhash64("key"), F.lit(cells)).alias("cell"), "key", "bytes")
    level = dealt.groupBy("cell").applyInPandas(start, f"cell bigint, key {kind}, bytes bigint, to int")
    if large is not None:
        level = level.unionByName(large.select(F.lit(0).cast("long").alias("cell"), "key", "bytes", F.col("shard").alias("to")))
    level = placed = stored(level, "cells")
    cells += 1 - taking
    while cells > 1:
        cells = -(-cells // fan_in)
        sums = level.groupBy("cell", "to").agg(F.sum("bytes").alias("bytes")).select(
            F.floor(F.col("cell") / fan_in).alias("parent"), F.col("cell"), F.col("to").alias("bin"), "bytes")
        level = stored(sums.groupBy("parent").applyInPandas(
            combine, "parent bigint, cell bigint, bin int, bytes bigint, to int"), "cells")
        moves = level.select(F.col("cell").alias("_cell"), F.col("bin").alias("_bin"), F.col("parent").alias("_parent"),
                             F.col("to").alias("_to"))
        placed = placed.join(moves, (F.col("cell") == F.col("_cell")) & (F.col("to") == F.col("_bin"))).select(
            "key", placed["bytes"], F.col("_parent").alias("cell"), F.col("_to").alias("to"))
        level = level.select(F.col("parent").alias("cell"), "bytes", "to")
    return placed.select("key", "bytes", F.col("to").alias("shard"))


def shard_documents(df: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text",
                    extra_bytes: int = 8) -> DataFrame:
    """(id, size, text_crc32, shard, slot) of every row; slots are gapless in a shard."""
    text = F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8")
    docs = df.select(F.col(id_col), (F.octet_length(text) + extra_bytes).cast("long").alias("size"),
                     F.crc32(text).alias("text_crc32"), F.unhex(F.sha2(text, 256)).alias("_key"))
    docs = stored(docs, "sized")
    groups = stored(docs.groupBy("_key").agg(F.sum("size").alias("bytes")), "groups")
    placed = balance(groups, shards, "_key", "bytes").select(F.col("key").alias("_group"), "shard")
    out = docs.join(placed, F.col("_key") == F.col("_group")).drop("_key", "_group")
    return number_in_groups(stored(out, "sharded"), ["shard"], [id_col, "size", "text_crc32"], "slot")
