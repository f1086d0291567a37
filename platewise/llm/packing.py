"""Packing documents into sequences: dominance reduction, then best fit.

Documents become pieces of at most ``capacity`` tokens (their ids and one end
id; a longer document is cut so that only its first piece may be shorter).
What goes together is decided on the histogram of piece lengths, which has at
most ``capacity`` entries whatever the data, so it is the only thing the driver
sees.  The reduction of Martello and Toth goes through the lengths from the
largest one and fixes a set {x, ...} when it dominates every other feasible set
with x: each of those could be exchanged for it without needing more sequences.

* nothing fits beside x: x alone;
* y fills the rest exactly, or y is the largest that fits and no two others
  together beat it: {x, y};
* four never fit, y is the largest that fits beside x and z the largest beside
  both, and no feasible pair has its smaller one above z: {x, y, z}.

Fixed sets leave the histogram, which may allow further ones; what remains is
packed best fit, longest first.  Pieces of a length are then numbered in
parallel and each takes its place by its number.

Defined cases: a NULL text is empty (one piece, the end id); equal rows are
packed once each; an empty table gives no rows; only the named columns are read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platewise.llm.bpe import merge_table
from platewise.llm.common import number_in_groups, small_batches, stored


def cut_documents(df: DataFrame, path: str, capacity: int, end_id: int, id_col: str = "doc_id",
                  text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids]) of every document's pieces."""
    src = df.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    schema = (f"`{id_col}` {src.schema[0].dataType.simpleString()}, piece int, start bigint, length bigint, "
              "ids_crc32 bigint" + ", ids array<int>" * keep_ids)

    def run(batches):
        table = merge_table(path)
        for b in small_batches(batches):
            row, piece, start, length, crc, kept = [], [], [], [], [], []
            for k, ids in enumerate(table.encode_batch(b.column(1).to_pylist())):
                ids = np.append(ids, end_id).astype("<u4")
                cuts = [0, *range((len(ids) - 1) % capacity + 1, len(ids) + 1, capacity)]
                for p, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
                    row.append(k), piece.append(p), start.append(lo), length.append(hi - lo)
                    crc.append(zlib.crc32(ids[lo:hi].tobytes()))
                    if keep_ids:
                        kept.append(ids[lo:hi].astype(np.int32))
            out = {id_col: b.column(0).take(pa.array(row, pa.int64())), "piece": pa.array(piece, pa.int32()),
                   "start": pa.array(start, pa.int64()), "length": pa.array(length, pa.int64()),
                   "ids_crc32": pa.array(crc, pa.int64())}
            if keep_ids:
                out["ids"] = pa.array(kept, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_pydict(out)

    return src.mapInArrow(run, schema)


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Places for ``histogram[length]`` pieces of each length, as rows (length, first
    number, pieces, first sequence, pieces per sequence, offset in the sequence)."""
    left = {n: c for n, c in histogram.items() if c > 0}
    placed, rows, used = dict.fromkeys(left, 0), [], 0

    def fix(pattern: list[tuple[int, int]], bins: int) -> None:
        nonlocal used
        offset = 0
        for n, k in pattern:
            rows.append((n, placed[n], bins * k, used, k, offset))
            placed[n] += bins * k
            offset += n * k
        used += bins

    def take(items: list[int]) -> None:
        """Fix as many sequences of these items as there are."""
        need = {n: items.count(n) for n in items}
        bins = min(left[n] // k for n, k in need.items())
        fix(list(need.items()), bins)
        for n, k in need.items():
            left[n] -= bins * k
            if not left[n]:
                del left[n]

    changed = True
    while changed:
        changed = False
        for x in sorted(left, reverse=True):
            while x in left and (items := _dominating(left, x, capacity - x)):
                take(items)
                changed = True

    open_: list[tuple[int, int, list[tuple[int, int]]]] = []  # residual, sequences, pattern
    for n in sorted(left, reverse=True):
        todo = left[n]
        while todo:
            fits = [i for i, g in enumerate(open_) if g[0] >= n]
            i = min(fits, key=lambda i: open_[i][0]) if fits else -1
            room, bins, pattern = open_.pop(i) if fits else (capacity, todo, [])
            each = room // n
            full = min(bins, todo // each)
            if full:
                open_.append((room - each * n, full, [*pattern, (n, each)]))
                todo -= full * each
            rest = bins - full
            if rest and todo:  # fewer than ``each`` are left: they share one sequence
                open_.append((room - todo * n, 1, [*pattern, (n, todo)]))
                todo, rest = 0, rest - 1
            if rest and pattern:
                open_.append((room, rest, pattern))
    for _, bins, pattern in open_:
        fix(pattern, bins)
    return rows


def _dominating(left: dict[int, int], x: int, room: int) -> list[int] | None:
    """A set with ``x`` that dominates all others, or None if the rules name none."""
    left = {n: c - (n == x) for n, c in left.items() if c > (n == x)}
    sizes = sorted(left)
    if not sizes or sizes[0] > room:
        return [x]
    low = [n for n in sizes[:3] for _ in range(min(3, left[n]))][:3]
    y = sizes[bisect_right(sizes, room) - 1]
    if y == room or len(low) < 2 or low[0] + low[1] > room:
        return [x, y]
    if len(low) == 3 and sum(low) <= room:
        return None
    best, smaller = 0, 0  # over feasible pairs: the largest sum, the largest smaller one
    for i, n in enumerate(sizes):
        j = bisect_right(sizes, room - n) - 1
        if j > i or (j == i and left[n] > 1):
            best, smaller = max(best, n + sizes[j]), max(smaller, n)
        elif j == i and i:
            best = max(best, n + sizes[i - 1])
    if y >= best:
        return [x, y]
    second = {n: c - (n == y) for n, c in left.items() if c > (n == y)}
    rest = sorted(second)
    k = bisect_right(rest, room - y) - 1
    return [x, y, rest[k]] if k >= 0 and rest[k] >= smaller else None


def pack_documents(df: DataFrame, path: str, capacity: int = 1024, end_id: int = 2, id_col: str = "doc_id",
                   text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """Every piece with its ``sequence_id`` and ``offset``; offsets of a sequence are gapless."""
    spark = df.sparkSession
    pieces = stored(cut_documents(df, path, capacity, end_id, id_col, text_col, keep_ids), "pieces")
    histogram = {r.length: r.n for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    rows = plan(histogram, capacity)
    # from Arrow, since a list would pass through Python workers of its own
    columns = np.array(rows, np.int64).reshape(-1, 6).T
    places = spark.createDataFrame(pa.table(list(columns), ["_length", "_first", "_n", "_sequence", "_k", "_at"]))
    numbered = number_in_groups(pieces, ["length"], [id_col, "piece"], "_i")
    # the plan has a few rows per length, so it is bounded by the capacity
    met = numbered.join(F.broadcast(places), (F.col("length") == F.col("_length")) & (F.col("_i") >= F.col("_first"))
                        & (F.col("_i") < F.col("_first") + F.col("_n")))
    within = F.col("_i") - F.col("_first")
    return met.select(*pieces.columns, (F.col("_sequence") + F.floor(within / F.col("_k"))).cast("long").alias("sequence_id"),
                      (F.col("_at") + F.col("length") * (within % F.col("_k"))).cast("long").alias("offset"))
