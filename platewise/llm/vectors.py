"""Near-duplicate vectors: an exact metric range join over pivot cells.

Cosine >= t is an angle <= eps, and angles are a metric.  Each vector is at home
in the cell of its nearest pivot, and also visits every cell j where

    angle(x, p_j) <= min(angle(x, p_home) + 2 eps, radius_j + eps),

which the triangle inequality gives for all cells that can hold a partner at
home.  So a resident meets all its partners in its own cell and cells join
independently.  Pivots only steer the work: they are a bounded sample
(``max_pivots`` in all, in proportion to the size of a label), and any choice
gives the same links.  A cell with many vectors is cut into blocks (residents by
members) that are separate groups, so no group holds a whole hot cell; a block
returns counts and one edge per vector, never its pairs.  Equal vectors join
once, with their number.

Defined cases: a NULL label, a NULL vector, or one that is empty, all zero or
holds NULL, NaN or infinite components links with nothing and is its own
component; vectors of different lengths don't link; equal rows are copies that
link with each other; an empty table gives no rows; only named columns are read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platewise.llm.common import components, small_batches, stored

MARGIN = 1e-7  # on angles, for rounding: cells get a little more than they need


def _matrix(column) -> np.ndarray:
    flat = column.flatten() if isinstance(column, pa.Array) else pa.concat_arrays([c.flatten() for c in column.chunks])
    return flat.to_numpy().astype(np.float64).reshape(len(column), -1)


def _unit(m: np.ndarray) -> np.ndarray:
    m = m / np.abs(m).max(axis=1, keepdims=True)
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))


def _angles(m: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(_unit(m) @ pivots.T, -1.0, 1.0))


def link_vectors(df: DataFrame, threshold: float, id_col: str = "vec_id", vector_col: str = "embedding",
                 label_col: str = "label", cell_rows: int = 1024, max_pivots: int = 4096) -> DataFrame:
    """(id, n_links, component_id, kept) of every row; links only inside a label."""
    spark, eps = df.sparkSession, math.acos(threshold)
    rows = df.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("v"))
    sound = (F.size("v") > 0) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    # the label with its length in front, so that no label runs into the components
    tagged = F.concat_ws(":", F.octet_length(F.col("label").cast("string")).cast("string"), F.col("label").cast("string"))
    digest = F.unhex(F.sha2(F.concat_ws(",", tagged, F.col("v").cast("array<string>")), 256))
    rows = rows.withColumn("digest", F.when(F.col("id").isNotNull() & F.col("label").isNotNull() & F.coalesce(sound, F.lit(False)), digest))
    kind, vkind = rows.schema["id"].dataType.simpleString(), rows.schema["v"].dataType.simpleString()
    one = rows.where("digest IS NOT NULL").groupBy("digest").agg(
        F.min("id").alias("id"), F.count(F.lit(1)).alias("m"), F.first("label").cast("string").alias("label"), F.first("v").alias("v"))
    one = one.select("digest", "id", "m", F.concat_ws("/", F.size("v").cast("string"), "label").alias("g"), "v")
    one = stored(one, "vectors")

    # pivots: in each large group a share of the bound, the first ones by a hash
    total = one.count()
    sizes = one.groupBy("g").agg(F.count(F.lit(1)).alias("n"))
    share = F.least(F.ceil(F.col("n") / cell_rows), F.floor(F.col("n") * max_pivots / max(1, total)))
    wanted = {r.g: r.p for r in sizes.select("g", share.alias("p")).where("p > 1").collect()}
    pivots: dict[str, np.ndarray] = {}
    if wanted:
        p = spark.createDataFrame(list(wanted.items()), "g string, p long")
        near = max(0.0, 1 - 2 * max_pivots / total) if total > 4 * max_pivots else 0.0  # about twice as many as needed
        hashed = one.withColumn("h", F.pmod(F.xxhash64("digest", F.lit(1)), F.lit(1 << 30)))
        few = hashed.where(F.col("h") >= int(near * (1 << 30))).join(F.broadcast(p), "g").select("g", "p", "h", "v").collect()
        by: dict[str, list] = {}
        for r in sorted(few, key=lambda r: -r.h):
            if len(by.setdefault(r.g, [])) < r.p:
                by[r.g].append(r.v)
        pivots = {g: _unit(np.array(v, dtype=np.float64)) for g, v in by.items()}

    def home(batches):
        for b in small_batches(batches):
            cell, angle = np.zeros(b.num_rows, np.int32), np.zeros(b.num_rows)
            groups = np.array(b.column(1).to_pylist(), dtype=object)
            for g in set(groups) & pivots.keys():
                at = np.flatnonzero(groups == g)
                a = _angles(_matrix(b.column(3).take(pa.array(at))), pivots[g])
                cell[at], angle[at] = a.argmin(axis=1), a.min(axis=1)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell), pa.array(angle)], ["id", "g", "m", "v", "cell", "angle"])

    homes = one.select("id", "g", "m", "v").mapInArrow(home, f"id {kind}, g string, m bigint, v {vkind}, cell int, angle double")
    homes = stored(homes, "homes")
    radius = homes.groupBy("g", "cell").agg(F.max("angle").alias("r"))
    radii = {g: np.full(len(p), -9.0) for g, p in pivots.items()}
    for r in radius.where(F.col("g").isin(list(radii))).collect() if radii else []:
        radii[r.g][r.cell] = r.r

    def visit(batches):
        for b in small_batches(batches):
            row, cell, own = [np.arange(b.num_rows)], [b.column(4).to_numpy()], [np.ones(b.num_rows, bool)]
            groups = np.array(b.column(1).to_pylist(), dtype=object)
            for g in set(groups) & pivots.keys():
                at = np.flatnonzero(groups == g)
                a = _angles(_matrix(b.column(3).take(pa.array(at))), pivots[g])
                bound = np.minimum(a.min(axis=1, keepdims=True) + 2 * eps, radii[g] + eps) + MARGIN
                meet = a <= bound
                meet[np.arange(len(at)), cell[0][at]] = False
                i, j = np.nonzero(meet)
                row.append(at[i]), cell.append(j.astype(np.int32)), own.append(np.zeros(len(i), bool))
            take = pa.array(np.concatenate(row))
            yield pa.RecordBatch.from_arrays(
                [*(b.column(k).take(take) for k in range(4)), pa.array(np.concatenate(cell)), pa.array(np.concatenate(own))],
                ["id", "g", "m", "v", "cell", "own"])

    met = stored(homes.mapInArrow(visit, f"id {kind}, g string, m bigint, v {vkind}, cell int, own boolean"), "cells")
    load = stored(met.groupBy("g", "cell").agg(
        F.ceil(F.sum(F.col("own").cast("int")) / cell_rows).alias("na"), F.ceil(F.count(F.lit(1)) / cell_rows).alias("nb")), "load")
    met = met.join(load, ["g", "cell"])
    key = F.xxhash64("id")
    residents = met.where("own").select("g", "cell", "id", "m", "v", F.lit(True).alias("own"), F.pmod(key, "na").alias("a"),
                                        F.explode(F.sequence(F.lit(0), F.col("nb") - 1)).alias("b"))
    members = met.select("g", "cell", "id", "m", "v", F.lit(False).alias("own"),
                         F.explode(F.sequence(F.lit(0), F.col("na") - 1)).alias("a"), F.pmod(key, "nb").alias("b"))

    def join(table: pa.Table) -> pa.Table:
        own = table["own"].to_numpy()
        t, u = table.filter(pa.array(own)), table.filter(pa.array(~own))
        if not len(t) or not len(u):
            return table.schema.empty_table().select(["id"]).append_column("n", pa.array([], pa.int64())).append_column("to", pa.array([], table.schema.field("id").type))
        ids = pa.concat_arrays([*t["id"].chunks, *u["id"].chunks]).dictionary_encode()
        node = ids.indices.to_numpy()
        x, y = node[:len(t)], node[len(t):]
        linked = (_unit(_matrix(t["v"])) @ _unit(_matrix(u["v"])).T >= threshold) & (x[:, None] != y[None, :])
        count = linked @ u["m"].to_numpy()
        i, j = np.nonzero(linked)
        label = np.arange(len(ids.dictionary))
        while True:  # one edge per vector: to the smallest position that its links in this block reach
            before = label.copy()
            np.minimum.at(label, x[i], label[y[j]])
            np.minimum.at(label, y[j], label[x[i]])
            label = label[label]
            if (label == before).all():
                break
        n = np.bincount(x, count, len(label)).astype(np.int64)
        return pa.table({"id": ids.dictionary, "n": pa.array(n), "to": ids.dictionary.take(pa.array(label))})

    found = residents.unionByName(members).groupBy("g", "cell", "a", "b").applyInArrow(join, f"id {kind}, n bigint, to {kind}")
    found = stored(found.where((F.col("n") > 0) | (F.col("id") != F.col("to"))), "links")
    count = found.groupBy("id").agg(F.sum("n").alias("_n")).select(F.col("id").alias("_cid"), "_n")
    roots = components(found, "id", "to")
    label = (one.select("digest", "id", "m").join(count, F.col("id") == F.col("_cid"), "left")
             .join(roots, F.col("id") == F.col("node"), "left")
             .select(F.col("digest").alias("_d"), (F.coalesce("_n", F.lit(0)) + F.col("m") - 1).alias("n_links"),
                     F.coalesce("root", F.col("id")).alias("_root")))
    out = rows.select("id", "digest").join(label, F.col("digest") == F.col("_d"), "left")
    root = F.coalesce("_root", F.col("id"))
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      root.alias("component_id"), F.col("id").eqNullSafe(root).alias("kept"))
