"""Substring dedup by fixed-block anchors: word windows that occur more than once.

A window of ``window`` words always contains a whole block of
``(window + 1) // 2`` words that starts at a multiple of the block size in its
own document.  So the non-overlapping blocks of all documents are the reference
index and every rolling window of block size of all documents probes it.  A
block that is met anywhere but at its own place is a hit (an anchor).  Hits are
extended: every full window that contains a hit block of its document is
fingerprinted with 128 bits (two keys), and the windows whose fingerprint occurs twice are
the exact repeats; overlapping ones together are the maximal ones.  Extending by
fingerprints rather than pair by pair keeps a passage that a third of the
documents share linear in its occurrences.

Probes travel as packed arrays of 48-bit fingerprints, dealt to cells by hash.
What a task meets twice itself is decided there, so one fingerprint reaches its
cell at most twice per batch, however common it is; a false match of 48 bits
only costs an extension.  Documents with equal words are one document to the
index, and all their windows are repeats.

Defined cases: a NULL text has no words; documents of fewer than ``window``
words lose nothing; equal rows are copies of each other; an id stands for one
text, and a row without an id loses nothing; an empty table gives no rows; only the named columns are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platewise.llm.common import broadcast_ids, pieces, release_memory, small_batches, stored, words
from platewise.llm.text_arrays import Words

CELL_BYTES = 8 << 20  # text behind one cell of the index
DEAL_BYTES, READ_BYTES = 2 << 20, 1 << 18  # text dealt at once, and read at once for it


def _runs(h: np.ndarray, g: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(group of each item, size of each group, first item of each group) of equal fingerprints."""
    order = np.argsort(h, kind="stable") if g is None else np.lexsort((g, h))
    h = h[order]
    new = h[1:] != h[:-1]
    if g is not None:
        g = g[order]
        new |= g[1:] != g[:-1]
    first = order[np.concatenate([[True], new])[:len(order)]]
    del h, g
    rank = np.zeros(len(order), np.int32)
    np.cumsum(new, dtype=np.int32, out=rank[1:])
    group = np.empty(len(order), np.int32)
    group[order] = rank
    return group, np.bincount(group, minlength=1), first


def _pack(h: np.ndarray, g: np.ndarray | None) -> bytes:
    if g is None:
        return np.ascontiguousarray(h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, 2:]).tobytes()
    return np.ascontiguousarray(np.stack([h, g], 1).astype("<u8")).tobytes()


def _unpack(data: bytes, wide: bool) -> tuple[np.ndarray, np.ndarray | None]:
    if wide:
        both = np.frombuffer(data, "<u8").reshape(-1, 2)
        return both[:, 0], both[:, 1]
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, 2:] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.reshape(-1).view("<u8"), None


def _met_twice(found: DataFrame, kind: str, items, cells: int, wide: bool) -> DataFrame:
    """(id, at) of the items that ask and whose fingerprint occurs twice or more in all.

    ``items(batch)`` gives arrays: fingerprints h and g (g None unless ``wide``),
    row in the batch, place, and whether the item asks.
    """
    shape = f"cell int, probe binary, ask binary, id array<{kind}>, at array<int>, hit_id array<{kind}>, hit_at array<int>"

    def deal(batches):
        for b in small_batches(batches, DEAL_BYTES):
            read, at = [], 0
            for part in pieces(b, READ_BYTES):
                h, g, row, place, asks = items(part)
                read.append((h, g, (row + at).astype(np.int32), place.astype(np.int32), asks))
                at += part.num_rows
            h, g, row, place, asks = (None if x[0] is None else np.concatenate(x) for x in zip(*read))
            del read
            if not len(h):
                continue
            group, size, pick = _runs(h, g)
            twice = size[group] > 1
            del group
            hit = np.flatnonzero(asks & twice)
            pick.sort()
            cell = ((h[pick] if wide else h[pick] >> np.uint64(16)) % np.uint64(cells)).astype(np.int32)
            out = {k: [] for k in ("cell", "probe", "ask", "id", "at", "hit_id", "hit_at")}
            ids = b.column(0)
            order = np.argsort(cell, kind="stable")
            pick, ends = pick[order], np.searchsorted(cell[order], np.arange(cells + 1))
            met = np.flatnonzero(np.diff(ends))
            bearer = met[int(h[0] >> np.uint64(20)) % len(met)]  # of what is decided here
            for c in met:
                own = pick[ends[c]:ends[c + 1]]
                ask = own[asks[own] & ~twice[own]]
                rest = own[~asks[own] | twice[own]]
                again = rest[twice[rest]]
                probe = np.concatenate([rest, again])
                out["cell"].append(c)
                out["probe"].append(_pack(h[probe], None if g is None else g[probe]))
                out["ask"].append(_pack(h[ask], None if g is None else g[ask]))
                out["id"].append(ids.take(pa.array(row[ask])))
                out["at"].append(place[ask].astype(np.int32))
                told = hit if c == bearer else hit[:0]
                out["hit_id"].append(ids.take(pa.array(row[told])))
                out["hit_at"].append(place[told].astype(np.int32))
            yield pa.RecordBatch.from_pydict({
                "cell": pa.array(out["cell"], pa.int32()), "probe": pa.array(out["probe"], pa.binary()),
                "ask": pa.array(out["ask"], pa.binary()), **{k: _lists(out[k]) for k in ("id", "at", "hit_id", "hit_at")}})

    def meet(table: pa.Table) -> pa.Table:
        met = matched(table)
        release_memory()
        return met

    def matched(table: pa.Table) -> pa.Table:
        probe, ask = (_unpack(b"".join(table[k].to_pylist()), wide) for k in ("probe", "ask"))
        n = len(ask[0])
        h = np.concatenate([ask[0], probe[0]])
        group, size, _ = _runs(h, np.concatenate([ask[1], probe[1]]) if wide else None)
        hit = np.flatnonzero(size[group[:n]] > 1)
        flat = lambda k: pa.concat_arrays([c.flatten() for c in table[k].chunks])
        return pa.table({"id": pa.concat_arrays([flat("id").take(pa.array(hit)), flat("hit_id")]),
                         "at": pa.concat_arrays([flat("at").take(pa.array(hit)), flat("hit_at")])})

    return found.mapInArrow(deal, shape).groupBy("cell").applyInArrow(meet, f"id {kind}, at int")


def _lists(parts: list) -> pa.ListArray:
    arrays = [p if isinstance(p, pa.Array) else pa.array(p) for p in parts]
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, arrays)]), pa.int32()), pa.concat_arrays(arrays))


def _spans(keep: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate([[True], keep, [True]]).view(np.int8)))
    return list(zip(edge[0::2].tolist(), edge[1::2].tolist()))


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 50) -> DataFrame:
    """(id, n_words, n_removed, kept, removed): every row without the words that lie in
    a window of ``window`` words that occurs anywhere else; ``kept`` has the words
    left, joined by one space, ``removed`` the word ranges (end exclusive)."""
    block = (window + 1) // 2
    docs = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = docs.schema["id"].dataType.simpleString()
    own = words("text")
    base = docs.select("id", F.size(own).alias("n"), F.unhex(F.sha2(F.array_join(own, " "), 256)).alias("digest"),
                       F.octet_length("text").cast("long").alias("bytes"))
    base = stored(base.where("id IS NOT NULL"), "base")
    copied = stored(base.groupBy("digest").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("m")).where("m > 1")
                    .select(F.col("digest").alias("_digest"), "rep"), "copied")
    copies = stored(base.join(copied, F.col("digest") == F.col("_digest")).select("id", "n", "rep"), "copies")
    others = stored(copies.where("id <> rep").select(F.col("id").alias("_id")).distinct(), "others")
    single = docs.join(broadcast_ids(others), F.col("id") == F.col("_id"), "left_anti").where("id IS NOT NULL")
    size = base.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    cells = max(1, -(-size // CELL_BYTES))

    def anchors(b):
        w = Words(b.column(1).to_pylist())
        mark, offset = w.windows(block)
        row = np.repeat(np.arange(b.num_rows), np.diff(offset))
        place = np.arange(len(mark)) - offset[:-1][row]
        return mark & np.uint64(0xFFFFFFFFFFFF0000), None, row, place, place % block == 0

    hits = _met_twice(single, kind, anchors, cells, False)
    hits = stored(hits.groupBy("id").agg(F.collect_set("at").alias("hits")), "hits")
    near = broadcast_ids(stored(hits.select(F.col("id").alias("_id")), "hit-ids"))
    near = single.join(near, F.col("id") == F.col("_id")).select("id", "text")
    near = stored(near.join(hits, "id").select("id", "text", "hits"), "near")

    def extended(b):
        texts = b.column(1).to_pylist()
        w = Words(texts)
        (h, offset), (g, _) = w.windows(window), w.windows(window, seed=2)
        want = np.zeros(len(h), bool)
        for i, at in enumerate(b.column(2)):
            n = offset[i + 1] - offset[i]
            for p in at.values.to_numpy():
                want[offset[i] + min(n, max(0, p - window + block)):offset[i] + min(n, p + 1)] = True
        row = np.repeat(np.arange(b.num_rows), np.diff(offset))
        at = np.flatnonzero(want)
        return h[at], g[at], row[at], at - offset[:-1][row[at]], np.ones(len(at), bool)

    size = near.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    starts = _met_twice(near, kind, extended, max(1, -(-size // CELL_BYTES)), True)
    starts = stored(starts.groupBy("id").agg(F.collect_set("at").alias("starts")), "starts")

    def cut(batches):
        for b in small_batches(batches):
            w = Words(b.column(1).to_pylist())
            out, count, gone = [], [], []
            for i, at in enumerate(b.column(2)):
                n = int(w.at[i + 1] - w.at[i])
                depth = np.zeros(n + 1, np.int64)
                at = at.values.to_numpy()
                depth[at] += 1
                np.add.at(depth, at + window, -1)
                keep = np.cumsum(depth)[:n] == 0
                out.append(w.text(i, keep).decode())
                count.append(int(n - keep.sum()))
                gone.append([{"start": a, "end": z} for a, z in _spans(keep)])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(count, pa.int32()), pa.array(out, pa.string()), pa.array(
                gone, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))], ["id", "n_removed", "kept", "removed"])

    gone = "array<struct<start:int,end:int>>"
    changed = (near.select("id", "text").join(starts, "id")
               .mapInArrow(cut, f"id {kind}, n_removed int, kept string, removed {gone}"))
    whole = copies.where(F.col("n") >= window)
    touched = stored(starts.select("id").unionByName(whole.select("id")).distinct().select(F.col("id").alias("_id")), "touched")
    left = docs.join(broadcast_ids(touched), F.col("id") == F.col("_id"), "left_anti").select("id", own.alias("_w"))
    left = left.select("id", F.size("_w").alias("n"), F.lit(0).alias("n_removed"), F.array_join("_w", " ").alias("kept"),
                       F.array().cast(gone).alias("removed"))
    whole = whole.select("id", "n", F.col("n").alias("n_removed"), F.lit("").alias("kept"),
                         F.array(F.struct(F.lit(0).alias("start"), F.col("n").alias("end"))).cast(gone).alias("removed"))
    changed = (changed.join(whole.select(F.col("id").alias("_id")).distinct(), F.col("id") == F.col("_id"), "left_anti")
               .join(base.select(F.col("id").alias("_b"), "n"), F.col("id") == F.col("_b"))
               .select("id", "n", "n_removed", "kept", "removed"))
    out = left.unionByName(whole).unionByName(changed)
    return out.select(F.col("id").alias(id_col), F.col("n").cast("long").alias("n_words"),
                      F.col("n_removed").cast("long").alias("n_removed"), "kept", "removed")
