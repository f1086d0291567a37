"""Text classification by an embedding bag: the mean of hashed n-gram vectors, then a softmax layer.

Training is distributed descent.  The texts become bags of hashed character n-grams once,
spread at random over ``learners`` files.  In every epoch each learner streams its rows in
mini-batches through its own copy of the model (Adagrad), and the copies are averaged by
row counts, ``FAN`` at a time in a tree, so no task holds more than ``FAN`` pieces of
``BLOCK`` numbers.  The loss on the validation rows steers the rate and the end.

The model has (``slots`` + classes) x ``width`` numbers whatever the corpus; it is the one
thing that the driver holds, and it travels by broadcast, once per executor.

Defined cases: a NULL or empty text is an empty bag, whose class the bias decides; a row
without a label isn't learned from; texts of any length are read whole, in pieces; an empty
training table is an error.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from platewise.functions.arrays import argmax, max_prob
from platewise.functions.text import KEPT_RANGES
from platewise.session import durable

PIECE = 1 << 20  # characters whose n-grams are hashed at once
BLOCK = 1 << 16  # numbers of a model in one row of the average
ROWS_AT_ONCE = 512
FAN = 16  # copies averaged by one task
MODEL_BYTES = 256 << 20  # largest model that is broadcast
ROWS_PER_LEARNER = 4096  # fewer rows aren't worth a copy of the model
MOST_ROWS = 1 << 15  # rows that one learner goes through in an epoch, so a task's time doesn't grow with the input
HASH = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)


@dataclass
class Shape:
    """Sizes of a model and how texts become bags."""

    classes: int
    slots: int = 1 << 14
    width: int = 16
    ngram: int = 3

    def sizes(self) -> list[int]:
        """Numbers in: vectors, layer, bias, then Adagrad's sums (one per slot, layer, bias)."""
        return [self.slots * self.width, self.classes * self.width, self.classes, self.slots, self.classes * self.width, self.classes]

    def parts(self, flat: np.ndarray) -> list[np.ndarray]:
        """Views of the flat model: E, W, b and their sums of squares."""
        e, w, b, se, sw, sb = np.split(flat, np.cumsum(self.sizes())[:-1])
        return [e.reshape(self.slots, self.width), w.reshape(self.classes, self.width), b, se, sw.reshape(self.classes, self.width), sb]


@dataclass
class BagModel:
    shape: Shape
    flat: np.ndarray
    history: list[dict] = field(default_factory=list)  # per epoch: rate, validation loss and accuracy


# ------------------------------------------------------------------ bags ----

def _lower_kept() -> np.ndarray:
    """Per code point what ``clean_text`` and ``lower`` leave of it; 0 where it is dropped."""
    table = np.zeros(0x110000, np.uint32)
    for lo, hi in KEPT_RANGES:
        table[lo:hi + 1] = np.arange(lo, hi + 1)
    table[ord("A"):ord("Z") + 1] += 32  # no other kept character has a lower case
    return table


def clean_lower(text: bytes | None, table: np.ndarray) -> str:
    """``lower(clean_text(text))`` of a text in UTF-8, by a lookup per character, in pieces; no text is empty."""
    out, whole = [], (text or b"").decode("utf-8", "ignore")  # a malformed byte is no kept character
    for at in range(0, len(whole), PIECE):
        kept = table[np.frombuffer(whole[at:at + PIECE].encode("utf-32-le"), np.uint32)]
        out.append(kept[kept > 0].tobytes().decode("utf-32-le"))
    return "".join(out)


def _grams(points: np.ndarray, ngram: int, slots: int) -> np.ndarray:
    """Slot of the n-gram that starts at each position but the last ``ngram - 1``."""
    n = max(0, len(points) - ngram + 1)
    h = np.zeros(n, np.uint64)
    for i in range(ngram):
        h = (h ^ points[i:i + n].astype(np.uint64)) * np.uint64(HASH[i % 3])
        h ^= h >> np.uint64(29)
    return ((h * np.uint64(HASH[3])) >> np.uint64(33)) % np.uint64(slots)


def _points(text: str) -> np.ndarray:
    return np.frombuffer(f" {text} ".encode("utf-32-le", "surrogatepass"), np.uint32)


def _one_bag(text: str, ngram: int, slots: int) -> tuple[np.ndarray, np.ndarray]:
    """A long text's slots and their counts, piece by piece."""
    counts = np.zeros(slots, np.int64)
    for start in range(0, len(text) + 2, PIECE):
        piece = text[max(0, start - 1):start + PIECE + ngram - 2]  # text[i - 1] is character i of " text "
        points = np.frombuffer(((" " if start == 0 else "") + piece + (" " if start + PIECE + ngram - 2 > len(text) else "")).encode("utf-32-le", "surrogatepass"), np.uint32)
        counts += np.bincount(_grams(points[:PIECE + ngram - 1], ngram, slots).astype(np.int64), minlength=slots)
    found = np.flatnonzero(counts)
    return found, counts[found]


def bags(texts: list[str], ngram: int, slots: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(slots, shares) of every text, slots ascending, shares adding up to 1."""
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end]) <= PIECE):
            size += len(texts[end])
            end += 1
        if size > PIECE:
            run = [_one_bag(texts[at], ngram, slots)]
        else:
            each = [_grams(_points(t), ngram, slots).astype(np.int64) for t in texts[at:end]]
            owner = np.repeat(np.arange(len(each)), [len(g) for g in each])
            key, n = np.unique(owner * slots + np.concatenate(each), return_counts=True)
            cut = np.searchsorted(key, np.arange(len(each) + 1) * slots)
            run = [(key[a:b] % slots, n[a:b]) for a, b in zip(cut[:-1], cut[1:])]
        for found, n in run:
            yield found, n / max(1, n.sum())
        at = end


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Few rows at once, however many the session sends to Python in a batch."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            yield batch.slice(at, ROWS_AT_ONCE)


def _to_bags(shape: Shape):
    def run(batches):
        table = _lower_kept()
        for batch in _slices(batches):
            made = list(bags([clean_lower(t, table) for t in batch.column("_text").to_pylist()], shape.ngram, shape.slots))
            off = np.cumsum([0] + [len(s) for s, _ in made]).astype(np.int32)
            slots = np.concatenate([s for s, _ in made] or [np.zeros(0)]).astype(np.int32)
            share = np.concatenate([w for _, w in made] or [np.zeros(0)]).astype(np.float64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_label"), batch.column("_spread"), pa.ListArray.from_arrays(pa.array(off), pa.array(slots)),
                 pa.ListArray.from_arrays(pa.array(off), pa.array(share))], names=["label", "spread", "slots", "shares"])
    return run


def _bag_rows(df: DataFrame, text_col: str, label_col: str, shape: Shape) -> DataFrame:
    text = df.select(
        F.col(text_col).cast("binary").alias("_text"), F.col(label_col).cast("int").alias("_label"), F.monotonically_increasing_id().alias("_at"))
    rows = text.where(F.col("_label").isNotNull()).select("_text", "_label", F.xxhash64("_at").alias("_spread"))
    return rows.mapInArrow(_to_bags(shape), "label int, spread long, slots array<int>, shares array<double>")


# -------------------------------------------------------------- learning ----

def _flat_rows(batch: pa.RecordBatch):
    """(labels, row ends, slots, shares) of an Arrow batch, as arrays."""
    slots, shares = batch.column("slots"), batch.column("shares")
    ends = slots.offsets.to_numpy().astype(np.int64)
    return (batch.column("label").to_numpy(zero_copy_only=False).astype(np.int64), ends - ends[0],
            slots.flatten().to_numpy().astype(np.int64), shares.flatten().to_numpy())


def _mini_batches(batches, size: int):
    """Mini-batches of ``size`` rows, whatever the Arrow batches' sizes."""
    held = None
    for batch in _slices(batches):
        y, ends, s, w = _flat_rows(batch)
        if held is not None:
            hy, hends, hs, hw = held
            y, ends, s, w = np.r_[hy, y], np.r_[hends, hends[-1] + ends[1:]], np.r_[hs, s], np.r_[hw, w]
        full = len(y) // size * size
        for a in range(0, full, size):
            yield y[a:a + size], ends[a:a + size + 1] - ends[a], s[ends[a]:ends[a + size]], w[ends[a]:ends[a + size]]
        held = y[full:], ends[full:] - ends[full], s[ends[full]:], w[ends[full]:]
    if held is not None and len(held[0]):
        yield held


def _hidden(e: np.ndarray, ends: np.ndarray, slots: np.ndarray, shares: np.ndarray) -> np.ndarray:
    out = np.zeros((len(ends) - 1, e.shape[1]))
    some = np.flatnonzero(np.diff(ends))
    if len(some):
        out[some] = np.add.reduceat(e[slots] * shares[:, None], ends[some], axis=0)
    return out


def _softmax(z: np.ndarray) -> np.ndarray:
    p = np.exp(z - z.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def _step(parts, y, ends, slots, shares, rate: float) -> None:
    """One Adagrad step on the mean loss of a mini-batch, in place."""
    e, w, b, se, sw, sb = parts
    h = _hidden(e, ends, slots, shares)
    g = _softmax(h @ w.T + b)
    g[np.arange(len(y)), y] -= 1
    g /= len(y)
    gh, gw, gb = g @ w, g.T @ h, g.sum(axis=0)
    if len(slots):
        order = np.argsort(slots, kind="stable")
        hit, first = np.unique(slots[order], return_index=True)
        owner = np.repeat(np.arange(len(y)), np.diff(ends))
        ge = np.add.reduceat((gh[owner] * shares[:, None])[order], first, axis=0)
        se[hit] += (ge * ge).mean(axis=1)
        e[hit] -= rate * ge / np.sqrt(se[hit] + 1e-12)[:, None]
    sw += gw * gw
    sb += gb * gb
    w -= rate * gw / np.sqrt(sw + 1e-12)
    b -= rate * gb / np.sqrt(sb + 1e-12)


def _learn(shape: Shape, given, rate: float, size: int):
    def run(batches):
        flat, n = given.value.copy(), 0
        parts = shape.parts(flat)
        for rows in _mini_batches(batches, size):
            _step(parts, *rows, rate)
            n += len(rows[0])
        if n:
            me = TaskContext.get().partitionId()
            for at in range(0, len(flat), BLOCK):
                yield pa.RecordBatch.from_pydict({"learner": pa.array([me], pa.int32()), "block": pa.array([at // BLOCK], pa.int32()),
                                                  "n": pa.array([n], pa.int64()), "copy": pa.array([flat[at:at + BLOCK].tobytes()], pa.binary())})
    return run


COPY = "learner int, block int, n long, copy binary"


def _mean(table: pa.Table) -> pa.Table:
    """Mean of some copies of one block by their row counts, in the learners' order."""
    rows = sorted(table.to_pylist(), key=lambda r: r["learner"])
    n = sum(r["n"] for r in rows)
    total = sum(np.frombuffer(r["copy"]) * (r["n"] / n) for r in rows)
    return pa.table({"learner": pa.array([rows[0]["learner"] // FAN], pa.int32()), "block": pa.array([rows[0]["block"]], pa.int32()),
                     "n": pa.array([n], pa.int64()), "copy": pa.array([total.tobytes()], pa.binary())})


def _average(copies: DataFrame, learners: int) -> DataFrame:
    while learners > 1:
        copies = copies.groupBy("block", F.floor(F.col("learner") / FAN).alias("node")).applyInArrow(_mean, COPY)
        learners = math.ceil(learners / FAN)
    return copies


def _measure(shape: Shape, given):
    def run(batches):
        parts, loss, hits, n = shape.parts(given.value), 0.0, 0, 0
        for y, ends, slots, shares in _mini_batches(batches, 1024):
            p = _softmax(_hidden(parts[0], ends, slots, shares) @ parts[1].T + parts[2])
            loss -= float(np.log(np.maximum(p[np.arange(len(y)), y], 1e-15)).sum())
            hits, n = hits + int((p.argmax(axis=1) == y).sum()), n + len(y)
        yield pa.RecordBatch.from_pydict({"loss": [loss], "hits": [hits], "n": [n]})
    return run


def start(shape: Shape, seed: int) -> np.ndarray:
    """The model before the first epoch: small random vectors, all else 0."""
    flat = np.zeros(sum(shape.sizes()))
    e, w = shape.parts(flat)[:2]
    draw = np.random.default_rng(seed)
    e[:] = draw.uniform(-1, 1, e.shape) / shape.width
    w[:] = draw.uniform(-1, 1, w.shape) / shape.width
    return flat


def train(data: DataFrame, text_col: str, label_col: str = "label", shape: Shape | None = None, seed: int = 17, epochs: int = 30,
          rate: float = 0.5, batch: int = 32, learners: int | None = None, gain: float = 1e-3, stop_after: int = 4) -> BagModel:
    """Fit on the ``train`` rows of :func:`ml.split` data.

    An epoch whose ``val`` loss isn't ``gain`` below the best so far halves the rate;
    ``stop_after`` such epochs in a row end the training, and the best epoch's model is
    returned.  Without ``val`` rows all epochs run.  ``val`` rows of a class above all trained
    ones (and above ``shape.classes``) have no probability and aren't measured.
    ``learners`` defaults to a copy per ``ROWS_PER_LEARNER`` rows, at most the cluster's cores,
    and beyond that to one per ``MOST_ROWS`` rows.
    """
    spark = data.sparkSession
    sc = spark.sparkContext
    known = data.where((F.col("split") == "train") & F.col(label_col).isNotNull()).agg(
        F.max(F.col(label_col).cast("int")).alias("top"), F.count(F.lit(1)).alias("n")).first()
    if known.top is None:
        raise ValueError("no training rows")
    shape = replace(shape or Shape(0), classes=max(known.top + 1, shape.classes if shape else 0))
    if 8 * sum(shape.sizes()) > MODEL_BYTES:
        raise ValueError(f"a model of {8 * sum(shape.sizes())} bytes is above the broadcast bound of {MODEL_BYTES}")
    learners = learners or max(1, min(sc.defaultParallelism, known.n // ROWS_PER_LEARNER), -(-known.n // MOST_ROWS))
    seen = _bag_rows(data.where(F.col("split") == "train"), text_col, label_col, shape)
    seen = durable(seen.repartition(learners, "spread").sortWithinPartitions("spread")).drop("spread").coalesce(learners)
    held = durable(_bag_rows(data.where((F.col("split") == "val") & (F.col(label_col) < shape.classes)), text_col, label_col, shape))
    model, best, misses = start(shape, seed), None, 0
    tasks = seen.rdd.getNumPartitions()
    history: list[dict] = []
    for epoch in range(epochs):
        given = sc.broadcast(model)
        copies = seen.mapInArrow(_learn(shape, given, rate, batch), COPY)
        found = {r.block: r.copy for r in _average(copies, tasks).select("block", "copy").collect()}
        given.destroy()
        model = np.concatenate([np.frombuffer(found[i]) for i in sorted(found)])
        given = sc.broadcast(model)
        told = held.mapInArrow(_measure(shape, given), "loss double, hits long, n long").agg(
            F.sum("loss").alias("loss"), F.sum("hits").alias("hits"), F.sum("n").alias("n")).first()
        given.destroy()
        if not told.n:
            history.append({"epoch": epoch, "rate": rate, "loss": None, "accuracy": None})
            continue
        loss = told.loss / told.n
        history.append({"epoch": epoch, "rate": rate, "loss": loss, "accuracy": told.hits / told.n})
        if best is None or loss < best[0] - gain:
            best, misses = (loss, model), 0
        else:
            misses, rate = misses + 1, rate / 2
            if misses == stop_after:
                break
    return BagModel(shape, best[1] if best else model, history)


# --------------------------------------------------------------- scoring ----

def predict(model: BagModel, df: DataFrame, text_col: str) -> DataFrame:
    """``category_id`` (first of the largest), ``prob`` and ``probs``, as :func:`ml.predict` gives them."""
    shape, given = model.shape, df.sparkSession.sparkContext.broadcast(model.flat[:sum(model.shape.sizes()[:3])])

    @F.pandas_udf("array<double>")
    def probs(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        table = _lower_kept()
        flat = np.concatenate([given.value, np.zeros(sum(shape.sizes()[3:]))])
        e, w, b = shape.parts(flat)[:3]
        for texts in batches:
            out = []
            for slots, shares in bags([clean_lower(t, table) for t in texts], shape.ngram, shape.slots):
                out.append(_softmax((shares @ e[slots] if len(slots) else np.zeros(shape.width))[None] @ w.T + b)[0])
            yield pd.Series(out, dtype=object)

    scored = df.withColumn("probs", probs(F.col(text_col).cast("binary")))
    return scored.withColumns({"category_id": argmax("probs"), "prob": max_prob("probs")})


def save(model: BagModel, spark: SparkSession, path: str) -> None:
    """The model as a table in the shared folder: a row per ``BLOCK`` numbers."""
    s = model.shape
    rows = [(i, model.flat[a:a + BLOCK].tobytes(), s.classes, s.slots, s.width, s.ngram) for i, a in enumerate(range(0, len(model.flat), BLOCK))]
    spark.createDataFrame(rows, "block int, copy binary, classes int, slots int, width int, ngram int").write.mode("overwrite").parquet(path)


def load(spark: SparkSession, path: str) -> BagModel:
    rows = spark.read.parquet(path).orderBy("block").collect()
    r = rows[0]
    return BagModel(Shape(r.classes, r.slots, r.width, r.ngram), np.concatenate([np.frombuffer(x.copy) for x in rows]))
