"""Quality classifier: a generalised additive model with pairwise interactions.

Each feature of a text is binned; the model is one look-up table per feature and
one per chosen pair of features, learned by cyclic boosting: round after round
every feature in turn gets a shallow tree (at most four leaves) on the gradient
of the log loss, added to its table with a small step.  Then the pairs whose
four-quadrant trees lower the loss most are boosted in the same way.  A score is
the logistic of a sum of table entries, so scoring is a few vectorised
additions.  The fit sees at most ``max_rows`` labelled rows (the first ones by
a hash of their id, a documented bound); every row is scored.

Defined cases: a NULL text is empty and gets a score like any other; NULL labels
are not used; several labels of an id count by their mean; with labels of one
kind only the score is constant (1.0 without any label); equal rows get equal
scores; an empty table gives no rows; all columns of the input are kept as they
are.
"""

from __future__ import annotations

import dataclasses

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platewise.llm.common import small_batches, text_batches
from platewise.llm.text_arrays import Words, byte_marks

FEATURES = ("log_words", "chars_per_word", "longest_word", "upper", "digits", "symbols", "exclamation", "bars",
            "other_marks", "wide", "distinct_words", "adjacent_repeats", "repeated_bigrams", "words_per_line",
            "repeated_lines", "sentence_ends")
SYMBOLS = b"#*$%&<>"  # counted as such


def _is(members: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(members)] = True
    return out


_KINDS = [_is(bytes(range(65, 91))), _is(b"0123456789"), _is(SYMBOLS), _is(b"!"), _is(b"|"), _is(b"\"'()[]{}:;=+-_/\\@^~`?"),
          _is(bytes(range(0xC0, 0x100))), _is(b".")]


def _distinct(group: np.ndarray, mark: np.ndarray, n: int) -> np.ndarray:
    """Number of distinct marks of each group 0..n-1."""
    order = np.lexsort((mark, group))
    g, m = group[order], mark[order]
    new = np.ones(len(g), bool)
    new[1:] = (g[1:] != g[:-1]) | (m[1:] != m[:-1])
    return np.bincount(g[new], minlength=n)


def features(texts: list[str | None]) -> np.ndarray:
    """(texts, FEATURES) matrix."""
    n, w = len(texts), Words(texts)
    words = np.diff(w.at)
    some, doc = np.maximum(words, 1), np.repeat(np.arange(n), words)
    per_text = lambda flag: np.diff(np.append(0, np.cumsum(flag)[w.ends - 1])) if n else np.zeros(0)
    lead = per_text((w.data & 0xC0) != 0x80) - 1  # code points; each text is followed by a line end
    share = [per_text(kind[w.data]) / np.maximum(lead, 1) for kind in _KINDS]
    size = w.end - w.start
    longest = np.zeros(n)
    np.maximum.at(longest, doc, size)
    same = np.append(False, (w.mark[1:] == w.mark[:-1]) & (doc[1:] == doc[:-1]))[:len(doc)]
    pair, offset = w.windows(2)
    pairs = np.diff(offset)
    line_end = np.flatnonzero(w.data == 10)
    line_start = np.append(0, line_end[:-1] + 1)
    line_doc = np.searchsorted(w.ends, line_end, side="right")
    full = line_end > line_start
    line_doc, lines = line_doc[full], np.bincount(line_doc[full], minlength=n)
    line = byte_marks(w.data, line_start[full], (line_end - line_start)[full])
    return np.column_stack([
        np.log1p(words), np.minimum(lead / some, 1e4), np.minimum(longest, 1e4), *share[:7],
        _distinct(doc, w.mark, n) / some, np.bincount(doc, same, n) / some,
        (pairs - _distinct(np.repeat(np.arange(n), pairs), pair, n)) / np.maximum(pairs, 1),
        words / np.maximum(lines, 1), (lines - _distinct(line_doc, line, n)) / np.maximum(lines, 1), share[7] * lead / some])


@dataclasses.dataclass
class Model:
    """Tables of an additive model; ``edges[f]`` are the upper bin borders of feature f."""

    base: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int, np.ndarray]]

    def bins(self, x: np.ndarray) -> list[np.ndarray]:
        return [np.searchsorted(e, x[:, f]) for f, e in enumerate(self.edges)]

    def score(self, x: np.ndarray) -> np.ndarray:
        b = self.bins(x)
        z = np.full(len(x), self.base)
        for f, t in enumerate(self.tables):
            z += t[b[f]]
        for f, g, t in self.pairs:
            z += t[b[f], b[g]]
        return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def _leaf(g, h, l2: float):
    return g / (h + l2)


def _shallow_tree(g: np.ndarray, h: np.ndarray, l2: float, leaves: int = 4) -> np.ndarray:
    """Leaf value per bin of a tree over ordered bins, grown by the best split."""
    spans = [(0, len(g))]
    gain_of = lambda a, b: g[a:b].sum() ** 2 / (h[a:b].sum() + l2)
    while len(spans) < leaves:
        best = (1e-9, None, 0)
        for a, b in spans:
            if b - a < 2:
                continue
            left_g, left_h = np.cumsum(g[a:b])[:-1], np.cumsum(h[a:b])[:-1]
            right_g, right_h = g[a:b].sum() - left_g, h[a:b].sum() - left_h
            gain = left_g ** 2 / (left_h + l2) + right_g ** 2 / (right_h + l2) - gain_of(a, b)
            k = int(gain.argmax())
            if gain[k] > best[0]:
                best = (gain[k], (a, b), a + k + 1)
        if best[1] is None:
            break
        a, b = best[1]
        spans.remove((a, b))
        spans += [(a, best[2]), (best[2], b)]
    out = np.zeros(len(g))
    for a, b in spans:
        out[a:b] = _leaf(g[a:b].sum(), h[a:b].sum(), l2)
    return out


def _quadrants(g: np.ndarray, h: np.ndarray, l2: float) -> tuple[float, np.ndarray]:
    """Best four-leaf tree that cuts both features once: (gain, values per cell)."""
    cg, ch = (np.pad(m.cumsum(0).cumsum(1), ((1, 0), (1, 0))) for m in (g, h))
    rows, cols = np.arange(1, g.shape[0]), np.arange(1, g.shape[1])
    part = lambda c: (c[np.ix_(rows, cols)], c[rows][:, -1:] - c[np.ix_(rows, cols)], c[-1:, cols] - c[np.ix_(rows, cols)],
                      c[-1, -1] - c[rows][:, -1:] - c[-1:, cols] + c[np.ix_(rows, cols)])
    if not len(rows) or not len(cols):
        return 0.0, np.zeros_like(g)
    gain = sum(a * a / (b + l2) for a, b in zip(part(cg), part(ch)))
    i, j = np.unravel_index(gain.argmax(), gain.shape)
    out, a, b = np.zeros_like(g), i + 1, j + 1
    for r in (slice(0, a), slice(a, None)):
        for c in (slice(0, b), slice(b, None)):
            out[r, c] = _leaf(g[r, c].sum(), h[r, c].sum(), l2)
    return float(gain.max()), out


def fit(x: np.ndarray, y: np.ndarray, bins: int = 48, rounds: int = 120, pair_rounds: int = 40, pairs: int = 6,
        step: float = 0.15, l2: float = 2.0) -> Model:
    """Cyclic boosting of per-feature tables, then of tables of the strongest pairs."""
    n, k = x.shape
    share = float(y.mean()) if n else 1.0
    if share in (0.0, 1.0):
        return Model(50.0 if share else -50.0, [np.zeros(0)] * k, [np.zeros(1)] * k, [])
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(k)]
    model = Model(float(np.log(share / (1 - share))), edges, [np.zeros(len(e) + 1) for e in edges], [])
    b, z = model.bins(x), np.full(n, model.base)
    for _ in range(rounds):
        for f, table in enumerate(model.tables):
            p = 1 / (1 + np.exp(-z))
            g, h = (np.bincount(b[f], v, len(table)) for v in (y - p, p * (1 - p)))
            tree = step * _shallow_tree(g, h, l2)
            table += tree
            z += tree[b[f]]

    def cells(f: int, g: int):
        p = 1 / (1 + np.exp(-z))
        shape = (len(model.tables[f]), len(model.tables[g]))
        at = b[f] * shape[1] + b[g]
        return [np.bincount(at, v, shape[0] * shape[1]).reshape(shape) for v in (y - p, p * (1 - p))]

    gains = sorted(((_quadrants(*cells(f, g), l2)[0], f, g) for f in range(k) for g in range(f)), reverse=True)
    model.pairs = [(f, g, np.zeros((len(model.tables[f]), len(model.tables[g])))) for _, f, g in gains[:pairs]]
    for _ in range(pair_rounds):
        for f, g, table in model.pairs:
            tree = step * _quadrants(*cells(f, g), l2)[1]
            table += tree
            z += tree[b[f], b[g]]
    return model


def held_out(id_col: str) -> Column:
    """Rows that no fit may use: crc32 of the id as text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
          max_rows: int = 20_000) -> Model:
    """Fit on at most ``max_rows`` labelled rows that are not held out."""
    text_batches(docs.sparkSession)
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(id_col))
    known = known.groupBy(F.col(id_col).alias("_id")).agg(F.avg(F.col(label_col).cast("double")).alias("_y"))
    chosen = known.orderBy(F.xxhash64("_id"), "_id").limit(max_rows).toArrow()
    # the sample is bounded by max_rows, so its ids may be broadcast; a list would pass through Python workers of its own
    sample = docs.sparkSession.createDataFrame(chosen, known.schema)
    rows = docs.select(F.col(id_col).alias("_k"), F.col(text_col).alias("_t")).join(F.broadcast(sample), F.col("_k") == F.col("_id"))

    def run(batches):
        for b in small_batches(batches):
            x = features(b.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(list(x), pa.list_(pa.float64())), b.column(1), b.column(2)], ["x", "y", "id"])

    kind = docs.schema[id_col].dataType.simpleString()
    got = rows.select("_t", "_y", "_id").mapInArrow(run, f"x array<double>, y double, id {kind}").collect()
    got.sort(key=lambda r: (r.id, r.x))
    x = np.array([r.x for r in got]).reshape(len(got), len(FEATURES))
    return fit(x, (np.array([r.y for r in got]) >= 0.5).astype(float))


def score(docs: DataFrame, model: Model, text_col: str = "text", out: str = "quality_score") -> DataFrame:
    """All columns of ``docs`` and the score (0 to 1) of each whole text."""
    text_batches(docs.sparkSession)
    names = [c for c in docs.columns if c != out]
    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != out)

    def run(batches):
        for b in small_batches(batches):
            s = model.score(features(b.column(names.index(text_col)).to_pylist()))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(s, pa.float64())], [*names, out])

    return docs.select(*names).mapInArrow(run, f"{shape}, `{out}` double")
