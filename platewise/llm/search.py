r"""Ranked lexical search, reversed: the items are indexed, the documents are streamed.

The items' terms make an inverted index (term -> items with multiplicities) of
bounded size: items are cut into blocks of at most ``BLOCK_BYTES`` of text and
``BLOCK_ITEMS`` items, and each block's index is broadcast.  A first pass over the
documents counts, for a block's terms, the documents that hold them, and adds up
documents and terms; its rows are combined before the shuffle.  A second pass
streams each document's term counts through the index: a batch's contributions
(documents x terms) meet the multiplicities (terms x items) and update a heap of the
``k`` best documents per item, which is all that a task returns.  The tasks' heaps
are merged per item, ``k`` rows from each task at most.

A term is a maximal run of ASCII letters and digits and of characters beyond ASCII,
A-Z in lower case.  With N documents that hold a term, L terms in all, df documents
with a term, tf occurrences in a document of n terms,

    w = floor(1000 * ln((2 N + 2) / (2 df + 1)))
    m = 75 + (25 n N) div L
    score = sum over the item's terms, with repeats, of w * ((10**9 tf) div (1000 tf + 12 m)).

Terms are looked up by fingerprint and compared by their bytes.  Contributions are
whole numbers; where a block's largest possible score is below 2**53 their sums in
doubles are exact, beyond that they are summed in 64-bit integers.

Defined cases: a NULL or termless text counts for nothing and is no hit; a document
without an id counts in N, L and df, but can't be a hit; repeated document rows are
documents of their own; item rows with one id are one item with the terms of all its
distinct texts (NULL is an id like others); items without terms have no rows; empty
tables give no rows; ids are whole numbers; only the named columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from platewise.llm.common import running_total, small_batches, stored, text_batches
from platewise.llm.text_arrays import _LOWER, byte_marks, same_bytes

BLOCK_BYTES = 8 << 20  # of items' text in one broadcast index
BLOCK_ITEMS = 2048
CELLS = 1 << 20  # documents x items, or documents x terms, scored at once
_TERM = np.zeros(256, bool)
_TERM[0x80:] = _TERM[ord("0"):ord("9") + 1] = _TERM[ord("A"):ord("Z") + 1] = _TERM[ord("a"):ord("z") + 1] = True


class Terms:
    """The terms of texts: text ``i`` has terms at[i]:at[i + 1], given by place and length in ``data``."""

    def __init__(self, texts: list[str | None]):
        raw = [(t or "").encode() for t in texts]
        self.data = _LOWER[np.frombuffer(b"\n".join([*raw, b""]), np.uint8)]
        edge = np.flatnonzero(np.diff(np.concatenate([[False], _TERM[self.data], [False]]).view(np.int8)))
        self.start, self.size = edge[0::2], edge[1::2] - edge[0::2]
        ends = np.cumsum([len(r) + 1 for r in raw], dtype=np.int64)
        self.at = np.concatenate([[0], np.searchsorted(self.start, ends)]).astype(np.int64)


class Index:
    """Inverted index over a block of items.

    ``term_of`` finds the index's number of a text's terms; term ``t`` has postings
    post_at[t]:post_at[t + 1] of (item, multiplicity).
    """

    def __init__(self, texts: list[list[str]]):
        owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
        found = Terms([t for own in texts for t in own])
        item = np.repeat(owner, np.diff(found.at)).astype(np.int64)
        words = [found.data[s:s + n].tobytes() for s, n in zip(found.start, found.size)]
        number = {w: i for i, w in enumerate(dict.fromkeys(words))}
        self.data = np.frombuffer(b"".join(number), np.uint8)
        self.size = np.array([len(w) for w in number], np.int64)
        self.start = np.cumsum(self.size) - self.size
        mark = byte_marks(self.data, self.start, self.size)
        self.order = np.argsort(mark, kind="stable")
        self.mark = mark[self.order]
        self.longest = 1  # terms that share one fingerprint
        if len(mark):
            self.longest = int(np.unique(mark, return_counts=True)[1].max())
        key, self.times = np.unique(np.array([number[w] for w in words], np.int64) * max(1, len(texts)) + item, return_counts=True)
        term, self.item = key // max(1, len(texts)), key % max(1, len(texts))
        self.post_at = np.searchsorted(term, np.arange(len(number) + 1))
        self.items = len(texts)

    def __len__(self) -> int:
        return len(self.size)

    def term_of(self, terms: Terms) -> np.ndarray:
        """Number of each term of the texts, -1 for terms that no item has."""
        out = np.full(len(terms.start), -1, np.int64)
        if not len(self) or not len(out):
            return out
        mark = byte_marks(terms.data, terms.start, terms.size)
        low = np.searchsorted(self.mark, mark)
        for step in range(self.longest):
            at = np.minimum(low + step, len(self) - 1)
            t = self.order[at]
            hit = np.flatnonzero((self.mark[at] == mark) & (self.size[t] == terms.size) & (out < 0))
            hit = hit[same_bytes(terms.data, terms.start[hit], self.data, self.start[t[hit]], terms.size[hit])]
            out[hit] = t[hit]
        return out

    def counts(self, terms: Terms) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, term, occurrences) of every indexed term in every text."""
        t = self.term_of(terms)
        some = np.flatnonzero(t >= 0)
        text = np.repeat(np.arange(len(terms.at) - 1), np.diff(terms.at))[some]
        key, tf = np.unique(text * max(1, len(self)) + t[some], return_counts=True)
        return key // max(1, len(self)), key % max(1, len(self)), tf.astype(np.int64)


class Heaps:
    """The ``k`` best (score, id) of every item, higher scores first, then smaller ids."""

    def __init__(self, items: int, k: int):
        self.k, self.items = k, items
        self.item, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))
        self.worst = np.zeros(items, np.int64)  # score that a document needs at least

    def push(self, item: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        near = np.flatnonzero(score >= np.maximum(1, self.worst[item]))
        if not len(near):
            return
        item, score, ids = (np.concatenate([a, b[near]]) for a, b in ((self.item, item), (self.score, score), (self.id, ids)))
        order = np.lexsort((ids, -score, item))
        item, score, ids = item[order], score[order], ids[order]
        place = np.arange(len(item)) - np.searchsorted(item, item)
        keep = place < self.k
        self.item, self.score, self.id = item[keep], score[keep], ids[keep]
        last = place == self.k - 1
        self.worst[item[last]] = score[last]


def _score_batch(index: Index, weight: np.ndarray, exact: bool, terms: Terms, ids: np.ndarray, known: np.ndarray,
                 n_docs: int, n_terms: int, heaps: Heaps) -> None:
    text, term, tf = index.counts(terms)
    n = np.diff(terms.at)
    m = 75 + (25 * n * n_docs) // max(1, n_terms)
    part = weight[term] * ((10**9 * tf) // (1000 * tf + 12 * m[text]))
    use = known[text] & (part > 0)
    text, term, part = text[use], term[use], part[use]
    docs, row = np.unique(text, return_inverse=True)
    step = max(1, CELLS // max(1, index.items))
    for at in range(0, len(docs), step):
        own = slice(*np.searchsorted(row, [at, min(len(docs), at + step)]))
        here, cols = row[own] - at, term[own]
        size = min(len(docs), at + step) - at
        total = _scores(index, here, cols, part[own], size, exact)
        i, j = np.nonzero(total >= np.maximum(1, heaps.worst)[None, :])
        heaps.push(j, total[i, j].astype(np.int64), ids[docs[at + i]])


def _scores(index: Index, row: np.ndarray, term: np.ndarray, part: np.ndarray, size: int, exact: bool) -> np.ndarray:
    """(size, items) sums of a block of documents.  Terms that many items have go through a
    matrix product, the others through their postings."""
    many = np.diff(index.post_at)
    total = np.zeros((size, index.items), np.float64 if exact else np.int64)
    wide = many[term] * 8 > index.items if exact else np.zeros(len(term), bool)
    terms, col = np.unique(term[wide], return_inverse=True)
    at_once = max(1, CELLS // max(size, index.items))
    for at in range(0, len(terms), at_once):
        own = terms[at:at + at_once]
        here = (col >= at) & (col < at + at_once)
        left = np.zeros((size, len(own)))
        left[row[wide][here], col[here] - at] = part[wide][here]
        right = np.zeros((len(own), index.items))
        for c, t in enumerate(own):
            p = slice(index.post_at[t], index.post_at[t + 1])
            right[c, index.item[p]] = index.times[p]
        total += left @ right
    row, term, part = row[~wide], term[~wide], part[~wide]
    reach = np.cumsum(many[term])
    for lo, hi in _cuts(reach, CELLS):
        n = many[term[lo:hi]]
        p = np.repeat(index.post_at[term[lo:hi]] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        np.add.at(total, (np.repeat(row[lo:hi], n), index.item[p]), np.repeat(part[lo:hi], n) * index.times[p])
    return total


def _cuts(reach: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of about ``most`` postings each."""
    at = 0
    while at < len(reach):
        end = max(at + 1, int(np.searchsorted(reach, (reach[at - 1] if at else 0) + most, side="right")))
        yield at, end
        at = end


def _blocks(items: DataFrame) -> DataFrame:
    """(item, texts, block): one row per item, in blocks of bounded bytes and number."""
    one = items.distinct().groupBy("item").agg(F.collect_list("text").alias("texts"))
    size = F.aggregate("texts", F.lit(0).cast("long"), lambda a, t: a + F.octet_length(t))
    one = stored(one.withColumn("_none", F.col("item").isNull()), "items")
    cost = F.greatest(size, F.lit(BLOCK_BYTES // BLOCK_ITEMS))
    placed = running_total(one, [], ["_none", "item"], cost, "_before")
    return stored(placed.select("item", "texts", F.floor(F.col("_before") / BLOCK_BYTES).alias("block")), "blocks")


def search(items: DataFrame, docs: DataFrame, k: int = 20, item_col: str = "item_id", item_text: str = "text",
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(item, rank, id, score): each item's ``k`` best documents with a score above 0."""
    spark = docs.sparkSession
    text_batches(spark)
    blocks = _blocks(items.select(F.col(item_col).alias("item"), F.coalesce(F.col(item_text), F.lit("")).alias("text")))
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    out = None
    for block in sorted(r.block for r in blocks.select("block").distinct().collect()):
        # a block holds BLOCK_BYTES of text at most, or one item
        own = sorted(blocks.where(F.col("block") == block).select("item", "texts").collect(), key=lambda r: (r.item is None, r.item))
        found = _search_block(spark, [r.item for r in own], [r.texts for r in own], src, k)
        out = found if out is None else out.unionByName(found)
    kind = items.select(item_col).schema[0].dataType
    if out is None:
        out = spark.createDataFrame([], "item long, id long, score long")
    best = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("id").asc())
    ranked = out.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select(F.col("item").cast(kind).alias(item_col), F.col("rank").cast("int").alias("rank"),
                         F.col("id").cast(docs.schema[id_col].dataType).alias(id_col), "score")


def _search_block(spark, names: list, texts: list[list[str]], src: DataFrame, k: int) -> DataFrame:
    index = spark.sparkContext.broadcast(Index(texts))

    def count(batches):
        df, docs, terms = np.zeros(len(index.value), np.int64), 0, 0
        for b in small_batches(batches):
            found = Terms(b.column(1).to_pylist())
            n = np.diff(found.at)
            docs, terms = docs + int((n > 0).sum()), terms + int(n.sum())
            df += np.bincount(index.value.counts(found)[1], minlength=len(df))
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([[-2, -1], some])), pa.array(np.concatenate([[docs, terms], df[some]]))], ["term", "n"])

    # a row per term of the index, and two more: as many as were broadcast
    counted = dict(src.select("id", "text").mapInArrow(count, "term bigint, n bigint").groupBy("term").agg(F.sum("n")).collect())
    n_docs, n_terms = counted.get(-2, 0), counted.get(-1, 0)
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * counted.get(t, 0) + 1))) for t in range(len(index.value))], np.int64)
    weight[[t for t in range(len(weight)) if not counted.get(t)]] = 0
    # a term adds at most w * 10**6 for each of its occurrences in the item
    own = index.value
    top = np.bincount(own.item, np.repeat(weight, np.diff(own.post_at)) * own.times * 1e6, own.items).max() if len(own.item) else 0
    exact = bool(top < 1 << 53)
    weights = spark.sparkContext.broadcast(weight)

    def rank(batches):
        heaps = Heaps(index.value.items, k)
        for b in small_batches(batches):
            ids = b.column(0)
            _score_batch(index.value, weights.value, exact, Terms(b.column(1).to_pylist()), ids.fill_null(0).to_numpy(zero_copy_only=False),
                         ids.is_valid().to_numpy(zero_copy_only=False), n_docs, n_terms, heaps)
        yield pa.RecordBatch.from_arrays([pa.array([names[i] for i in heaps.item], pa.int64()), pa.array(heaps.id), pa.array(heaps.score)], ["item", "id", "score"])

    return src.mapInArrow(rank, "item bigint, id bigint, score bigint")


def oracle(k: int = 20) -> str:
    """The query's rows in DuckDB SQL over ``documents`` and ``benchmark``."""
    term = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"""
WITH i AS (SELECT item_id, unnest(regexp_extract_all({lower}, '{term}')) AS term FROM (SELECT DISTINCT item_id, text FROM benchmark)),
q AS (SELECT item_id, term, count(*)::BIGINT AS times FROM i GROUP BY ALL),
d AS (SELECT doc_id, ts, len(ts)::BIGINT AS n FROM (SELECT doc_id, regexp_extract_all({lower}, '{term}') AS ts FROM documents)),
c AS (SELECT count(*) FILTER (n > 0)::BIGINT AS nd, sum(n)::BIGINT AS nt FROM d),
t AS (SELECT doc_id, term, count(*)::BIGINT AS tf FROM (SELECT doc_id, unnest(ts) AS term FROM d)
      WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
      FROM (SELECT term, count(*)::BIGINT AS df FROM t GROUP BY term), c),
s AS (
  SELECT item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * nd) // nt))))::BIGINT AS score
  FROM q JOIN w USING (term) JOIN t USING (term) JOIN d USING (doc_id), c GROUP BY ALL)
SELECT item_id, rank::INT AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
WHERE rank <= {k}"""
