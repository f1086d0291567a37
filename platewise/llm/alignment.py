"""Cross-tokenizer alignment by inverted pair bitmaps.

Tokenizer A is a byte-level BPE file, B a sentencepiece BPE model.  Both are run
over a text with one space in front; byte offsets where a token of A and one of B
end cut the tokens into groups, and the two tokens that end there are linked.

What counts links is an index from pairs (id of A, id of B) to documents.  A task
numbers its documents in chunks of at most ``CHUNK_DOCS`` documents and about
``CHUNK_POSTINGS`` postings, and writes for every pair of a chunk compressed bitmaps
of its documents, one per multiplicity plane: plane k has the documents whose number
of links of the pair has bit k.  A bitmap is a sorted array of 16-bit document
numbers or, where that is smaller, plain bits.  The planes' OR is the pair's document
bitmap, whose popcount is its document count; the planes' popcounts times 2**k are
its link count.  Both are added up over chunks before the shuffle, so a pair that
every document holds costs a row per chunk.  The postings then return the scores: a
pair's link count, and whether it is the highest of its B id, meet the pair's
bitmaps, and each chunk adds them up for its documents.  A chunk is bounded, so no
group grows with the corpus, and lists of pairs per document are never stored.

B's pieces never hold a space behind another character, nor a line end beside
anything, which is checked when the model is loaded; so a text is cut there, and
pieces are encoded once and remembered with their bytes.

Defined cases: a text that is NULL, empty, or whose tokens don't spell space + text
(as one that holds U+2581) has no tokens; the strings of special tokens are plain text;
equal rows and rows that share an id, or have none, are documents of their own; an
empty table gives no rows; only the named columns are read.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platewise.llm.bpe import PieceRows, merge_table, spread
from platewise.llm.common import small_batches, stored, text_batches

CHUNK_DOCS = 1 << 16
CHUNK_POSTINGS = 1 << 20
B_IDS = 1 << 31  # a pair is a * B_IDS + b


class PieceModel(PieceRows):
    """Ids and bytes of a sentencepiece BPE model with byte fallback."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.space = self.model.piece_to_id("▁")
        self.bytes_of = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        plain = [p for i, p in enumerate(pieces) if not (self.model.is_byte(i) or self.model.is_control(i) or self.model.is_unknown(i))]
        if any("▁" in p.lstrip("▁") or ("\n" in p and p != "\n") for p in plain) or self.model.encode("a") != [self.model.piece_to_id("▁a")]:
            raise ValueError("the model has pieces across spaces or line ends, or puts no space in front")
        self.byte_len = np.array([len(b) for b in self.bytes_of], np.int64)
        self.byte_at = np.cumsum(self.byte_len) - self.byte_len
        self.byte_flat = np.frombuffer(b"".join(self.bytes_of), np.uint8)
        self._forget()

    def _pieces(self, pieces: list[str]) -> list[list[int]]:
        """Ids of pieces alone; the library puts a space in front, which takes the place of the
        piece's own or never joins the line end behind it."""
        spaced = [p[0] == " " for p in pieces]
        ids = self.model.encode([p[1:] if s else p for p, s in zip(pieces, spaced)], num_threads=1)
        return [[self.space] if p == " " else i if s else i[1:] for p, s, i in zip(pieces, spaced, ids)]

    def encode_short(self, data: np.ndarray, at: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        flat = data.tobytes()
        ids = self._pieces([flat[a:a + n].decode() for a, n in zip(at.tolist(), length.tolist())])
        n = np.array([len(own) for own in ids], np.int64)
        return np.fromiter((i for own in ids for i in own), np.int32, int(n.sum())), n

    def encode_long(self, piece: bytes) -> np.ndarray:
        return np.array(self._pieces([piece.decode()])[0], np.int32)

    def encode_batch(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids of each text) of texts with a space in front, which lie one behind the other."""
        first = np.zeros(len(data), bool)
        first[np.append(0, ends[:-1])] = True
        before = np.append(np.uint8(0), data[:-1])
        start = np.flatnonzero(first | (data == 10) | ((data == 32) & (before != 32)))
        length = np.diff(np.append(start, len(data)))
        row = self.rows(data, start, length)
        n = self.row_n[row]
        return self.row_ids[spread(self.row_at[row], n)], np.diff(np.append(0, np.cumsum(n)[np.searchsorted(start, ends) - 1]))


@lru_cache(maxsize=2)
def piece_model(path: str) -> PieceModel:
    return PieceModel(path)


def _decimal(most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text "<i>," of every number below ``most``: bytes, place, length."""
    text = [b"%d," % i for i in range(most)]
    size = np.array([len(t) for t in text], np.int64)
    return np.frombuffer(b"".join(text), np.uint8), np.cumsum(size) - size, size


class Aligner:
    """Aligns batches of texts."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = merge_table(path_a, False), piece_model(path_b)
        self.digits, self.digit_at, self.digit_n = _decimal(max(len(self.a.byte_len), len(self.b.byte_len)))

    def align(self, texts: list[str | None]):
        """Per text: tokens of A and of B, groups, and SHA-256 of the groups' text ('' without
        tokens); then the links as (text, id of A, id of B)."""
        marked = "▁"
        spaced = [" " + t if t and marked not in t else "" for t in texts]
        raw = [t.encode() for t in spaced]
        some = [i for i, r in enumerate(raw) if r]
        counts = np.zeros((len(texts), 3), np.int64)
        digest = [""] * len(texts)
        none = np.zeros(0, np.int64)
        if not some:
            return counts, digest, (none, none, none)
        data = np.frombuffer(b"".join(raw), np.uint8)
        ends = np.cumsum([len(raw[i]) for i in some])
        each = self.a.encode_batch([spaced[i] for i in some])
        ids_a, n_a = np.concatenate(each), np.array([len(x) for x in each])
        ids_b, n_b = self.b.encode_batch(data, ends)
        ids_a, n_a = self._spelled(self.a, ids_a, n_a, data, ends)
        ids_b, n_b = self._spelled(self.b, ids_b, n_b, data, ends)
        both = (n_a > 0) & (n_b > 0)
        ids_a, ids_b = ids_a[np.repeat(both, n_a)], ids_b[np.repeat(both, n_b)]
        n_a, n_b = n_a * both, n_b * both
        size = np.diff(np.append(0, ends)) * both
        # ends of tokens, counted over the texts that have tokens
        end_a, end_b = np.cumsum(self.a.byte_len[ids_a]), np.cumsum(self.b.byte_len[ids_b])
        at_b = np.searchsorted(end_b, end_a)
        last_a = np.flatnonzero(end_b[np.minimum(at_b, len(end_b) - 1)] == end_a) if len(end_b) else none
        last_b = at_b[last_a]
        text = np.searchsorted(np.cumsum(size), end_a[last_a])
        counts[some] = np.stack([n_a, n_b, np.bincount(text, minlength=len(some))], 1)
        for i, d in zip(some, self._digests(ids_a, ids_b, last_a, last_b, text, len(some))):
            digest[i] = d
        return counts, digest, (np.array(some)[text], ids_a[last_a].astype(np.int64), ids_b[last_b].astype(np.int64))

    def _spelled(self, table, ids: np.ndarray, n: np.ndarray, data: np.ndarray, ends: np.ndarray):
        """Ids without those of texts that they don't spell."""
        size = np.bincount(np.repeat(np.arange(len(n)), n), table.byte_len[ids], len(n)).astype(np.int64)
        right = size == np.diff(np.append(0, ends))
        keep = np.repeat(right, n)
        made = table.byte_flat[spread(table.byte_at[ids[keep]], table.byte_len[ids[keep]])]
        there = data[np.repeat(right, np.diff(np.append(0, ends)))]
        owner = np.repeat(np.flatnonzero(right), size[right])
        right[owner[made != there]] = False
        return ids[np.repeat(right, n)], n * right

    def _digests(self, ids_a, ids_b, last_a, last_b, text, texts: int) -> list[str]:
        group_a = np.searchsorted(last_a, np.arange(len(ids_a)))
        group_b = np.searchsorted(last_b, np.arange(len(ids_b)))
        # groups one behind the other, A's tokens before B's
        to_a = np.arange(len(ids_a)) + np.append(-1, last_b)[group_a] + 1
        to_b = np.arange(len(ids_b)) + last_a[group_b] + 1
        order = np.empty(len(ids_a) + len(ids_b), np.int64)
        order[to_a], order[to_b] = ids_a, ids_b
        n = self.digit_n[order]
        out = self.digits[spread(self.digit_at[order], n)]
        stop = np.cumsum(n)
        out[stop[to_a[last_a]] - 1] = ord("|")
        out[stop[to_b[last_b]] - 1] = ord(";")
        final = np.searchsorted(text, np.arange(texts), side="right")  # groups up to each text's end
        cut = np.append(0, stop[to_b[last_b]])[final] if len(last_b) else np.zeros(texts, np.int64)
        done, at = [], 0
        for c in cut.tolist():
            done.append(hashlib.sha256(out[at:c - 1].tobytes()).hexdigest() if c > at else "")
            at = c
        return done


def _planes(pair: np.ndarray, doc: np.ndarray, times: np.ndarray, docs: int) -> pa.RecordBatch:
    """Rows (pair, plane, docs, dense, bits) of one chunk's postings, sorted by pair and document;
    ``docs`` is the popcount of the pair's document bitmap, stated with its lowest plane."""
    out, told = [], np.zeros(0, np.int64)
    pairs, held = np.unique(pair, return_counts=True)
    plane = 0
    while (times >> plane).any():
        own = np.flatnonzero(times >> plane & 1)
        p, at, n = np.unique(pair[own], return_index=True, return_counts=True)
        low = doc[own].astype("<u2")
        bits = pa.BinaryArray.from_buffers(pa.binary(), len(p), [None, pa.py_buffer((np.append(at, len(own)) * 2).astype(np.int32)), pa.py_buffer(low)])
        dense = n * 16 > docs
        if dense.any():
            bits = bits.to_pylist()
            for i in np.flatnonzero(dense):
                flag = np.zeros(docs, bool)
                flag[low[at[i]:at[i] + n[i]]] = True
                bits[i] = np.packbits(flag).tobytes()
            bits = pa.array(bits, pa.binary())
        new = ~np.isin(p, told)
        told = np.union1d(told, p)
        out.append(pa.RecordBatch.from_arrays(
            [pa.array(p), pa.array(np.full(len(p), plane, np.int32)), pa.array(np.where(new, held[np.searchsorted(pairs, p)], 0)),
             pa.array(n.astype(np.int64) << plane), pa.array(dense), bits], ["pair", "plane", "docs", "links", "dense", "bits"]))
        plane += 1
    return pa.Table.from_batches(out).combine_chunks().to_batches()[0]


def _members(dense: bool, bits: bytes, docs: int) -> np.ndarray:
    """Document numbers of a bitmap."""
    if dense:
        return np.flatnonzero(np.unpackbits(np.frombuffer(bits, np.uint8), count=docs))
    return np.frombuffer(bits, "<u2").astype(np.int64)


def index_documents(df: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The stored inverted index: rows with a ``pair`` are bitmaps (chunk, pair, plane, docs, links,
    dense, bits), the others documents (chunk, doc, id, n_a, n_b, n_groups, groups_sha256)."""
    text_batches(df.sparkSession)
    src = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = src.schema["id"].dataType.simpleString()
    names = ["chunk", "chunk_docs", "doc", "id", "n_a", "n_b", "n_groups", "groups_sha256", "pair", "plane", "docs", "links", "dense", "bits"]
    shape = (f"chunk bigint, chunk_docs int, doc int, id {kind}, n_a bigint, n_b bigint, n_groups bigint, groups_sha256 string, "
             "pair bigint, plane int, docs bigint, links bigint, dense boolean, bits binary")

    def run(batches):
        aligner, task, chunk = Aligner(path_a, path_b), TaskContext.get().partitionId(), 0
        docs, held, parts = 0, 0, []

        def row(rows: int, **columns) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(rows, f.type)) for f in schema], names)

        def close():
            nonlocal docs, held, parts, chunk
            if parts:
                pair, doc, times = (np.concatenate([p[k] for p in parts]) for k in range(3))
                order = np.lexsort((doc, pair))
                b = _planes(pair[order], doc[order], times[order], docs)
                fixed = {"chunk": pa.array(np.full(b.num_rows, task << 24 | chunk)), "chunk_docs": pa.array(np.full(b.num_rows, docs, np.int32))}
                whole = row(b.num_rows, **fixed, **{n: b.column(n) for n in b.schema.names})
                for at in range(0, whole.num_rows, 1 << 14):
                    yield whole.slice(at, 1 << 14)
            docs, held, parts, chunk = 0, 0, [], chunk + 1

        schema = None
        for b in (part.slice(at, CHUNK_DOCS // 2) for part in small_batches(batches) for at in range(0, part.num_rows, CHUNK_DOCS // 2)):
            if schema is None:
                types = {"id": b.schema.types[0], "chunk_docs": pa.int32(), "doc": pa.int32(), "plane": pa.int32(), "dense": pa.bool_(),
                         "bits": pa.binary(), "groups_sha256": pa.string()}
                schema = pa.schema([(n, types.get(n, pa.int64())) for n in names])
            if docs + b.num_rows > CHUNK_DOCS or held >= CHUNK_POSTINGS:
                yield from close()
            counts, digest, (text, a, other) = aligner.align(b.column(1).to_pylist())
            n = b.num_rows
            yield row(n, chunk=pa.array(np.full(n, task << 24 | chunk)), doc=pa.array(np.arange(docs, docs + n, dtype=np.int32)), id=b.column(0),
                      n_a=pa.array(counts[:, 0]), n_b=pa.array(counts[:, 1]), n_groups=pa.array(counts[:, 2]), groups_sha256=pa.array(digest, pa.string()))
            order = np.lexsort((a * B_IDS + other, text))
            pair, text = (a * B_IDS + other)[order], text[order]
            new = np.flatnonzero(np.append(True, (pair[1:] != pair[:-1]) | (text[1:] != text[:-1]))) if len(pair) else np.zeros(0, np.int64)
            if len(new):
                parts.append((pair[new], docs + text[new], np.diff(np.append(new, len(pair)))))
            docs, held = docs + n, held + len(new)
        yield from close()

    return stored(src.mapInArrow(run, shape), "pair-index")


def pair_scores(index: DataFrame) -> DataFrame:
    """(a, b, docs, links, best): documents and links of every pair, and whether no other id
    of A has more links with this id of B."""
    pairs = index.where("pair IS NOT NULL").groupBy("pair").agg(F.sum("docs").alias("docs"), F.sum("links").alias("links"))
    pairs = pairs.select(F.shiftright("pair", 31).alias("a"), F.col("pair").bitwiseAND(B_IDS - 1).alias("b"), "docs", "links")
    pairs = stored(pairs, "pairs")
    top = pairs.groupBy("b").agg(F.max("links").alias("_top")).withColumnRenamed("b", "_b")
    return stored(pairs.join(top, F.col("b") == F.col("_b")).select("a", "b", "docs", "links", (F.col("links") == F.col("_top")).alias("best")), "pair-scores")


def document_scores(index: DataFrame, scores: DataFrame) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every document."""
    score = scores.select((F.col("a") * F.lit(B_IDS) + F.col("b")).alias("_pair"), F.col("links").alias("count"), "best")
    maps = index.where("pair IS NOT NULL").select("chunk", "chunk_docs", "pair", "plane", "dense", "bits")
    met = maps.join(score, F.col("pair") == F.col("_pair")).select("chunk", "chunk_docs", "plane", "dense", "bits", "count", "best")

    def add_up(table: pa.Table) -> pa.Table:
        docs = table["chunk_docs"][0].as_py()
        total, best, links = (np.zeros(docs, np.int64) for _ in range(3))
        dense = table["dense"].to_numpy()
        times = np.int64(1) << table["plane"].to_numpy().astype(np.int64)
        count, top = table["count"].to_numpy(), table["best"].to_numpy().astype(np.int64)
        bits = table["bits"].to_pylist()
        some = np.flatnonzero(~dense)
        low = np.frombuffer(b"".join([bits[i] for i in some]), "<u2").astype(np.int64)
        owner = np.repeat(some, [len(bits[i]) // 2 for i in some])
        np.add.at(total, low, (times * count)[owner])
        np.add.at(best, low, (times * top)[owner])
        np.add.at(links, low, times[owner])
        for i in np.flatnonzero(dense):
            low = _members(True, bits[i], docs)
            total[low] += times[i] * count[i]
            best[low] += times[i] * top[i]
            links[low] += times[i]
        return pa.table({"chunk": pa.array(np.full(docs, table["chunk"][0].as_py())), "doc": pa.array(np.arange(docs, dtype=np.int32)),
                         "n_links": pa.array(links), "n_best": pa.array(best), "count_sum": pa.array(total)})

    # a chunk has a bounded number of documents and postings
    sums = met.groupBy("chunk").applyInArrow(add_up, "chunk bigint, doc int, n_links bigint, n_best bigint, count_sum bigint")
    sums = sums.select(F.col("chunk").alias("_chunk"), F.col("doc").alias("_doc"), "n_links", "n_best", "count_sum")
    docs = index.where("pair IS NULL").select("chunk", "doc", "id", "n_a", "n_b", "n_groups", "groups_sha256")
    out = docs.join(sums, (F.col("chunk") == F.col("_chunk")) & (F.col("doc") == F.col("_doc")), "left")
    return out.select("id", "n_a", "n_b", "n_groups", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_links", "n_best", "count_sum")],
                      "groups_sha256")


def align_documents(df: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document with its counts and scores; the parts are :func:`index_documents`,
    :func:`pair_scores` and :func:`document_scores`."""
    index = index_documents(df, path_a, path_b, id_col, text_col)
    return document_scores(index, pair_scores(index)).withColumnRenamed("id", id_col)
