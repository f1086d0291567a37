"""BPE encoding and decoding with a bounded-lookahead streaming transducer.

A merge list decides, for every boundary between two bytes, whether some merge
removes it.  Merge ``j`` = (u, v) removes a boundary only if ``v`` stands right
of it, that is if the boundary behind ``v`` still stands; that one can only have
been removed by an earlier merge whose left operand is ``v`` or a token on
``v``'s right spine (its right child, that one's right child, ...).  So

    reach(j) = |v| + max{reach(k) : k < j, left(k) on the right spine of v}

bytes behind a boundary decide its fate, and ``max reach`` is a sufficient
lookahead of the whole list (:class:`MergeTable.lookahead`, 793 bytes for the
50k byte vocabulary).  The encoder reads text block by block.  Inside a long
piece it emits every token that ends at least that far before the end of its
window and restarts behind the last one, so its memory is one window whatever
the length of the piece; short pieces are windows of their own and are merged
many at a time, and a bounded table remembers them with their bytes.  The decoder maps ids to
bytes and feeds them to an incremental UTF-8 state machine.

Defined cases: a NULL text is empty; an empty text has no ids and decodes to the
empty text; the strings of added tokens inside a text become their ids, as the
vocabulary file says; ids outside the vocabulary are skipped when decoding;
bytes that are no UTF-8 decode to U+FFFD.  Repeated rows stay repeated rows, and
only the named columns are read, so further columns may have any name.
"""

from __future__ import annotations

import codecs
import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platewise.llm.common import small_batches, text_batches
from platewise.llm.text_arrays import byte_marks, same_bytes

BLOCK_CHARS = 1 << 19  # text read at once
WINDOW_BYTES = 1 << 11  # bytes merged at once inside a long piece
LONG_PIECE = 64  # bytes from which a piece is streamed and not remembered
CACHE_WORDS = 1 << 18  # pieces that one Python worker remembers
LETTER, NUMBER, OTHER, BLANK, SPACE = range(5)


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """Class of every code point: letter, number, other, U+0020, other white space."""
    kinds = {"L": LETTER, "N": NUMBER}
    out = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), np.uint8, 0x110000)
    for lo, hi in ((0x09, 0x0D), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A),
                   (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000)):
        out[lo:hi + 1] = SPACE
    out[0x20] = BLANK
    return out


def piece_starts(cp: np.ndarray, first: np.ndarray) -> np.ndarray:
    """True where a piece of the byte-level split starts; ``first`` marks the first
    character of each text.  Pieces are runs of letters, numbers or other
    characters, each with one blank before it, the English contractions, and
    white space (a run leaves its last character to what follows)."""
    kind = _classes()[cp]
    white = kind >= BLANK
    before = np.empty_like(kind)
    before[0], before[1:] = OTHER, kind[:-1]
    last = np.empty(len(cp), bool)  # last character of its text
    last[-1], last[:-1] = True, first[1:]
    after_dark = np.zeros(len(cp), bool)
    after_dark[:-1] = ~white[1:]
    after_dark &= ~last
    start = np.where(white, (before < BLANK) | after_dark, (before != BLANK) & (kind != before))
    start |= first
    for i in np.flatnonzero((cp == 39) & start):
        tail = "".join(map(chr, cp[i + 1:i + 3]))
        inside = 0 if last[i] else 2 if tail in ("re", "ve", "ll") and not last[i + 1] else int(tail[:1] in ("s", "t", "m", "d"))
        if inside:
            start[i + 1:i + 1 + inside] = False
            if not last[i + inside]:
                start[i + 1 + inside] = True
    return start


class PieceRows:
    """Ids of pieces, remembered with the bytes they stand for in a table of bounded size.

    A subclass says how a piece is encoded: ``encode_short`` many pieces of at most
    ``LONG_PIECE`` bytes, ``encode_long`` a single longer one.
    """

    row_at: np.ndarray  # row r has the ids row_ids[row_at[r]:row_at[r] + row_n[r]]
    row_n: np.ndarray
    row_ids: np.ndarray

    def encode_short(self, data: np.ndarray, at: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        raise NotImplementedError

    def encode_long(self, piece: bytes) -> np.ndarray:
        raise NotImplementedError

    def _forget(self) -> None:
        self.known: dict[int, int] = {}  # fingerprint of a short piece -> its row
        self.row_at, self.row_n, self.row_ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)
        # the bytes that a row stands for, with which every later use is compared
        self.own_at, self.own_n, self.own = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint8)

    def _add(self, counts: np.ndarray, ids: list[np.ndarray], data: np.ndarray, at: np.ndarray, length: np.ndarray) -> np.ndarray:
        """New rows with ``counts`` ids each for the pieces; the rows' numbers."""
        rows = len(self.row_at) + np.arange(len(counts))
        self.row_at = np.append(self.row_at, len(self.row_ids) + np.cumsum(counts) - counts)
        self.row_n = np.append(self.row_n, counts)
        self.row_ids = np.concatenate([self.row_ids, *ids])
        self.own_at = np.append(self.own_at, len(self.own) + np.cumsum(length) - length)
        self.own_n = np.append(self.own_n, length)
        self.own = np.append(self.own, data[spread(at, length)])
        return rows

    def _is_row(self, data: np.ndarray, at: np.ndarray, length: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Whether each piece has the very bytes that its row stands for."""
        equal = length == self.own_n[row]
        some = np.flatnonzero(equal)
        equal[some] = same_bytes(data, at[some], self.own, self.own_at[row[some]], length[some])
        return equal

    def rows(self, data: np.ndarray, at: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Row of ids of each piece, making the rows that are not known yet.  Fingerprints
        only find a row; it is used where the bytes are the same."""
        row = np.full(len(at), -1, np.int64)
        short = np.flatnonzero(length <= LONG_PIECE)
        uniq, one, inverse = np.unique(byte_marks(data, at[short], length[short]), return_index=True, return_inverse=True)
        got = np.fromiter(map(self.known.get, uniq.tolist(), repeat(-1)), np.int64, len(uniq))
        new = np.flatnonzero(got < 0)
        if len(new) and len(self.known) + len(new) > CACHE_WORDS:
            self._forget()
            got[:], new = -1, np.arange(len(uniq))
        elif len(self.row_ids) > 16 * CACHE_WORDS:  # those of long pieces are not looked up again
            self._forget()
            got[:], new = -1, np.arange(len(uniq))
        if len(new):
            s, n = at[short[one[new]]], length[short[one[new]]]
            ids, count = self.encode_short(data, s, n)
            got[new] = self._add(count, [ids], data, s, n)
            self.known.update(zip(uniq[new].tolist(), got[new].tolist()))
        row[short] = got[inverse]
        alike = self._is_row(data, at[short], length[short], row[short])
        # long pieces, and short ones whose fingerprint belongs to other bytes
        seen: dict[bytes, int] = {}
        for k in [*np.flatnonzero(length > LONG_PIECE), *short[~alike]]:
            piece = data[at[k]:at[k] + length[k]].tobytes()
            if piece not in seen:
                ids = self.encode_long(piece)
                seen[piece] = int(self._add(np.array([len(ids)]), [ids], data, at[k:k + 1], np.zeros(1, np.int64))[0])
            row[k] = seen[piece]
        return row

class MergeTable(PieceRows):
    """Vocabulary, merges and sufficient lookahead of one byte-level BPE file.  Without
    ``special`` the strings of added tokens are plain text."""

    def __init__(self, path: str, special: bool = True):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
        other = [b for b in range(256) if b not in set(plain)]
        alphabet = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}
        to_bytes = lambda s: bytes(alphabet[c] for c in s)
        vocab = {to_bytes(t): i for t, i in model["vocab"].items()}
        self.added = {a["content"]: a["id"] for a in spec["added_tokens"]}
        bytes_of = {i: b for b, i in vocab.items()} | {i: t.encode() for t, i in self.added.items()}
        size = max(bytes_of) + 1
        self.bytes_of = [bytes_of.get(i, b"") for i in range(size)]
        self.byte_len = np.array([len(b) for b in self.bytes_of], np.int64)
        self.byte_at = np.cumsum(self.byte_len) - self.byte_len
        self.byte_flat = np.frombuffer(b"".join(self.bytes_of), np.uint8)
        self.byte_ids = np.array([vocab[bytes([b])] for b in range(256)], np.int32)
        self.ranks: dict[tuple[int, int], tuple[int, int]] = {}
        reach: dict[bytes, int] = {}  # left operand -> largest reach so far
        right: dict[bytes, bytes] = {}
        self.lookahead = 1
        for rank, pair in enumerate(model["merges"]):
            u, v = (to_bytes(x) for x in (pair.split(" ") if isinstance(pair, str) else pair))
            if any(len(x) > 1 and x not in right for x in (u, v)) or u + v in right:
                raise ValueError(f"merge {rank} is not proper: the lookahead bound needs each operand made before")
            far, spine = 0, v
            while spine is not None:
                far = max(far, reach.get(spine, 0))
                spine = right.get(spine)
            reach[u] = max(reach.get(u, 0), len(v) + far)
            right[u + v] = v
            self.lookahead = max(self.lookahead, len(v) + far)
            self.ranks[vocab[u], vocab[v]] = (rank, vocab[u + v])
        self._index_pairs()
        if not special:
            self.added = {}
        self.added_re = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")")
        self._forget()

    # ---------------------------------------------------- pair look-up ----

    def _index_pairs(self) -> None:
        """Open-addressed table of (pair -> rank, made id) for look-up by arrays."""
        self.slots = 1 << 20
        self.pair_key = np.full(self.slots, -1, np.int64)
        self.pair_rank = np.full(self.slots, 1 << 30, np.int32)
        self.pair_made = np.zeros(self.slots, np.int32)
        for (a, b), (rank, made) in self.ranks.items():
            at = int(self._slot(np.array([a << 32 | b]))[0])
            while self.pair_key[at] >= 0:
                at = (at + 1) % self.slots
            self.pair_key[at], self.pair_rank[at], self.pair_made[at] = a << 32 | b, rank, made

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)).astype(np.int64)

    def _find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Slot of each pair; an empty slot if it is no merge."""
        key = a.astype(np.int64) << 32 | b
        at = self._slot(key)
        todo = np.flatnonzero((self.pair_key[at] != key) & (self.pair_key[at] >= 0))
        while len(todo):
            at[todo] = (at[todo] + 1) % self.slots
            todo = todo[(self.pair_key[at[todo]] != key[todo]) & (self.pair_key[at[todo]] >= 0)]
        return at

    # ------------------------------------------------------ one window ----

    def merge(self, data: bytes) -> list[int]:
        """Ids of one window: lowest merge first, leftmost first among equals."""
        ids, ranks = self.byte_ids[np.frombuffer(data, np.uint8)].tolist(), self.ranks
        n = len(ids)
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r[0], i, ids[i], ids[i + 1], r[1]) for i in range(n - 1)
                if (r := ranks.get((ids[i], ids[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, a, b, made = heapq.heappop(heap)
            j = nxt[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = made, -1
            nxt[i] = nxt[j]
            if nxt[i] < n:
                prv[nxt[i]] = i
            for x, y in ((prv[i], i), (i, nxt[i])):
                if x >= 0 and y < n and (r := ranks.get((ids[x], ids[y]))) is not None:
                    heapq.heappush(heap, (r[0], x, ids[x], ids[y], r[1]))
        return [x for x in ids if x >= 0]

    def stream(self, piece: bytes) -> Iterator[list[int]]:
        """Ids of a piece of any length, emitted once no later byte can change them."""
        window = b""
        for at in range(0, len(piece), WINDOW_BYTES):
            window += piece[at:at + WINDOW_BYTES]
            if at + WINDOW_BYTES >= len(piece) or len(window) <= self.lookahead:
                continue
            stable, end, out = len(window) - self.lookahead, 0, []
            for i in self.merge(window):
                if end + self.byte_len[i] > stable:
                    break
                end += int(self.byte_len[i])
                out.append(i)
            window = window[end:]
            yield out
        yield self.merge(window)

    def encode_short(self, data: np.ndarray, at: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.merge_many(data[spread(at, length)], length)

    def encode_long(self, piece: bytes) -> np.ndarray:
        return np.array([i for part in self.stream(piece) for i in part], np.int32)

    def merge_many(self, data: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of many short windows that lie one behind the other in ``data``, and
        the number of ids of each.  Every round does the next merge of each window."""
        ids, word = self.byte_ids[data], np.repeat(np.arange(len(length)), length)
        done_ids, done_word = [], []
        while len(ids):
            at = self._find(ids[:-1], ids[1:])
            rank = np.append(self.pair_rank[at], 1 << 30)
            rank[:-1][word[:-1] != word[1:]] = 1 << 30
            begin = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            size = np.diff(np.append(begin, len(word)))
            low = np.repeat(np.minimum.reduceat(rank, begin), size)
            open_ = low < (1 << 30)
            done_ids.append(ids[~open_])
            done_word.append(word[~open_])
            hit = np.flatnonzero((rank == low) & open_)
            hit = hit[np.append(True, word[hit[1:]] != word[hit[:-1]])] if len(hit) else hit  # the leftmost
            ids[hit] = self.pair_made[at[hit]]
            open_[hit + 1] = False
            ids, word = ids[open_], word[open_]
        all_word = np.concatenate([*done_word, word])
        order = np.argsort(all_word, kind="stable")
        return np.concatenate([*done_ids, ids])[order], np.bincount(all_word, minlength=len(length))

    # ----------------------------------------------------------- texts ----

    def _plain(self, parts: list[str]) -> list[np.ndarray]:
        """Ids of texts without added tokens, a block of bounded size."""
        text = "".join(parts)
        if not text:
            return [np.zeros(0, np.int32)] * len(parts)
        cp = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        data = np.frombuffer(text.encode(), np.uint8)
        chars = np.array([len(p) for p in parts])
        head = np.cumsum(chars) - chars
        first = np.zeros(len(cp), bool)
        first[head[chars > 0]] = True
        start = np.flatnonzero(piece_starts(cp, first))
        width = 1 + (cp >= 0x80) + (cp >= 0x800).astype(np.int8) + (cp >= 0x10000)
        byte = np.cumsum(width) - width
        at = byte[start]
        length = np.diff(np.append(at, len(data)))
        row = self.rows(data, at, length)
        n = self.row_n[row]
        ids = self.row_ids[spread(self.row_at[row], n)]
        cuts = np.append(0, np.cumsum(n))[np.searchsorted(start, np.append(head, len(cp)))]
        return [ids[a:b] for a, b in zip(cuts[:-1], cuts[1:])]

    def encode_batch(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text; blocks of bounded size are encoded one after the other."""
        out: list[list[np.ndarray]] = [[] for _ in texts]
        block, owner, size = [], [], 0

        def flush():
            for k, ids in zip(owner, self._plain(block)):
                out[k].append(ids)
            block.clear(), owner.clear()

        for k, text in enumerate(texts):
            for part in self.added_re.split(text) if any(t in text for t in self.added) else (text,):
                if part in self.added:
                    flush()
                    size = 0
                    out[k].append(np.array([self.added[part]], np.int32))
                    continue
                for b in blocks(part):
                    block.append(b), owner.append(k)
                    size += len(b)
                    if size >= BLOCK_CHARS:
                        flush()
                        size = 0
        flush()
        empty = np.zeros(0, np.int32)
        return [x[0] if len(x) == 1 else np.concatenate([empty, *x]) for x in out]

    def decoder(self):
        """Incremental decoder: ``feed(ids, final)`` gives the text that is certain so far."""
        machine = codecs.getincrementaldecoder("utf-8")("replace")

        def feed(ids, final: bool = False) -> str:
            ids = np.asarray(ids, np.int64)
            ids = ids[(ids >= 0) & (ids < len(self.byte_len))]
            return machine.decode(self.byte_flat[spread(self.byte_at[ids], self.byte_len[ids])].tobytes(), final)

        return feed


def spread(at: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Positions at, at+1, ..., at+n-1 of every pair, one behind the other."""
    total = int(n.sum())
    return np.repeat(at - (np.cumsum(n) - n), n) + np.arange(total)


def blocks(text: str) -> Iterator[str]:
    """Cut a text before white space that follows other characters: no piece
    spans such a place, and the piece before it doesn't look behind it."""
    at, n = 0, len(text)
    while n - at > BLOCK_CHARS:
        cut = _CUT.search(text, at + BLOCK_CHARS)
        if cut is None:
            break
        yield text[at:cut.start() + 1]
        at = cut.start() + 1
    yield text[at:]


_CUT = re.compile(r"[^\s\x85\x1c-\x1f][\t-\r ]")


@lru_cache(maxsize=4)
def merge_table(path: str, special: bool = True) -> MergeTable:
    return MergeTable(path, special)


def encode_documents(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                     out: str = "ids") -> DataFrame:
    """``id_col`` and the token ids (array<int>) of every whole text."""
    text_batches(df.sparkSession)
    src = df.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))

    def run(batches):
        table = merge_table(path)
        for b in small_batches(batches):
            ids = table.encode_batch(b.column(1).to_pylist())
            at = np.cumsum([0, *map(len, ids)]).astype(np.int32)
            flat = pa.array(np.concatenate([np.zeros(0, np.int32), *ids]), pa.int32())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(at, flat)], [id_col, out])

    return src.mapInArrow(run, f"`{id_col}` {src.schema[0].dataType.simpleString()}, `{out}` array<int>")


def decode_documents(df: DataFrame, path: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """All columns of ``df`` with the text that the ids stand for (NULL ids: empty)."""
    names = [c for c in df.columns if c != out]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name != out)

    def run(batches):
        table, step = merge_table(path), 1 << 16
        for b in small_batches(batches):
            texts = []
            for row in b.column(names.index(ids_col)):
                ids = row.values.drop_null().to_numpy() if row.is_valid else ()
                feed = table.decoder()
                texts.append("".join([*(feed(ids[k:k + step]) for k in range(0, len(ids), step)), feed((), True)]))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], [*names, out])

    return df.select(*names).mapInArrow(run, f"{schema}, `{out}` string")
