"""Fingerprints of words and of word windows for many texts at once, as NumPy arrays.

A word of at most ``LONG`` bytes is taken eight bytes at a time through a keyed
chain of bijective mixing steps, so two words of one length and up to eight bytes
never share a fingerprint; a longer word has a keyed BLAKE2b hash.  A window's
fingerprint comes from those of its two overlapping halves (a tree of power-of-two
windows), mixed at each step.  Neither has the algebraic structure of a polynomial
modulo a power of two, in which certain strings collide whatever the key.

A fingerprint has 64 bits and a key (``seed``).  Where equality decides a result,
callers compare bytes or the fingerprints of two keys (128 bits).
"""

from __future__ import annotations

import hashlib

import numpy as np

_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
LONG = 64  # bytes from which a word is hashed as a whole
_MASK = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)  # the first n bytes of a chunk


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective mixing of 64-bit values (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _key(seed: int, what: str) -> np.uint64:
    """An odd constant for a key and a use of it."""
    return np.uint64(int.from_bytes(hashlib.blake2b(f"{seed}/{what}".encode(), digest_size=8).digest(), "little") | 1)


def chunks(data: np.ndarray) -> np.ndarray:
    """Overlapping eight-byte values: item ``i`` is data[i:i + 8], filled up with zeros at the end."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))


def byte_marks(data: np.ndarray, start: np.ndarray, length: np.ndarray, seed: int = 1) -> np.ndarray:
    """Fingerprint of data[start : start + length] for each pair."""
    eight = chunks(data)
    mark = mix(length.astype(np.uint64) * _key(seed, "length"))
    key, at, n, which = _key(seed, "chunk"), start, length, None
    for c in range(0, LONG, 8):
        if c:
            more = np.flatnonzero((n > c) & (n <= LONG))
            if not len(more):
                break
            which = more if which is None else which[more]
            at, n = at[more], n[more]
        own = mark if which is None else mark[which]
        own = mix((own ^ (eight[at + c] & _MASK[np.minimum(n - c, 8)])) + key)
        if which is None:
            mark = own
        else:
            mark[which] = own
    secret = int(key).to_bytes(8, "little")
    for i in np.flatnonzero(length > LONG):
        word = data[start[i]:start[i] + length[i]].tobytes()
        mark[i] = int.from_bytes(hashlib.blake2b(word, digest_size=8, key=secret).digest(), "little")
    return mark


def same_bytes(left: np.ndarray, at: np.ndarray, right: np.ndarray, to: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether left[at : at + length] equals right[to : to + length], for each triple."""
    a, b = chunks(left), chunks(right)
    same, which, done = np.ones(len(at), bool), np.arange(len(at)), 0
    while len(which):
        mask = _MASK[np.minimum(length[which] - done, 8)]
        same[which] = ((a[at[which] + done] ^ b[to[which] + done]) & mask) == 0
        done += 8
        which = which[same[which] & (length[which] > done)]
    return same


def window_marks(values: np.ndarray, size: int, seed: int = 1) -> np.ndarray:
    """Fingerprint of values[i : i + size] for every i that has so many."""
    n = len(values) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    up, down = _key(seed, "left"), _key(seed, "right")

    def both(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        x = (a ^ (a >> np.uint64(32))) * up + b * down
        return x ^ (x >> np.uint64(29))

    have, width = values, 1
    while width * 2 <= size:
        have, width = both(have[:len(have) - width], have[width:]), width * 2
    if width < size:  # two overlapping windows cover this one
        have = both(have[:n], have[size - width:size - width + n])
    return mix(have[:n] + np.uint64(size))


class Words:
    """The words ``[^\\x20\\x09-\\x0D]+`` of texts: ``mark`` (a fingerprint each),
    ``at`` (text ``i`` has words at[i]:at[i + 1]), and their bytes."""

    def __init__(self, texts: list[str | None], lower: bool = False, seed: int = 1):
        raw = [(t or "").encode() for t in texts]
        self.data = np.frombuffer(b"\n".join([*raw, b""]), np.uint8)
        white = _WHITE[self.data]
        edge = np.flatnonzero(np.diff(np.concatenate([[True], white, [True]]).view(np.int8)))
        self.start, self.end = edge[0::2], edge[1::2]
        self.ends = np.cumsum([len(r) + 1 for r in raw], dtype=np.int64)
        self.at = np.concatenate([[0], np.searchsorted(self.start, self.ends)]).astype(np.int64)
        self.lower, self.seed = lower, seed
        self.mark = self.marks(seed)

    def marks(self, seed: int) -> np.ndarray:
        """Fingerprints of the words with another key."""
        return byte_marks(_LOWER[self.data] if self.lower else self.data, self.start, self.end - self.start, seed)

    def text(self, i: int, keep: np.ndarray) -> bytes:
        """Words of text ``i`` where ``keep`` is true, joined by one space."""
        lo = self.at[i]
        return b" ".join([self.data[self.start[lo + k]:self.end[lo + k]].tobytes() for k in np.flatnonzero(keep)])

    def windows(self, size: int, seed: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(fingerprints, offsets): all windows of ``size`` words of each text, in order."""
        n = np.maximum(np.diff(self.at) - size + 1, 0)
        offset = np.concatenate([[0], np.cumsum(n)])
        at = np.repeat(self.at[:-1] - offset[:-1], n) + np.arange(offset[-1])
        own = self.mark if seed in (None, self.seed) else self.marks(seed)
        return window_marks(own, size, self.seed if seed is None else seed)[at], offset
