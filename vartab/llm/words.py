"""Words and word hashes of many texts at once, with numpy.

Texts are UTF-8 bytes; a word is a run of bytes that are not white space (space
and 0x09-0x0D). Word hashes are 64-bit polynomials over the bytes, computed from
running sums; sequences of words get polynomials over the word hashes the same
way. Only arrays over PIECE bytes are held per byte; what stays is per word.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

PIECE = 1 << 21
_U = np.uint64
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BYTE = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE, _SEQ_BASE = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93  # odd, so invertible mod 2**64


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(max(n, 1), base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)[:n]


def _inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every input bit."""
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


@dataclass
class Words:
    """``hashes`` of all words; those of text i are first[i]:first[i + 1]."""

    hashes: np.ndarray
    first: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def _pieces(data: bytes):
    at = 0
    while at < len(data):
        end = min(len(data), at + PIECE)
        if end < len(data):  # after the last space, or after the next one
            cut = data.rfind(b" ", at, end)
            if cut < 0:
                cut = data.find(b" ", end)
            end = len(data) if cut < 0 else cut + 1
        yield at, end
        at = end


def hash_words(texts: list[bytes]) -> Words:
    """Word hashes of ``texts``. The hash of a word depends on its bytes only."""
    data = b" ".join(texts) + b" "
    powers, back = np.empty(0, np.uint64), np.empty(0, np.uint64)
    hashes, starts = [], []
    for at, end in _pieces(data):
        n = end - at
        if n > len(powers):
            powers, back = _powers(_BASE, n), _powers(_inverse(_BASE), n)
        piece = np.frombuffer(data, np.uint8, n, at)
        space = _SPACE[piece]
        edge = np.flatnonzero(np.diff(space.view(np.int8), prepend=np.int8(1), append=np.int8(1)))
        begin, stop = edge[0::2], edge[1::2]
        sums = np.empty(n + 1, np.uint64)
        sums[0] = 0
        np.cumsum(_BYTE[piece] * powers[:n], out=sums[1:])
        hashes.append(mix((sums[stop] - sums[begin]) * back[begin]))
        starts.append(begin + at)
    begins = np.concatenate(starts) if starts else np.empty(0, np.int64)
    lengths = np.array([len(t) + 1 for t in texts], dtype=np.int64)
    first = np.searchsorted(begins, np.concatenate([[0], np.cumsum(lengths)]))
    return Words(np.concatenate(hashes) if hashes else np.empty(0, np.uint64), first)


def hash_windows(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, index of the first word) of every run of ``size`` words within a text."""
    h, n = words.hashes, len(words.hashes)
    counts = words.counts()
    full = np.maximum(counts - size + 1, 0)
    total = int(full.sum())
    if not total:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    offset = np.repeat(words.first[:-1] - np.concatenate([[0], np.cumsum(full)[:-1]]), full)
    start = np.arange(total) + offset
    sums = np.empty(n + 1, np.uint64)
    sums[0] = 0
    np.cumsum(h * _powers(_SEQ_BASE, n), out=sums[1:])
    return mix((sums[start + size] - sums[start]) * _powers(_inverse(_SEQ_BASE), n)[start]), start


def second_hash(words: Words, size: int, start: np.ndarray) -> np.ndarray:
    """32 further bits for the windows at ``start``, independent of hash_windows."""
    n = len(words.hashes)
    sums = np.empty(n + 1, np.uint64)
    sums[0] = 0
    base = 0xA0761D6478BD642F
    np.cumsum(mix(words.hashes ^ _U(0x5851F42D4C957F2D)) * _powers(base, n), out=sums[1:])
    h = mix((sums[start + size] - sums[start]) * _powers(_inverse(base), n)[start])
    return (h >> _U(32)).astype(np.uint32)
