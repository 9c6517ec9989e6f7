"""Word and shingle hashes of whole texts with NumPy (runs inside tasks, a bounded block of texts at a time)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: An odd 64-bit base (and its inverse modulo 2**64) for the rolling word hash.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
BLOCK_BYTES = 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.ones(256, bool)
_WORD[[32, 9, 10, 11, 12, 13]] = False
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective, wraps)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> list[np.ndarray]:
    """BASE**i and INVERSE**i for i < n (kept per worker; n is a block's size or one text's)."""
    if len(_POWERS[0]) < n:
        for k, base in enumerate((BASE, INVERSE)):
            steps = np.full(max(n, BLOCK_BYTES), base, np.uint64)
            steps[0] = 1
            _POWERS[k] = np.multiply.accumulate(steps)
    return _POWERS


def blocks(texts: list[bytes], size: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Index ranges of texts with about ``size`` bytes each (a longer text has a range of its own)."""
    start = total = 0
    for i, t in enumerate(texts):
        if i > start and total + len(t) > size:
            yield start, i
            start, total = i, 0
        total += len(t) + 1
    if start < len(texts):
        yield start, len(texts)


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of the bytes of each span (a rolling sum, so the cost does not grow with their length)."""
    power, inverse = _powers(len(raw))
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * power[:len(raw)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words (runs of other than ASCII white space, A-Z lower-cased) and each word's text index."""
    raw = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    inside = _WORD[raw]
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if inside[0]:
        edge = np.concatenate(([0], edge))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h = span_hashes(_LOWER[raw], starts, ends)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    return h, np.searchsorted(np.cumsum(lengths), starts, side="right")


def window_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive words (the caller leaves out windows that cross texts)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = h[:n].copy()
    for j in range(1, k):
        out = mix(out * np.uint64(BASE) + h[j:n + j])
    return out


def long_window_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Like window_hashes for long windows: a rolling sum, so the cost does not grow with k."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    power, inverse = _powers(len(h) + 1)
    sums = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(mix(h) * power[:len(h)], out=sums[1:])
    return mix((sums[k:] - sums[:n]) * inverse[:n])


def shingle_sets(texts: list[bytes], k: int) -> Iterator[np.ndarray]:
    """Per text: sorted distinct hashes of its k-word shingles; fewer words make one shingle; no words, none."""
    for lo, hi in blocks(texts):
        h, owner = word_hashes(texts[lo:hi])
        s = window_hashes(h, k)
        bounds = np.searchsorted(owner, np.arange(hi - lo + 1))
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            if b - a >= k:
                yield np.unique(s[a:b - k + 1])
            elif b > a:
                yield mix(window_hashes(h[a:b], b - a) + np.uint64(b - a))
            else:
                yield h[:0]
