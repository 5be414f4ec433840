"""Vectorised 64-bit hashes of a text's words and word n-grams.

Words are runs of characters other than ``[\\x20\\x09-\\x0D]``, A-Z lower-cased if asked
for. All words of a stretch of text are hashed by a few array operations: bytes map to random numbers, a
polynomial's prefix sums give every word's value, and a finaliser mixes the bits.
"""

from __future__ import annotations

import numpy as np

STRETCH = 1 << 20
_SEED = np.random.default_rng(20240229)
_BYTE = _SEED.integers(1, 1 << 63, 256, dtype=np.uint64)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_P = 0x9E3779B97F4A7C15
_INVERSE = pow(_P, -1, 1 << 64)
_C1, _C2, _K = (np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93))
_power = np.ones(1, dtype=np.uint64)
_negative = np.ones(1, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _C1
    x = (x ^ (x >> np.uint64(27))) * _C2
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _power, _negative
    if len(_power) < n:
        n = max(n, 1 << 16)
        steps = np.full(n, _P, dtype=np.uint64)
        steps[0] = 1
        back = np.full(n, _INVERSE, dtype=np.uint64)
        back[0] = 1
        _power, _negative = np.cumprod(steps), np.cumprod(back)
    return _power, _negative


def _stretches(data: bytes):
    """Parts of about STRETCH bytes, cut at white space; a longer word is a part of its own."""
    at = 0
    while at < len(data):
        end = at + STRETCH
        if end >= len(data):
            yield data[at:]
            return
        while end < len(data) and not _SPACE[data[end]]:
            end += 1
        yield data[at:end]
        at = end


def words(data: bytes) -> np.ndarray:
    """The hashes of the words, in order."""
    out = []
    for part in _stretches(data):
        b = np.frombuffer(part, dtype=np.uint8)
        gap = np.ones(len(b) + 2, dtype=bool)
        gap[1:-1] = _SPACE[b]
        edge = np.flatnonzero(gap[1:] != gap[:-1])
        start, end = edge[::2], edge[1::2]
        if not len(start):
            continue
        up, down = _powers(len(b) + 1)
        total = np.zeros(len(b) + 1, dtype=np.uint64)
        np.cumsum(_BYTE[b] * up[:len(b)], out=total[1:])
        out.append(mix((total[end] - total[start]) * down[start]))
    return np.concatenate(out) if len(out) > 1 else out[0] if out else np.empty(0, dtype=np.uint64)


def ngrams(hashes: np.ndarray, n: int) -> np.ndarray:
    """The hashes of all runs of n words; of fewer words, one hash of the whole; of none, none."""
    if not len(hashes):
        return hashes
    k = min(n, len(hashes))
    out = np.full(len(hashes) - k + 1, k, dtype=np.uint64)
    for i in range(k):
        out = (out + hashes[i:len(hashes) - k + 1 + i]) * _K
    return mix(out)


def folded(text: str) -> bytes:
    """UTF-8 with A-Z in lower case and nothing else changed."""
    return text.encode("utf-8", "surrogatepass").lower()


def shingle_set(text: str, n: int) -> np.ndarray:
    """The distinct n-word shingles of a text, sorted by hash."""
    return np.unique(ngrams(words(folded(text)), n))
