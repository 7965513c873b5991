"""Sets of hashed word shingles, made for many texts at a time with numpy."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np

_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_S27, _S30, _S31 = np.uint64(27), np.uint64(30), np.uint64(31)
#: Words up to this many bytes are hashed together, byte by byte; longer ones alone.
_SHORT = 40


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _S30)) * _M2
    h = (h ^ (h >> _S27)) * _M3
    return h ^ (h >> _S31)


def word_hashes(texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words, and where each text's words begin (with the end)."""
    joined = np.frombuffer(b"\n" + b"\n".join(texts).lower() + b"\n", np.uint8)
    blank = _SPACE[joined]
    edge = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    starts, ends = edge[::2], edge[1::2]
    sizes = ends - starts
    h = sizes.astype(np.uint64) * _M1
    left = np.flatnonzero(sizes <= _SHORT)
    k = 0
    while len(left):
        h[left] = (h[left] ^ (joined[starts[left] + k].astype(np.uint64) + np.uint64(1))) * _M2
        h[left] ^= h[left] >> _S31
        k += 1
        left = left[sizes[left] > k]
    for i in np.flatnonzero(sizes > _SHORT).tolist():
        digest = hashlib.blake2b(joined[starts[i] : ends[i]].tobytes(), digest_size=8).digest()
        h[i] = np.frombuffer(digest, np.uint64)[0]
    begins = np.cumsum([1, *(len(t) + 1 for t in texts)])
    return _mix(h), np.searchsorted(starts, begins)


def shingle_sets(texts: Sequence[bytes], width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; shorter texts have one of all their words."""
    words, bounds = word_hashes(texts)
    n = len(words)
    rolled = np.zeros(0, np.uint64)
    if n >= width:
        rolled = np.full(n - width + 1, width, np.uint64)
        for k in range(width):
            rolled = _mix(rolled * _M1 + words[k : n - width + 1 + k])
    sets = []
    for start, end in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if end - start >= width:
            own = np.sort(rolled[start : end - width + 1])
            sets.append(own[np.append(True, own[1:] != own[:-1])])
        elif end > start:
            one = np.full(1, end - start, np.uint64)
            for k in range(start, end):
                one = _mix(one * _M1 + words[k : k + 1])
            sets.append(one)
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets
