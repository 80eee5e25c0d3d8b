"""Hashed word shingles of whole texts, vectorised over batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_BASE = 0x9E3779B97F4A7C15
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]  # of the base and of its inverse


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose every output bit depends on every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0][:n], _powers[1][:n]


def _slices(raws: list[bytes], most: int = 1 << 20) -> Iterator[list[bytes]]:
    part, size = [], 0
    for r in raws:
        part.append(r)
        size += len(r)
        if size >= most:
            yield part
            part, size = [], 0
    if part:
        yield part


def shingle_sets(texts: list[str | None], words: int) -> Iterator[np.ndarray]:
    """For each text the sorted, distinct 64-bit hashes of its shingles of ``words`` words.

    A-Z count as lower case; words end at blanks and the white space from tab to carriage return.
    A text with fewer words has one shingle, all its words; one without words, or null, has none.
    """
    for part in _slices([(t or "").encode("utf-8", "surrogatepass").translate(_LOWER) for t in texts]):
        raw = np.frombuffer(b" ".join(part) + b" ", np.uint8)
        starts_of = np.cumsum([0, *[len(r) + 1 for r in part]])
        space = _SPACE[raw]
        edge = np.flatnonzero(np.diff(space.view(np.int8), prepend=1))
        first, last = edge[::2], edge[1::2]
        power, inverse = _power(len(raw) + 1)
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * power[:-1], out=sums[1:])
        word = mixed((sums[last] - sums[first]) * inverse[first] + (last - first).astype(np.uint64))
        bounds = np.searchsorted(first, starts_of)
        n = len(word) - words + 1
        if n > 0:
            whole = word[:n].copy()
            for k in range(1, words):
                whole = whole * np.uint64(_BASE) + word[k : k + n]
            whole = mixed(whole)
        for a, b in zip(bounds[:-1], bounds[1:]):
            if b - a >= words:
                yield np.unique(whole[a : b - words + 1])
            elif b > a:
                short = np.uint64(b - a)
                for w in word[a:b]:
                    short = np.uint64((int(short) * _BASE + int(w)) & (2**64 - 1))
                yield mixed(np.array([short], np.uint64))
            else:
                yield np.zeros(0, np.uint64)
