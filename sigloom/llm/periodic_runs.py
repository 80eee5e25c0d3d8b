"""Periodic runs of words: maximal pairs of the LCP-interval tree whose distance fits their length.

A run of period ``q`` and length ``m`` is a maximal pair: the same ``m - q`` words start at its first
word and ``q`` words later, with different words before and after. So a bottom-up walk over the
LCP intervals, each with its positions by left word, meets every run as one pair, and nothing is
ever extended.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship
from .batches import by_bytes

Edit = Callable[[object, list[bytes]], list[bytes]]
_CHUNK = 1024


class Places:
    """Sorted positions in chunks, so that adding one to very many moves a chunk at most."""

    __slots__ = ("chunks", "tops", "n")

    def __init__(self, first: int):
        self.chunks, self.tops, self.n = [[first]], [first], 1

    def add(self, x: int) -> None:
        k = min(bisect_left(self.tops, x), len(self.tops) - 1)
        chunk = self.chunks[k]
        insort(chunk, x)
        self.n += 1
        if len(chunk) > _CHUNK:
            half = _CHUNK // 2
            self.chunks[k : k + 1] = [chunk[:half], chunk[half:]]
            self.tops[k : k + 1] = [chunk[half - 1], chunk[-1]]
        else:
            self.tops[k] = chunk[-1]

    def around(self, x: int) -> tuple[int, int]:
        """The positions just before and after ``x``, -1 where there is none."""
        k = bisect_left(self.tops, x)
        chunk = self.chunks[k]
        i = bisect_left(chunk, x)
        before = chunk[i - 1] if i else self.chunks[k - 1][-1] if k else -1
        after = chunk[i + 1] if i + 1 < len(chunk) else self.chunks[k + 1][0] if k + 1 < len(self.chunks) else -1
        return before, after

    def __iter__(self) -> Iterator[int]:
        for chunk in self.chunks:
            yield from chunk


def repeated_suffixes(codes: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes that share ``depth`` items with another, in order, and what each shares with the one before.

    Prefix doubling: after the step to ``depth`` only suffixes still tied are sorted again. The
    ranks of every step are kept, and shared lengths are read off them from the longest step down.
    """
    n = len(codes)
    levels = [np.append(codes.astype(np.int32), -1)]
    step = 1
    while 2 * step <= depth:
        rank = levels[-1]
        pair = rank[:n].astype(np.int64) * (n + 1)
        pair[: n - step] += rank[step:n] + 1
        levels.append(np.append(np.unique(pair, return_inverse=True)[1].astype(np.int32), -1))
        step *= 2
    # From here on a rank is the number of smaller suffixes, so that a tied group has room within.
    rank = levels[-1]
    sizes = np.bincount(rank[:n])
    rank = np.append((np.cumsum(sizes) - sizes)[rank[:n]].astype(np.int32), -1)
    tied = np.flatnonzero(sizes[levels[-1][:n]] > 1)
    levels[-1] = rank
    every = tied
    while len(tied):
        after = np.minimum(tied + step, n)
        pair = rank[tied].astype(np.int64) * (n + 1) + rank[after] + 1
        by = np.argsort(pair, kind="stable")
        tied, pair = tied[by], pair[by]
        group, old = np.append(True, pair[1:] != pair[:-1]), np.append(True, pair[1:] // (n + 1) != pair[:-1] // (n + 1))
        at = np.arange(len(tied))
        first = np.maximum.accumulate(np.where(group, at, 0))
        base = np.maximum.accumulate(np.where(old, at, 0))
        new = rank.copy()
        new[tied] = rank[tied] + (first - base)
        rank = new
        levels.append(rank)
        step *= 2
        tied = tied[~(group & np.append(group[1:], True))]
    order = every[np.argsort(rank[every], kind="stable")]
    shared = np.zeros(len(order), np.int64)
    if len(order):
        a, b = order[:-1].copy(), order[1:].copy()
        for k in range(len(levels) - 1, -1, -1):
            same = np.flatnonzero(levels[k][a] == levels[k][b])
            a[same] += 1 << k
            b[same] += 1 << k
        shared[1:] = a - order[:-1]
    return order, shared


def interval_pairs(order: list[int], shared: list[int], left: list[int], least: int, times: int, found: list[tuple[int, int, int]]) -> None:
    """Appends ``(start, length, period)`` of every run in one group of suffixes, bottom up.

    A node's positions are one list in order, each in the class of its left word. When two children
    meet, a pair of a run stands side by side in the union: were another occurrence of the node's
    words between them, its period would be smaller and hold for both. So each position of the
    smaller child looks at its two neighbours only, of the other child and another class.
    """

    def met(a: Places, b: Places, depth: int) -> Places:
        large, small = (a, b) if a.n >= b.n else (b, a)
        own = list(small)
        mine = set(own)
        for x in own:
            large.add(x)
        for x in own:
            before, after = large.around(x)
            for i, j in ((before, x), (x, after)):
                if i < 0 or j < 0 or (i if j == x else j) in mine:
                    continue
                q = j - i
                if depth >= (times - 1) * q and depth + q >= least and (not i or left[i] != left[j]):
                    found.append((i, depth + q, q))
        return large

    stack: list[tuple[int, Places]] = []
    for k, start in enumerate(order):
        depth = shared[k + 1] if k + 1 < len(order) else -1
        node = Places(start)
        while stack and stack[-1][0] > depth:
            d, top = stack.pop()
            node = met(top, node, d)
        if stack and stack[-1][0] == depth:
            stack[-1] = (depth, met(stack[-1][1], node, depth))
        elif depth >= 0:
            stack.append((depth, node))


def runs_of(words: list[bytes], least: int = 24, times: int = 3) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of all runs of a sequence, by start, then period.

    The pair of a run shares at least ``depth`` words. Most texts repeat no such stretch, which
    hashes of stretches show first; the rest is compared exactly.
    """
    n, depth = len(words), -(-least * (times - 1) // times)
    if n < least:
        return []
    wide = np.fromiter(map(hash, words), np.int64, n).view(np.uint64)
    width = 1
    while 2 * width <= depth:
        wide = wide[:-width] * np.uint64(0x9E3779B97F4A7C15) + (wide[width:] ^ (wide[width:] >> np.uint64(29)))
        width *= 2
    wide.sort()
    if not (wide[1:] == wide[:-1]).any():
        return []
    numbers: dict[bytes, int] = {}
    codes = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, n)
    order, shared = repeated_suffixes(codes, width)
    begins = np.flatnonzero(shared < depth)
    if not len(order):
        return []
    left = np.append(-1, codes[:-1])
    group = np.cumsum(shared < depth) - 1
    sizes = np.diff(np.append(begins, len(order)))
    # A group whose positions all follow one word has no maximal pair; one whose positions lie further apart than its words allow has no run.
    classes = left[order]
    mixed = np.minimum.reduceat(classes, begins) != np.maximum.reduceat(classes, begins)
    deepest = np.maximum.reduceat(np.where(shared < depth, 0, shared), begins)
    by = np.lexsort((order, group))
    gaps = np.append(n, np.diff(order[by]))
    gaps[begins] = n
    near = np.minimum.reduceat(gaps, begins) * (times - 1) <= deepest
    found: list[tuple[int, int, int]] = []
    own = left.tolist() if (mixed & near).any() else []
    for g in np.flatnonzero(mixed & near & (sizes > 1)).tolist():
        a, b = int(begins[g]), int(begins[g] + sizes[g])
        interval_pairs(order[a:b].tolist(), shared[a:b].tolist(), own, least, times, found)
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """``words`` without those that a run repeats: all but the first period of each run."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    keep = np.cumsum(change[:-1]) == 0
    return [words[i] for i in np.flatnonzero(keep).tolist()]


def find_periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 24, times: int = 3, edit: Edit | None = None) -> DataFrame:
    """``(id, n_words, runs array<struct<start, length, period>>, collapsed)`` for every row.

    Words are runs of what is no ASCII white space. A run is a stretch of at least ``least`` words
    and ``times`` periods that no neighbouring word extends; ``period`` is its smallest. In
    ``collapsed`` every run keeps its first period, words are joined by one blank. ``edit(id,
    words)`` may change the words before.

    Nothing is shuffled: a task reads slices of bounded bytes, and needs up to some 200 bytes for
    each word of its longest text; time grows as n log n there, for periodic texts too. A null or
    empty text, or one of white space, has no words and no runs; repeated rows and null ids are
    rows like others; an empty table gives none; other columns are not read.
    """
    ship(docs.sparkSession)
    kind = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, 1):
            counts, texts, sizes, flat = [], [], [0], []
            for i, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = raw.split()
                if edit:
                    words = edit(i, words)
                runs = runs_of(words, least, times)
                counts.append(len(words))
                texts.append(b" ".join(collapsed(words, runs)))
                flat += runs
                sizes.append(len(flat))
            fields = [pa.array([r[k] for r in flat], pa.int64()) for k in range(3)]
            runs_array = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.StructArray.from_arrays(fields, fields=list(kind)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), runs_array, pa.array(texts, pa.binary()).cast(pa.string())], ["id", "n_words", "runs", "collapsed"])

    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("raw"))
    out = rows.mapInArrow(scan, f"id {rows.schema['id'].dataType.simpleString()}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")
    return out.withColumnRenamed("id", id_col)
