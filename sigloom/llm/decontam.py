"""Benchmark decontamination by the q-gram lemma.

An item of n bytes that occurs in a text with at most e edits shares at least ``n + 1 - q - q * e``
q-grams with it, all on diagonals at most e apart. Shared q-grams are counted in bands of
diagonals, two neighbouring bands of width e or more at a time; regions that reach the bound are
verified by a banded alignment.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..session import released, settled, ship
from .batches import by_bytes, filter_rows

Q = 8  # bytes, so that a q-gram is one unsigned 64-bit number
_FOLD = bytes(b + 32 if 65 <= b <= 90 else 32 if b in b"\t\n\r\v\f" else b for b in range(256))
_SPREAD = np.uint64(0x9E3779B97F4A7C15)
_TABLE_BITS = 21
#: Postings from which a q-gram is common: a rule or a heading that very many items hold.
COMMON = 256


def folded(text: str | None) -> bytes:
    """The text's bytes with A-Z in lower case and white space as blanks; positions stay."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD)


def qgrams(raw: bytes) -> np.ndarray:
    """Every 8 bytes in a row, as numbers."""
    n = len(raw) - Q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.empty(n, np.uint64)
    for o in range(min(Q, n)):
        part = np.frombuffer(raw, "<u8", count=(len(raw) - o) // Q, offset=o)
        out[o::Q] = part[: len(out[o::Q])]
    return out


def without_common(grams: np.ndarray, item: np.ndarray, bound: np.ndarray, common: int) -> tuple[np.ndarray, np.ndarray]:
    """Which postings (in the order of their grams) stay, and how many each item loses.

    An item that is there shares ``bound`` of its q-grams' places, so of all but ``k`` of them it
    shares ``bound - k`` at least. Each item gives up places of q-grams with ``common`` or more
    postings, the most common first, for at most half of its bound; what it cannot give up is counted on.
    """
    heat = np.unique(grams, return_counts=True)[1]
    heat = np.repeat(heat, heat)
    hot = np.flatnonzero(heat >= common)
    by = hot[np.lexsort((-heat[hot], item[hot]))]
    own = item[by]
    begin = np.flatnonzero(np.append(True, own[1:] != own[:-1])[: len(own)])
    rank = np.arange(len(own)) - np.repeat(begin, np.diff(np.append(begin, len(own))))
    gone = by[rank < bound[own] // 2]
    stays = np.ones(len(grams), bool)
    stays[gone] = False
    return stays, np.bincount(item[gone], minlength=len(bound))


@dataclass
class Index:
    """The items of one block with the postings of their q-grams."""

    ids: list
    items: list[bytes]
    budget: np.ndarray  # edits allowed, by item
    bound: np.ndarray  # q-grams to share, by item
    width: np.ndarray  # of a band, by item
    grams: np.ndarray
    first: np.ndarray  # of a gram's postings
    item: np.ndarray
    at: np.ndarray
    table: np.ndarray

    @classmethod
    def build(cls, rows: list[tuple[object, str]], rate: float, common: int = COMMON) -> Index:
        rows = [(i, raw) for i, t in rows if len(raw := folded(t).strip()) >= Q]
        items = [raw for _, raw in rows]
        sizes = np.array([len(x) for x in items], np.int64)
        budget = np.minimum(np.floor(sizes * rate).astype(np.int64), (sizes - Q) // Q)
        bound = sizes + 1 - Q - Q * budget
        grams = np.concatenate([qgrams(x) for x in items] or [np.zeros(0, np.uint64)])
        item = np.repeat(np.arange(len(items)), np.maximum(sizes - Q + 1, 0))
        at = np.concatenate([np.arange(max(0, n - Q + 1)) for n in sizes] or [np.zeros(0, np.int64)])
        order = np.argsort(grams, kind="stable")
        kept, dropped = without_common(grams[order], item[order], bound, common)
        order, bound = order[kept], bound - dropped
        grams = grams[order]
        unique, first = np.unique(grams, return_index=True)
        table = np.zeros(1 << _TABLE_BITS, bool)
        table[(unique * _SPREAD) >> np.uint64(64 - _TABLE_BITS)] = True
        return cls([i for i, _ in rows], items, budget, bound, np.maximum(budget, 16), unique, np.append(first, len(grams)), item[order], at[order], table)


def band_distance(item: bytes, region: bytes, low: int, high: int) -> tuple[int, int]:
    """Fewest edits that turn ``item`` into a part of ``region``, and that part's end.

    Only diagonals ``low`` to ``high`` (region position less item position) are computed. The part
    may start and end anywhere.
    """
    p, t = np.frombuffer(item, np.uint8), np.frombuffer(region, np.uint8)
    d = np.arange(low, high + 1)
    far = 1 << 30
    row = np.where((d >= 0) & (d <= len(t)), 0, far).astype(np.int64)
    padded = np.concatenate([np.full(max(0, -low), 256, np.int64), t.astype(np.int64), np.full(max(0, len(p) + high - len(t)) + 1, 256, np.int64)])
    shift = max(0, -low) + low
    steps = np.arange(len(d))
    for i, c in enumerate(p):
        same = padded[i + shift : i + shift + len(d)]
        step = row + (same != c)
        step[:-1] = np.minimum(step[:-1], row[1:] + 1)
        row = np.minimum.accumulate(step - steps) + steps
        row[(d + i + 1 < 0) | (d + i + 1 > len(t))] = far
    best = int(np.argmin(row))
    return int(row[best]), int(d[best]) + len(p)


def regions(raw: bytes, index: Index, window: int = 1 << 16, most_postings: int = 1 << 20) -> Iterator[tuple[int, int, int]]:
    """``(item, first diagonal, last diagonal)`` of the regions whose band pairs share enough q-grams.

    Shared q-grams are counted window by window of the text, each prolonged by what the longest
    item and two bands can reach, so that every band pair lies whole in one. Within a window
    postings are taken up ``most_postings`` at a time: what is held does not grow with how often
    a q-gram occurs, and none is left out. A pair that two windows see may come twice.
    """
    grams = qgrams(raw)
    hit = np.flatnonzero(index.table[(grams * _SPREAD) >> np.uint64(64 - _TABLE_BITS)])
    if not len(hit):
        return
    found = np.searchsorted(index.grams, grams[hit])
    found[found == len(index.grams)] = 0
    real = index.grams[found] == grams[hit]
    hit, found = hit[real], found[real]
    longest = int(max(map(len, index.items)))
    reach = longest + 2 * int(index.width.max())
    window = max(window, 4 * reach)
    bands = (len(raw) + longest) // 16 + 3
    # A pair's hits start at its first diagonal at the earliest: windows before the first hit's see it too.
    for k in sorted({*(hit // window).tolist(), *np.maximum(0, (hit - reach) // window).tolist()}):
        lo, hi = np.searchsorted(hit, [k * window, (k + 1) * window + reach]).tolist()
        if lo == hi:
            continue
        seen: list[tuple[np.ndarray, np.ndarray]] = []
        n = index.first[found[lo:hi] + 1] - index.first[found[lo:hi]]
        part = np.cumsum(n) // most_postings
        cuts = [lo, *(lo + 1 + np.flatnonzero(np.diff(part))).tolist(), hi]
        for a, b in zip(cuts[:-1], cuts[1:]):
            start, n = index.first[found[a:b]], index.first[found[a:b] + 1] - index.first[found[a:b]]
            post = np.repeat(start - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
            item = index.item[post]
            band = (np.repeat(hit[a:b], n) - index.at[post] + longest) // index.width[item]
            own, times = np.unique(item * bands + band, return_counts=True)
            seen.append((own, times))
            # Counts are merged when as many new ones wait as are merged: each few times over, not with every portion.
            if sum(len(x) for x, _ in seen[1:]) > max(len(seen[0][0]), most_postings):
                seen = [_merged(seen)]
        keys, counts = _merged(seen)
        both = counts.copy()
        both[:-1] += np.where(keys[1:] == keys[:-1] + 1, counts[1:], 0)
        good = keys[both >= index.bound[keys // bands]]
        # Pairs that lie one after the other are one region: it is aligned at once.
        for own in np.split(good, np.flatnonzero(np.diff(good) > 1) + 1) if len(good) else ():
            for i, (a, b) in _by_item(own, bands):
                w = int(index.width[i])
                yield i, a * w - longest, (b + 2) * w - longest - 1


def _merged(seen: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if len(seen) == 1:
        return seen[0]
    keys, place = np.unique(np.concatenate([k for k, _ in seen]), return_inverse=True)
    return keys, np.bincount(place, np.concatenate([c for _, c in seen]), len(keys)).astype(np.int64)


def _by_item(keys: np.ndarray, bands: int) -> Iterator[tuple[int, tuple[int, int]]]:
    """A chain of keys as item with first and last band."""
    for own in np.split(keys, np.flatnonzero(np.diff(keys // bands)) + 1):
        yield int(own[0] // bands), (int(own[0] % bands), int(own[-1] % bands))


def matches(raws: list[bytes], index: Index) -> Iterator[tuple[int, int, int, int, int]]:
    """``(row, item, edits, start, end)``, the best place of each item in each text, in bytes."""
    if not index.items:
        return
    gap = b"\xff" * Q  # in no UTF-8 text, so no q-gram reaches from text to text
    starts = np.cumsum([0, *[len(r) + Q for r in raws]])
    whole = gap.join(raws) + gap
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    for i, low, high in regions(whole, index):
        item, e = index.items[i], int(index.budget[i])
        left, right = low - e, high + len(item) + e + 1
        rows = range(max(0, int(np.searchsorted(starts, left, "right")) - 1), min(len(raws), int(np.searchsorted(starts, right, "left"))))
        for row in rows:
            at = int(starts[row])
            a, b = max(0, left - at), min(len(raws[row]), right - at)
            if b - a < len(item) - e or best.get((row, i), (e + 1,))[0] == 0:
                continue
            region = raws[row][a:b]
            if (exact := region.find(item)) >= 0:
                found = (0, a + exact, a + exact + len(item))
            else:
                edits, end = band_distance(item, region, max(low - e - at - a, -len(item)), min(high + e - at - a, len(region)))
                if edits > e:
                    continue
                back = region[max(0, end - len(item) - e) : end][::-1]
                _, size = band_distance(item[::-1], back, -e, e)
                found = (edits, a + end - size, a + end)
            best[row, i] = min(found, best.get((row, i), found))
    for (row, i), found in sorted(best.items()):
        yield row, i, *found


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, block_bytes: int) -> tuple[int, Iterator[list[tuple]]]:
    """How many blocks of about ``block_bytes`` the benchmark's items make, and the blocks, one at a time."""
    items = benchmark.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(F.col(text_col).isNotNull()).dropDuplicates()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, math.ceil(total / block_bytes))
    if n > 1:
        items = settled(items.withColumn("block", F.pmod(F.xxhash64("id", "text"), F.lit(n))), "items")
    return n, ([(r["id"], r["text"]) for r in (items if n == 1 else items.where(F.col("block") == k)).collect()] for k in range(n))


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", rate: float = 0.08, block_bytes: int = 4 << 20) -> DataFrame:
    """One row per document and item found in it: both ids, ``edits, start_byte, end_byte``.

    An item is found where at most ``rate`` of its bytes need an edit (fewer if it is so short
    that no q-gram would be left), case of A-Z and kind of white space aside. The best place is
    reported, the first of equals. Every text is read whole, and no document is shuffled. The
    benchmark goes to the tasks in blocks of ``block_bytes``: one pass over the documents for a
    benchmark up to that size; of a larger one the driver holds one block at a time, and each
    block's rows are written before the next.

    Null and empty texts and items, and items under 8 bytes, match nothing. Repeated documents
    repeat their rows; repeated items count once. Null ids stay null; other columns are not read.
    """
    ship(docs.sparkSession)
    kinds = docs.schema[id_col].dataType.simpleString(), benchmark.schema[item_id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(F.octet_length("text") >= Q)
    item_type, out = to_arrow_type(benchmark.schema[item_id_col].dataType), None
    n, blocks = _blocks(benchmark, item_id_col, item_text_col, block_bytes)
    for block in blocks:

        def find(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            index = Index.build(block, rate)
            for batch in by_bytes(batches, 1):
                ids = batch.column(0).to_pylist()
                hits = [(ids[r], index.ids[i], e, s, t) for r, i, e, s, t in matches([folded(x) for x in batch.column(1).to_pylist()], index)]
                if hits:
                    a, b, *rest = zip(*hits)
                    yield pa.RecordBatch.from_arrays([pa.array(a, batch.column(0).type), pa.array(b, item_type), *[pa.array(x, pa.int64()) for x in rest]], ["id", "item", "edits", "start_byte", "end_byte"])

        part = rows.mapInArrow(find, f"id {kinds[0]}, item {kinds[1]}, edits long, start_byte long, end_byte long")
        part = part if n == 1 else settled(part, "leaks")
        out = part if out is None else out.unionAll(part)
    return out.withColumnsRenamed({"id": id_col, "item": item_id_col})


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", rate: float = 0.08, block_bytes: int = 4 << 20) -> DataFrame:
    """The rows of ``docs``, all columns, in which no item of ``benchmark`` is found.

    Rows pass through the tasks that read them; see :func:`find_leaks` for what counts. Rows with
    null or empty texts stay, and so do all rows if the benchmark is empty.
    """
    ship(docs.sparkSession)
    place, before = docs.columns.index(text_col), None
    n, blocks = _blocks(benchmark, item_id_col, item_text_col, block_bytes)
    for block in blocks:

        def keep(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            index = Index.build(block, rate)
            for batch in by_bytes(batches, place):
                clean = np.ones(batch.num_rows, bool)
                for r, *_ in matches([folded(x) for x in batch.column(place).to_pylist()], index):
                    clean[r] = False
                yield batch.filter(pa.array(clean))

        docs = filter_rows(docs, keep)
        if n > 1:
            own, docs = before, settled(docs, "clean")
            released(own)
            before = docs
    return docs
