"""Suffix-array dedup: bytes covered by a string of ``least`` bytes that starts elsewhere too.

Two equal strings of that length hold the same smallest q-gram, by hash. So the starts of a text
fall into runs with one smallest q-gram each, and a string's copies lie in runs of the same
q-gram. Runs whose q-gram occurs nowhere else are done. Runs that agree as a whole are copies as a
whole. Only where runs of one q-gram differ are their bytes fetched and put into suffix order,
where the longest-previous-factor array tells which starts have an earlier match.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import settled, ship
from .batches import by_bytes
from .shingles import _power, mixed

_Q = 64


def window_min(x: np.ndarray, w: int) -> np.ndarray:
    """The minimum of every ``w`` neighbours: prefix and suffix minima of blocks of ``w``."""
    n = len(x) - w + 1
    padded = np.full(-(-len(x) // w) * w, np.iinfo(x.dtype).max, x.dtype)
    padded[: len(x)] = x
    blocks = padded.reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[w - 1 : w - 1 + n])


def runs(raws: list[bytes], least: int, q: int = _Q) -> Iterator[tuple[list, list, list, list]]:
    """For each text its runs: smallest q-gram, hash of the run's bytes, first start, number of starts.

    A run whose q-gram occurs twice in its own bytes may repeat within itself; its number of
    starts is negative.
    """
    if least < 2 * q:
        q = max(1, least // 2)
    w = least - q + 1
    whole = b"".join(raws)
    ends = np.cumsum([len(r) for r in raws])
    out: list[tuple[list, list, list, list]] = [([], [], [], []) for _ in raws]
    if len(whole) < least:
        return iter(out)
    power, inverse = _power(len(whole) + 1)
    sums = np.zeros(len(whole) + 1, np.uint64)
    np.cumsum((np.frombuffer(whole, np.uint8).astype(np.uint64) + np.uint64(1)) * power[:-1], out=sums[1:])
    grams = mixed((sums[q:] - sums[:-q]) * inverse[: len(whole) - q + 1])
    low = window_min(grams, w)
    step = np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1]]))
    # Where runs of starts begin: at a new q-gram, at a text's begin, and past its last start.
    begins = np.concatenate([[0], ends[:-1]])
    stops = np.maximum(begins, ends - least + 1)
    cuts = np.unique(np.concatenate([step, begins, stops, [len(low)]]))
    cuts = cuts[cuts <= len(low)]
    first, last = cuts[:-1], cuts[1:]
    text = np.searchsorted(ends, first, "right")
    text = np.minimum(text, len(raws) - 1)
    inside = (first >= begins[text]) & (first < stops[text])
    first, last, text = first[inside], last[inside], text[inside]
    lowest = low[first]
    at = np.flatnonzero(np.isin(grams, lowest)) if len(first) < 1000 else np.flatnonzero(_is_low(grams, low, w))
    hashes = grams[at]
    lo, hi = np.searchsorted(at, first), np.searchsorted(at, last + w - 1)
    view = memoryview(whole)
    for a, b, k, h, x, y in zip(first.tolist(), last.tolist(), text.tolist(), lowest.tolist(), lo.tolist(), hi.tolist()):
        own = int(np.count_nonzero(hashes[x:y] == h)) if y - x > 1 else 1
        o = out[k]
        o[0].append(h - (1 << 64) if h >> 63 else h)
        c = xxhash.xxh3_64_intdigest(view[a : b - 1 + least])
        o[1].append(c - (1 << 64) if c >> 63 else c)
        o[2].append(a - int(begins[k]))
        o[3].append(b - a if own == 1 else a - b)
    return iter(out)


def _is_low(grams: np.ndarray, low: np.ndarray, w: int) -> np.ndarray:
    """Which q-grams are the smallest of a window that holds them."""
    padded = np.concatenate([np.full(w - 1, 0, np.uint64), low, np.full(w - 1, 0, np.uint64)])
    top = ~window_min(~padded, w)  # the largest of the minima of the windows around each q-gram
    return grams <= top[: len(grams)]


def gram_places(raw: bytes, h: int, q: int) -> np.ndarray:
    """Where the q-gram with the hash ``h`` of :func:`runs` starts."""
    power, inverse = _power(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((np.frombuffer(raw, np.uint8).astype(np.uint64) + np.uint64(1)) * power[:-1], out=sums[1:])
    return np.flatnonzero(mixed((sums[q:] - sums[:-q]) * inverse[: len(raw) - q + 1]).view(np.int64) == h)


def suffix_order(text: np.ndarray, least: int, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffix array of the places that share their first ``least`` bytes with another, and each one's class.

    Places of one class share those bytes, so between neighbours of the order the longest common
    prefix reaches ``least`` exactly where the class goes on. Prefix doubling: ranks by 8 bytes,
    then by twice as many from two ranks each; places whose rank is theirs alone are settled.
    Suffixes are told apart up to ``longest`` bytes, equal ones ordered by place.
    """
    n = len(text)
    padded = np.zeros(n + 8, np.uint8)
    padded[:n] = text
    words = np.zeros(n, np.uint64)
    for k in range(8):
        words = (words << np.uint64(8)) | padded[k : k + n].astype(np.uint64)
    size = 8 if least >= 8 else least
    words >>= np.uint64(8 * (8 - size))
    order = np.argsort(words, kind="stable")
    rank = np.full(n + 2 * max(least, longest) + 1, -1, np.int64)
    head = np.concatenate([[True], words[order][1:] != words[order][:-1]])
    starts = np.flatnonzero(head)
    rank[order] = starts[np.cumsum(head) - 1]
    sizes = np.diff(np.append(starts, n))
    active = order[np.repeat(sizes > 1, sizes)]
    members, classes = active, rank[active]
    while size < max(least, longest) and len(active):
        shift = min(size, least - size) if size < least else size
        old = rank[active]
        key = old * (n + 2) + rank[active + shift] + 1
        o = np.argsort(key, kind="stable")
        active, key, old = active[o], key[o], old[o]
        new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        group = np.flatnonzero(np.concatenate([[True], old[1:] != old[:-1]]))
        each = np.diff(np.append(new, len(key)))
        head_of = np.repeat(new, each)
        group_of = np.repeat(group, np.diff(np.append(group, len(key))))
        rank[active] = old + head_of - group_of
        active = active[np.repeat(each > 1, each)]
        size += shift
        if size <= least:
            members, classes = active, rank[active]
    o = np.lexsort((members, rank[members]))
    return members[o], classes[o]


def previous_smaller(places: np.ndarray, linked: np.ndarray) -> np.ndarray:
    """For each index of the suffix order that of the nearest smaller place before it, -1 without one.

    ``linked[i]`` tells whether neighbours ``i - 1`` and ``i`` share enough; no search passes a
    place where they do not. All searches step at once, each over what its last stop has found to
    be larger; the few that go on for long are ended one by one.
    """
    found = np.where(linked, np.arange(len(places)) - 1, -1)
    rest = np.flatnonzero(linked)
    for _ in range(64):
        rest = rest[found[rest] >= 0]
        rest = rest[places[found[rest]] > places[rest]]
        if not len(rest):
            return found
        found[rest] = found[found[rest]]
    for i in rest.tolist():
        j = int(found[i])
        while j >= 0 and places[j] > places[i]:
            j = int(found[j])
        found[i] = j
    return found


def previous_factors(places: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """By index of the suffix order the previous and the next smaller place that share a class, as indices or -1.

    The longest match of a place that starts earlier is with one of the two. Capped at the
    length that a class shares, the longest-previous-factor array is that length where either exists.
    """
    linked = np.concatenate([[False], classes[1:] == classes[:-1]])[: len(places)]
    before = previous_smaller(places, linked)
    turned = previous_smaller(places[::-1], np.concatenate([[False], linked[:0:-1]])[: len(places)])[::-1]
    return before, np.where(turned >= 0, len(places) - 1 - turned, -1)


def repeated_ranges(contents: list[bytes], many: list[bool], least: int, keep_first: bool) -> Iterator[tuple[int, int, int]]:
    """``(content, first byte, end)`` of what repeats among ``contents``, earlier ones first.

    ``many`` marks contents that occur more than once themselves.
    """
    gap = b"\xff"
    text = np.frombuffer(gap.join(contents) + gap, np.uint8)
    begins = np.cumsum([0, *[len(c) + 1 for c in contents]])[:-1]
    valid = np.zeros(len(text), bool)
    for b, c in zip(begins.tolist(), contents):
        valid[b : b + max(0, len(c) - least + 1)] = True
    places, classes = suffix_order(text, least, max(map(len, contents)))
    inside = valid[places]
    places, classes = places[inside], classes[inside]
    before, after = previous_factors(places, classes)
    hit = np.zeros(len(text) + 1, bool)
    hit[places[(before >= 0) | (after >= 0)]] = True
    if not keep_first:
        for source in (before, after):
            hit[places[source[source >= 0]]] = True
        for b, c, m in zip(begins.tolist(), contents, many):
            if m:
                hit[b : b + len(c) - least + 1] = True
    edge = np.flatnonzero(np.diff(hit.view(np.int8), prepend=0))
    first, last = edge[::2], edge[1::2]
    for k, a, b in zip((np.searchsorted(begins, first, "right") - 1).tolist(), first.tolist(), last.tolist()):
        yield k, a - int(begins[k]), b - 1 + least - int(begins[k])


def pieces(content: bytes, marks: np.ndarray, salt: int, least: int, step: int) -> Iterator[tuple[int, int, int, bytes]]:
    """``key, first start, mark, bytes`` of the pieces of a run, by how far its starts lie before a mark.

    A mark is a place of the run's q-gram; each start belongs to the first mark from it on, and
    equal strings lie as far before theirs. A piece holds the starts of one mark at distances
    ``k * step`` to ``(k + 1) * step - 1``. All strings of that many bytes from there share the
    bytes that the key is made of, so equal strings come to pieces of one key.
    """
    starts = np.arange(len(content) - least + 1)
    mark = marks[np.searchsorted(marks, starts)]
    block = (mark - starts) // step
    cuts = np.flatnonzero(np.concatenate([[True], (mark[1:] != mark[:-1]) | (block[1:] != block[:-1])]))
    for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(starts)]):
        m, k = int(mark[a]), int(block[a])
        core = content[m - k * step : m - (k + 1) * step + 1 + least]
        key = xxhash.xxh3_64_intdigest(core, (salt + k) & ((1 << 64) - 1))
        yield key - (1 << 64) if key >> 63 else key, a, m - a, content[a : b - 1 + least]


def repeated_spans(docs: DataFrame, id_col: str, text_col: str, least: int, keep_first: bool, group_bytes: int = 1 << 20) -> DataFrame:
    """``(id, t, spans)``, not yet merged: byte ranges ``start, end`` that repeat, by id and hash of the text."""
    spark = ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("t"), F.encode(text, "UTF-8").alias("raw")).where(F.octet_length("raw") >= least)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, 2, 1 << 19):
            h, c, a, n = zip(*runs(batch.column(2).to_pylist(), least))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *[pa.array(x, pa.list_(pa.int64())) for x in (h, c)], *[pa.array(x, pa.list_(pa.int32())) for x in (a, n)]], ["id", "t", "h", "c", "a", "n"])

    lists = rows.mapInArrow(cut, f"id {kind}, t long, h array<long>, c array<long>, a array<int>, n array<int>")
    flat = settled(lists.select("id", "t", F.inline(F.arrays_zip("h", "c", "a", "n"))), "runs")
    # By q-gram: how many runs, whether all alike, whether one may repeat within itself.
    seen = flat.groupBy("h").agg(F.count("*").alias("runs"), F.min("c").alias("c_min"), F.max("c").alias("c_max"), F.min("n").alias("n_min"))
    seen = seen.where("runs > 1 or n_min < 0").select("h", ((F.col("c_min") == F.col("c_max")) & (F.col("runs") > 1)).alias("alike"))
    # Written first, the counts are a plain side of the join, whose hot keys Spark can then split.
    told = settled(flat.join(settled(seen, "seen"), "h").withColumn("n", F.abs("n")), "told")

    # Of differing runs, one of each kind gives its bytes, the first by id and place.
    kinds = told.where("not alike").groupBy("h", "c").agg(F.min(F.struct("id", "a", "t", "n")).alias("first"), F.count("*").alias("many"))
    kinds = settled(kinds.select("h", "c", "many", "first.*"), "kinds")
    per = settled(kinds.groupBy("h").agg(F.sum(F.col("n") + least).alias("bytes")), "per")
    total = per.agg(F.sum("bytes")).first()[0] or 0
    groups = max(1, -(-total // group_bytes))
    plan = kinds.join(per, "h").withColumn("often", F.col("bytes") > group_bytes)
    wanted = plan.groupBy("id", "t").agg(F.collect_list(F.struct("h", "c", "many", "often", "a", "n")).alias("wanted"))
    wanted = wanted.withColumnsRenamed({"id": "wanted_id", "t": "wanted_t"})
    found = rows.join(wanted, F.col("id").eqNullSafe(F.col("wanted_id")) & (F.col("t") == F.col("wanted_t"))).select("id", "raw", "wanted")

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = (pa.int64(), pa.int64(), pa.int64(), pa.bool_(), None, pa.int32(), pa.binary())
        for batch in by_bytes(batches, 1):
            out = []
            for i, raw, own in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                out += [(w["h"], w["c"], w["many"], w["often"], i, w["a"], raw[w["a"] : w["a"] + w["n"] - 1 + least]) for w in own]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, k or batch.column(0).type) for x, k in zip(zip(*out), types)], ["h", "c", "many", "often", "id", "a", "bytes"])

    # One document gives the bytes of each kind; an id and text that are repeated give them again.
    got = found.mapInArrow(fetch, f"h long, c long, many long, often boolean, id {kind}, a int, bytes binary")
    common = not plan.where("often").isEmpty()
    if common:  # two readers
        got = settled(got, "contents")
    ranges = _in_suffix_order(got.where("not often").select(F.col("h").alias("key"), F.col("c").alias("k"), "many", "id", F.col("a").alias("place"), "bytes"), groups, least, keep_first)
    ranges = ranges.withColumnsRenamed({"key": "h", "k": "c"})
    if common:
        ranges = ranges.unionByName(_common_ranges(got.where("often").dropDuplicates(["h", "c"]), kind, least, keep_first, group_bytes))
    # A run's ranges travel as one row. Written first, they are a plain side of the join, as above.
    ranges = settled(ranges.groupBy("h", "c").agg(F.collect_set(F.struct("from", "to")).alias("ranges")), "ranges")
    moved = F.transform("ranges", lambda r: F.struct((F.col("a") + r["from"]).alias("start"), (F.col("a") + r["to"]).alias("end")))
    differ = told.where("not alike").join(ranges, ["h", "c"]).select("id", "t", moved.alias("spans"))
    whole = F.array(F.struct(F.col("a").alias("start"), (F.col("a") + F.col("n") - 1 + least).alias("end"))).alias("spans")
    if keep_first:
        firsts = told.groupBy("h", "c").agg(F.min(F.struct("id", "a")).alias("f"))
        later = told.join(firsts, ["h", "c"]).where(~F.struct("id", "a").eqNullSafe(F.col("f")))
        return differ.unionAll(later.select("id", "t", whole))
    return differ.unionAll(told.where("alike").select("id", "t", whole))


def _in_suffix_order(contents: DataFrame, groups: int, least: int, keep_first: bool) -> DataFrame:
    """``key, k, from, to``: what repeats among the contents of each key; ``k`` names a content within its key."""

    def compare(table: pa.Table) -> pa.Table:
        rows = list({(r["key"], r["k"]): r for r in table.to_pylist()}.values())
        rows.sort(key=lambda r: (r["id"] is not None, r["id"], r["place"]) if r["id"] is not None else (False, 0, r["place"]))
        found = [(rows[i]["key"], rows[i]["k"], a, b) for i, a, b in repeated_ranges([r["bytes"] for r in rows], [r["many"] > 1 for r in rows], least, keep_first)]
        key, k, a, b = zip(*found) if found else ((), (), (), ())
        return pa.table({"key": pa.array(key, pa.int64()), "k": pa.array(k, pa.int64()), "from": pa.array(a, pa.int32()), "to": pa.array(b, pa.int32())})

    grouped = contents.select(F.pmod(F.xxhash64("key"), F.lit(groups)).alias("g"), "key", "k", "many", "id", "place", "bytes")
    return grouped.groupBy("g").applyInArrow(compare, "key long, k long, `from` int, `to` int")


def _common_ranges(runs: DataFrame, kind: str, least: int, keep_first: bool, group_bytes: int) -> DataFrame:
    """What repeats among runs of q-grams that are too common for one group: ``h, c, from, to``.

    Runs are cut into pieces that meet by the bytes their strings share (:func:`pieces`), equal
    pieces are combined by their full bytes, and what is left of a key goes into suffix order. A
    key that still has too many bytes is cut finer; at the finest, a piece is one string and its
    key has no other.
    """
    q = _Q if least >= 2 * _Q else max(1, least // 2)
    steps = [s for s in (64, 8, 1) if s <= max(1, least // 4)]
    level = runs.select("h", "c", "many", "id", F.col("a").alias("run"), F.lit(0).alias("at"), F.lit(None).cast("int").alias("mark"), "bytes")
    out = None
    for step in steps:

        def cut(batches: Iterator[pa.RecordBatch], step=step) -> Iterator[pa.RecordBatch]:
            types = (*[pa.int64()] * 4, None, pa.int32(), pa.int32(), pa.int32(), pa.binary())
            for batch in by_bytes(batches, 7, 1 << 18):
                rows = []
                for h, c, many, i, run, at, mark, content in zip(*(x.to_pylist() for x in batch.columns)):
                    marks = gram_places(content, h, q) if mark is None else np.array([mark])
                    rows += [(key, h, c, many, i, run, at + a, m, part) for key, a, m, part in pieces(content, marks, h, least, step)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(x, k or batch.column(3).type) for x, k in zip(zip(*rows), types)], ["key", "h", "c", "many", "id", "run", "at", "mark", "bytes"])

        place = F.col("run") + F.col("at")
        parts = level.mapInArrow(cut, f"key long, h long, c long, many long, id {kind}, run int, at int, mark int, bytes binary")
        parts = settled(parts.withColumn("k", F.xxhash64("mark", "bytes")), "parts")
        kinds = parts.groupBy("key", "k", "mark", "bytes").agg(F.sum("many").alias("many"), F.min(F.struct("id", place.alias("place"))).alias("first"))
        kinds = settled(kinds.select("key", "k", "many", "first", "first.*", "bytes"), "kinds")
        per = settled(kinds.groupBy("key").agg(F.sum("many").alias("times"), F.sum(F.octet_length("bytes")).alias("size")).where("times > 1"), "per")
        finest = step == steps[-1]
        close = per if finest else per.where(F.col("size") <= group_bytes)
        total = close.agg(F.sum("size")).first()[0] or 0
        found = _in_suffix_order(kinds.join(close.select("key"), "key").drop("first"), max(1, -(-total // group_bytes)), least, keep_first)
        if keep_first:  # the first piece of a kind stands for it; all others are repeats as a whole
            found = settled(found, "ranges")
            told = parts.join(kinds.join(close.select("key"), "key").select("key", "k", "first"), ["key", "k"]).withColumn("later", ~F.struct("id", place.alias("place")).eqNullSafe(F.col("first")))
            whole = told.where("later").select("h", "c", F.col("at").alias("from"), (F.col("at") + F.octet_length("bytes")).alias("to"))
            told = told.where("not later")
        else:
            whole, told = None, parts
        ranges = told.join(found, ["key", "k"]).select("h", "c", (F.col("at") + F.col("from")).alias("from"), (F.col("at") + F.col("to")).alias("to"))
        for part in filter(None, (ranges, whole)):
            out = part if out is None else out.unionAll(part)
        if finest or per.where(F.col("size") > group_bytes).isEmpty():
            break
        level = parts.join(per.where(F.col("size") > group_bytes).select("key"), "key").select("h", "c", "many", "id", "run", "at", "mark", "bytes")
    return out


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 400, keep_first: bool = True, with_text: bool = False, group_bytes: int = 1 << 20) -> DataFrame:
    """One row per input row: id, ``n_bytes, n_removed, n_spans, kept_sha256`` (and ``kept_bytes``).

    Texts are UTF-8 bytes. A byte goes if a string of ``least`` bytes covers it that also starts
    earlier (by id, then place; with ``keep_first`` false: anywhere else), in the same text
    or another. All is judged on the input; overlapping strings count; no string crosses texts.

    A null or empty text has 0 bytes and nothing to remove. Repeated rows are copies of each other
    (``keep_first`` spares all rows that repeat the first one's id and text). Null ids come
    first. An empty table gives no rows; other columns are not read.
    """
    spans = repeated_spans(docs, id_col, text_col, least, keep_first, group_bytes)
    spans = spans.groupBy("id", "t").agg(F.flatten(F.collect_set("spans")).alias("spans"))
    kind = docs.schema[id_col].dataType.simpleString()
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("t"), F.encode(text, "UTF-8").alias("raw"))

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, 1):
            out = []
            for raw, own in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                kept, at, n_spans = [], 0, 0
                end = -1
                for s in sorted((s["start"], s["end"]) for s in own or ()):
                    if s[0] > end:
                        kept.append(raw[at : s[0]])
                        n_spans += 1
                    end = max(end, s[1])
                    at = end
                kept = b"".join([*kept, raw[at:]])
                out.append((len(raw), len(raw) - len(kept), n_spans, hashlib.sha256(kept).hexdigest(), kept if with_text else None))
            n, removed, n_spans, sha, kept = zip(*out) if out else ((),) * 5
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(x, pa.int64()) for x in (n, removed, n_spans)], pa.array(sha, pa.string()), pa.array(kept, pa.binary())], ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_bytes"])

    spans = spans.select(F.col("id").alias("span_id"), F.col("t").alias("span_t"), "spans")
    joined = rows.join(spans, F.col("id").eqNullSafe(F.col("span_id")) & (F.col("t") == F.col("span_t")), "left")
    out = joined.select("id", "raw", "spans").mapInArrow(remove, f"id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_bytes binary")
    return (out if with_text else out.drop("kept_bytes")).withColumnRenamed("id", id_col)
