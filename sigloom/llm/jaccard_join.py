"""N-gram Jaccard join with set-relation skipping, for the components of its links.

1. Each text becomes a set of hashed shingles. Rows with equal sets are one vertex.
2. Candidates: sets are cut into parts by hash, into more parts than two linked sets can differ
   in, so that linked sets agree in a whole part. Agreeing sets form candidate components.
   Sets that agree by chance chain small groups to large components, the more the larger the
   input is; a large component is parted by finer signatures.
3. Each candidate component is joined in one task (a large one in blocks) on an inverted list
   with blocks by position, skipping what known answers already decide.
"""

from __future__ import annotations

import functools
import math
from collections import defaultdict
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import released, settled, ship
from .batches import by_bytes
from .graph import components
from .shingles import mixed, shingle_sets

_K1, _K2 = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)
_ALL = (1 << 64) - 1
_SHINGLE_BYTES = 6  # about a word and its blank
_MOST_TASKS = 1 << 15  # that buckets are dealt out to
_GATHER = 1 << 21  # signatures of a task that are cut into buckets together
_FEW = 64  # signatures a bucket on average below which they go out as they are
_FINER = ((4, 1), (6, 2))  # shares of a part and how many of them a finer signature leaves out: for large components, then for those still large


class Threshold:
    """Sets link when ``of * intersection >= share * union``: integers, so nothing is rounded."""

    def __init__(self, share: int = 85, of: int = 100):
        assert 0 < share <= of
        self.share, self.of = share, of

    def overlap(self, n: int, m: int) -> int:
        """The smallest intersection with which sets of these sizes link."""
        return -(-self.share * (n + m) // (self.share + self.of))

    def differing(self, most: int) -> int:
        """In how many elements two linked sets of up to ``most`` can differ."""
        return (self.of - self.share) * 2 * most // (self.share + self.of)

    def smallest(self, n: int) -> int:
        """The size under which no set links with one of ``n``."""
        return -(-self.share * n // self.of)

    def largest(self, n: int) -> int:
        return n * self.of // self.share

    def prefix(self, n: int) -> int:
        return n - self.smallest(n) + 1

    def size_class(self, n: int) -> list[tuple[int, int]]:
        """Number and largest size of the class of ``n`` and of the next one.

        Classes are as wide as links reach, so linked sets are of one class or of neighbours.
        """
        k, top = 0, self.largest(1)
        while top < n:
            k, top = k + 1, self.largest(top + 1)
        return [(k, top), (k + 1, self.largest(top + 1))]


def vertex(sets: np.ndarray) -> int:
    """A set's identity: 64 bits from the sum of its mixed hashes and its size."""
    total = int(mixed(sets ^ _K2).sum(dtype=np.uint64)) + len(sets) * int(_K1)
    return int(mixed(np.array([total & _ALL], np.uint64)).view(np.int64)[0])


@functools.cache
def slack_for(d: int, low: int) -> int:
    """Parts to add to ``d + 1`` so that sets of ``low`` elements or more seldom have as many empty ones."""
    slack = 1
    while slack < d:
        parts = d + 1 + slack
        empty = parts * math.exp(-low / parts)
        if slack >= empty + 3 * math.sqrt(empty):
            break
        slack += 1
    return slack


def signatures(own: np.ndarray, t: Threshold, common: np.ndarray) -> np.ndarray:
    """Hashes of which two linked, unequal sets share one at least.

    For a class whose sets differ in up to d elements there are ``d + 1 + slack`` parts, so linked
    sets agree in ``slack + 1`` parts. Elements in ``common`` (sorted) are left out of the parts of
    every set, which lets no two sets differ in more of them, but keeps texts apart that only
    share a well-known passage. Empty parts agree too often to be of use and are left out. A set
    with more than ``slack`` empty parts, which may agree with another in those alone, gives the
    elements of its prefix as well, of which linked sets share one; common ones come last there.
    """
    out, n, sparse = [], len(own), False
    known = np.zeros(n, bool)
    if len(common):
        known = common[np.minimum(np.searchsorted(common, own), len(common) - 1)] == own
    rare = own[~known]
    for k, top in t.size_class(n):
        d = t.differing(top)
        if not d:
            continue
        slack = slack_for(d, t.smallest(t.smallest(top)))
        parts = np.uint64(d + 1 + slack)
        part = ((rare >> np.uint64(32)) * parts) >> np.uint64(32)
        first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])[: len(rare)])
        if len(first):
            sums = np.add.reduceat(mixed(rare ^ _K1), first)
            out.append(mixed(sums + part[first] * _K1 + np.uint64(k * int(_K2) & _ALL)))
        sparse |= int(parts) - len(first) > slack
    if sparse:
        out.append(mixed(np.concatenate([rare, own[known]])[: t.prefix(n)] + _K2))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def finer_signatures(own: np.ndarray, t: Threshold, common: np.ndarray, shares: int, out: int) -> np.ndarray:
    """As :func:`signatures`, of more elements each, so that far fewer unlike sets agree by chance.

    With ``d // (out + 1) + 1 + slack`` parts, linked sets differ in ``out`` elements at most in
    ``slack + 1`` of them. A part is cut into ``shares`` and gives a signature of all but ``out``
    of these, for each choice. A part with elements in ``out`` shares at most, of which a choice
    can leave nothing, may agree so; a set with more than ``slack`` such parts in a class gives its
    plain signatures as well. Sets that agree in such parts alone both do.
    """
    n, found, sparse = len(own), [], False
    rare = own if not len(common) else own[common[np.minimum(np.searchsorted(common, own), len(common) - 1)] != own]
    choices = np.array([*combinations(range(shares), out)])
    for k, top in t.size_class(n):
        d = t.differing(top)
        if not d:
            continue
        parts = d // (out + 1) + 1
        slack = 3 * parts // 20 + 1
        parts += slack
        place = (((rare >> np.uint64(32)) * np.uint64(parts * shares)) >> np.uint64(32)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]])[: len(rare)])
        sums, held = np.zeros((parts, shares), np.uint64), np.zeros((parts, shares), np.int64)
        if len(first):
            sums.ravel()[place[first]] = np.add.reduceat(mixed(rare ^ _K1), first)
            held.ravel()[place[first]] = 1
        left = held.sum(1, keepdims=True) - held[:, choices].sum(2)
        kept = sums.sum(1, keepdims=True, dtype=np.uint64) - sums[:, choices].sum(2, dtype=np.uint64)
        at = np.flatnonzero(left)
        found.append(mixed(kept.ravel()[at] + at.astype(np.uint64) * _K1 + np.uint64(k * int(_K2) & _ALL)))
        sparse |= int((left == 0).any(1).sum()) > slack
    if sparse:
        found.append(signatures(own, t, common))
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def star(sigs: np.ndarray, vertices: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct signatures, the smallest vertex of each, and the other vertices' links to it."""
    order = np.lexsort((vertices, sigs))
    sigs, vertices = sigs[order], vertices[order]
    head = np.concatenate([[True], sigs[1:] != sigs[:-1]]) if len(sigs) else np.zeros(0, bool)
    hub = vertices[np.flatnonzero(head)][np.cumsum(head) - 1] if len(sigs) else vertices
    other = vertices != hub
    links = np.unique(np.stack([hub[other], vertices[other]], 1), axis=0) if other.any() else np.zeros((0, 2), np.int64)
    return sigs[head], vertices[head], links


def packed(sigs: np.ndarray, hubs: np.ndarray) -> bytes:
    """Sorted signatures as differences, byte by byte so that high zero bytes compress; vertices once each."""
    names, index = np.unique(hubs, return_inverse=True)
    steps = np.diff(sigs, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T
    kind = np.uint16 if len(names) <= 1 << 16 else np.uint32
    return b"".join([np.array([len(sigs), len(names)], np.int64).tobytes(), names.tobytes(), steps.tobytes(), index.astype(kind).tobytes()])


def unpacked(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    n, m = np.frombuffer(blob, np.int64, 2)
    names = np.frombuffer(blob, np.int64, m, 16)
    at = 16 + 8 * m
    steps = np.frombuffer(blob, np.uint8, 8 * n, at).reshape(8, n).T.copy().view(np.uint64).ravel()
    index = np.frombuffer(blob, np.uint16 if m <= 1 << 16 else np.uint32, n, at + 8 * n)
    return np.cumsum(steps, dtype=np.uint64), names[index]


def dealt_out(sigs: np.ndarray, hubs: np.ndarray, buckets: int) -> list[pa.Array]:
    """``bucket, sigs, raw`` of sorted signatures: a row for each bucket that any falls in.

    The work follows the signatures, whatever the number of buckets. Where a row would hold few of
    them, rows are slices of one buffer of pairs, and none is packed by itself.
    """
    place = ((sigs >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
    cuts = np.append(np.flatnonzero(np.append(True, place[1:] != place[:-1])[: len(place)]), len(place))
    keys, rows = pa.array(place[cuts[:-1]].astype(np.int32)), len(cuts) - 1
    if len(sigs) >= _FEW * rows:
        return [keys, pa.array([packed(sigs[a:b], hubs[a:b]) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())], pa.binary()), pa.nulls(rows, pa.binary())]
    pairs = np.stack([sigs.view(np.int64), hubs], 1)
    raw = pa.Array.from_buffers(pa.binary(), rows, [None, pa.py_buffer((16 * cuts).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(pairs))])
    return [keys, pa.nulls(rows, pa.binary()), raw]


def _shared(few: np.ndarray, many: np.ndarray) -> int:
    """How many of a few elements are in a sorted set."""
    if not len(few) or not len(many):
        return 0
    at = np.minimum(np.searchsorted(many, few), len(many) - 1)
    return int((many[at] == few).sum())


def join_sets(sets: list[np.ndarray], t: Threshold, sides: list[int] | None = None) -> list[tuple[int, int]]:
    """Links that connect the linked sets of ``sets`` exactly as all links would.

    Sets enter an inverted list by rising size, and each probes the list first with the elements
    of its prefix, rare ones first. A list is kept in blocks of equal position: a block is skipped
    whole if its largest set is too small or its position leaves too few elements to share. A set
    that is connected to a candidate already needs no comparison. Where a similar set's overlap
    with the candidate is known, this one's follows from it: the sizes of their differences bound
    it and often decide, else it is counted over the differences alone, not over the whole sets.
    With ``sides``, only sets of different sides are compared.
    """
    order = sorted(range(len(sets)), key=lambda i: len(sets[i]))
    if len(sets) == 2:
        a, b = (sets[i] for i in order)
        if len(a) < t.smallest(len(b)):
            return []
        return [(0, 1)] if len(np.intersect1d(a, b, assume_unique=True)) >= t.overlap(len(a), len(b)) else []
    flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    tokens, inverse, counts = np.unique(flat, return_inverse=True, return_counts=True)
    rank = np.empty(len(tokens), np.int64)
    rank[np.lexsort((tokens, counts))] = np.arange(len(tokens))
    ranked, at = [], 0
    shared = counts[np.argsort(rank)] > 1
    for s in sets:
        ranked.append(np.sort(rank[inverse[at : at + len(s)]]))
        at += len(s)
    root = list(range(len(sets)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    links: list[tuple[int, int]] = []
    lists: dict[int, dict[int, tuple[list[int], list[int]]]] = defaultdict(dict)
    known: dict[int, dict[int, int]] = defaultdict(dict)  # overlaps by set, then by the other set
    for i in order:
        own, n = ranked[i], len(ranked[i])
        least, seen, helper = t.smallest(n), set(), -1
        more = less = own[:0]  # what this set has and the helper lacks, and the other way round
        prefix = [(p, w) for p, w in enumerate(own[: t.prefix(n)].tolist()) if shared[w]] if n else []
        for p, w in prefix:
            for q, (block_sizes, block_sets) in lists[w].items():
                if block_sizes[-1] < least:
                    continue
                if min(p, q) + 1 + min(n - p, block_sizes[-1] - q) - 1 < t.overlap(n, least):
                    continue
                for m, j in zip(reversed(block_sizes), reversed(block_sets)):
                    if m < least:
                        break
                    if j in seen or (sides and sides[i] == sides[j]):
                        continue
                    seen.add(j)
                    if find(i) == find(j):
                        continue
                    need = t.overlap(n, m)
                    if helper >= 0 and j in known[helper]:
                        with_helper, its = known[i][helper], known[helper][j]
                        if its + n - with_helper < need:  # all of i that the helper lacks would not do
                            continue
                        if its + with_helper - len(ranked[helper]) >= need:
                            links.append((i, j))
                            root[find(i)] = find(j)
                            continue
                        # The helper's computed answer, less what only it shares, and with what only this set shares.
                        both = its - _shared(less, ranked[j]) + _shared(more, ranked[j])
                    else:
                        both = int(np.intersect1d(own, ranked[j], assume_unique=True).size)
                    known[i][j] = known[j][i] = both
                    if both >= need:
                        links.append((i, j))
                        root[find(i)] = find(j)
                        if helper < 0 or both > known[i][helper]:
                            helper = j
                            more, less = np.setdiff1d(own, ranked[j], assume_unique=True), np.setdiff1d(ranked[j], own, assume_unique=True)
        for p, w in prefix:
            sizes, members = lists[w].setdefault(p, ([], []))
            sizes.append(n)
            members.append(i)
    return links


def jaccard_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, threshold: Threshold | None = None, bucket_bytes: int = 8 << 20, group_bytes: int = 4 << 20, most_common: int = 1 << 17
) -> DataFrame:
    """One row per input row: id, ``n_shingles``, ``component_id``.

    ``component_id`` is the smallest id that links lead to, the row's own included. Rows with
    equal sets link; a row whose text is null, empty or all white space has no shingles, links
    with nothing and is its own component. Rows with null ids link like others, and give a component
    no id where it has another; one of null ids alone has a null id. Rows that repeat an id are
    rows of their own. An empty table gives no rows; other columns are not read.

    Sets are identified by 64-bit hashes of 64-bit shingle hashes. Signatures meet in buckets whose
    number follows their measured bytes; a task reads its buckets in order and holds one of about
    ``bucket_bytes`` at a time, and writes a link once. A candidate component over
    ``group_bytes`` of text is parted by finer signatures; one that still is as large is cut into blocks, each joined by itself and with one leading set;
    then what is not connected to the leader is joined with every block. Sets that are alike, as
    in a large group of near copies, so cost a group's size and not its square, and no task holds
    more than two blocks.
    """
    found = _placed(docs, id_col, text_col, words, threshold or Threshold(), bucket_bytes, group_bytes, most_common)
    return found.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id")


def _placed(docs: DataFrame, id_col: str, text_col: str, words: int, t: Threshold, bucket_bytes: int = 8 << 20, group_bytes: int = 4 << 20, most_common: int = 1 << 17) -> DataFrame:
    """``id, t, n, component_id``, see :func:`jaccard_components`; ``t`` is the text's hash, as ids can be null or repeated."""
    spark = ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("t"))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "t", "n", "v", "h", "k"]
        for batch in by_bytes(batches, 1, 8 << 20):
            n, v, found = [], [], []
            for own in shingle_sets(batch.column(1).to_pylist(), words):
                n.append(len(own))
                v.append(vertex(own) if len(own) else None)
                found.append(own)
            none = pa.nulls(len(n), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(n, pa.int64()), pa.array(v, pa.int64()), none, none], names)
            h, k = np.unique(np.concatenate(found), return_counts=True)
            h, k = h[k > 2], k[k > 2]
            none = pa.nulls(len(h), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.nulls(len(h), batch.column(0).type), none, none, none, pa.array(h.view(np.int64)), pa.array(k.astype(np.int64))], names)

    measured = settled(rows.mapInArrow(measure, f"id {kind}, t long, n long, v long, h long, k long"), "sets")
    sets = measured.where("h is null").select("id", "t", "n", "v")
    total = sets.agg(F.sum("n")).first()[0] or 0

    # Well-known shingles only steer how sets are dealt out, so a bounded list of the most common will do.
    counted = measured.where("h is not null").groupBy("h").agg(F.sum("k").alias("n"))
    common = np.sort(np.array([r["h"] for r in counted.orderBy(F.desc("n"), "h").limit(most_common).collect()], np.int64).view(np.uint64))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Bucket after bucket; links that a task finds again in its next bucket are not written again."""
        now, held = None, []
        links = np.zeros((0, 2), np.int64)

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(links[:, 0]), pa.array(links[:, 1])], ["a", "b"])

        for batch in batches:
            for i in range(batch.num_rows):
                bucket, sigs, raw, own = (c[i].as_py() for c in batch.columns)
                if bucket != now and held:
                    links = np.unique(np.concatenate([links, star(*map(np.concatenate, zip(*held)))[2]]), axis=0)
                    held = []
                now = bucket
                if sigs:
                    held.append(unpacked(sigs))
                if raw:
                    pairs = np.frombuffer(raw, np.int64).reshape(-1, 2)
                    held.append((np.ascontiguousarray(pairs[:, 0]).view(np.uint64), pairs[:, 1]))
                if own:
                    links = np.unique(np.concatenate([links, np.frombuffer(own, np.int64).reshape(-1, 2)]), axis=0)
                if len(links) > 1 << 20:
                    yield rows()
                    links = links[:0]
        if held:
            links = np.unique(np.concatenate([links, star(*map(np.concatenate, zip(*held)))[2]]), axis=0)
        if len(links):
            yield rows()

    def candidates(texts: DataFrame, shingles: int, finer: tuple[int, int] | None = None) -> DataFrame:
        """``(v, c)`` of sets that signatures connect; finer ones connect only within the ``c`` that stands beside the text."""
        # A signature has 8 bytes, and a set about half as many signatures as shingles; finer ones are more.
        buckets = max(1, -(-4 * shingles * (math.comb(*finer) if finer else 1) // bucket_bytes))

        def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            met: set[int] = set()  # sets of this task: copies give the same signatures
            found, owner, waiting = [], [], 0

            def flushed() -> Iterator[pa.RecordBatch]:
                sigs, hubs, links = star(np.concatenate(found), np.concatenate(owner))
                columns = dealt_out(sigs, hubs, buckets)
                yield pa.RecordBatch.from_arrays([*columns, pa.nulls(len(columns[0]), pa.binary())], names)
                if len(links):
                    yield pa.RecordBatch.from_arrays([pa.array([int(links[0, 1] % buckets)], pa.int32()), *[pa.nulls(1, pa.binary())] * 2, pa.array([links.tobytes()], pa.binary())], names)

            names = ["bucket", "sigs", "raw", "links"]
            for batch in by_bytes(batches, 0, 8 << 20):
                within = mixed(batch.column(1).to_numpy().view(np.uint64)) if finer else None
                for i, own in enumerate(shingle_sets(batch.column(0).to_pylist(), words)):
                    if len(own) and (v := vertex(own)) not in met:
                        met.add(v)
                        s = mixed(finer_signatures(own, t, common, *finer) ^ within[i]) if finer else signatures(own, t, common)
                        found.append(s)
                        owner.append(np.full(len(s), v, np.int64))
                        waiting += len(s)
                if len(met) > 1 << 20:
                    met.clear()
                if waiting >= _GATHER:
                    yield from flushed()
                    found, owner, waiting = [], [], 0
            if waiting:
                yield from flushed()

        signed = texts.mapInArrow(sign, "bucket int, sigs binary, raw binary, links binary")
        dealt = signed.repartitionById(min(buckets, _MOST_TASKS), "bucket").sortWithinPartitions("bucket")
        return components(dealt.mapInArrow(meet, "a long, b long"))

    def too_large(plan: DataFrame) -> DataFrame:
        """Components over the limit, which are few: their shingles, their leading vertex and into how many blocks they are cut."""
        total = plan.select("c", "v", "n").distinct().groupBy("c").agg(F.sum("n").alias("total"), F.min("v").alias("leader"))
        return settled(total.where(F.col("total") > limit).withColumn("blocks", F.ceil(F.col("total") / limit).cast("int")), "large")

    # One document stands for each candidate vertex; its text goes to its component's group.
    first = F.min(F.struct(F.col("id").isNull(), "id", "t"))
    one = sets.where("v is not null").groupBy("v").agg(first.alias("first"), F.min("n").alias("n")).select("v", "n", "first.id", "first.t")
    chosen = one.join(candidates(rows.select("text"), total), "v").select("v", "n", "c", F.col("id").alias("its_id"), F.col("t").alias("its_t"))
    plan = chosen.join(rows, F.col("its_id").eqNullSafe(F.col("id")) & (F.col("its_t") == F.col("t")))
    plan = settled(plan.select("c", "v", "n", "text"), "plan")
    limit = max(1, group_bytes // _SHINGLE_BYTES)
    wide = too_large(plan)
    for finer in _FINER:
        if wide.isEmpty():
            break
        # What met by chance, and so more often the more texts there are, is parted before anything is compared in blocks.
        coarse, names = plan, F.broadcast(wide.select("c"))
        again = coarse.join(names, "c")
        parts = candidates(again.select("text", "c"), wide.agg(F.sum("total")).first()[0], finer)
        parted = again.drop("c").join(parts, "v").select("c", "v", "n", "text")
        plan = settled(coarse.join(names, "c", "left_anti").select("c", "v", "n", "text").unionAll(parted), "plan")
        released(coarse)
        wide = too_large(plan)
    groups = max(1, -(-(plan.agg(F.sum("n")).first()[0] or 0) // limit))
    block = F.pmod(F.xxhash64("v"), F.col("blocks").cast("long")).cast("int")
    stored, plan = plan, plan.join(F.broadcast(wide.drop("total")), "c", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1))).withColumn("block", block)
    small = plan.where("blocks = 1").select(F.pmod(F.xxhash64("c"), F.lit(groups)).alias("g"), F.lit(-1).alias("part"), "c", "v", F.lit(0).alias("side"), "text")

    def verify(table: pa.Table) -> pa.Table:
        by: dict[int, dict[tuple, tuple]] = defaultdict(dict)
        for c, v, side, own in zip(*(table.column(x).to_pylist() for x in ("c", "v", "side")), shingle_sets(table.column("text").to_pylist(), words)):
            if (v, side) not in by[c] and len(own) and vertex(own) == v:
                by[c][v, side] = own
        links: list[tuple[int, int]] = []
        for group in by.values():
            vs = list(group)
            sides = [side for _, side in vs]
            found = join_sets([group[k] for k in vs], t, sides if len(set(sides)) > 1 else None)
            links += [(vs[i][0], vs[j][0]) for i, j in found if vs[i][0] != vs[j][0]]
        a, b = zip(*links) if links else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    def linked_in(groups: DataFrame) -> DataFrame:
        return groups.groupBy("g", "part").applyInArrow(verify, "a long, b long")

    # A large component: each block by itself and with the leader, which links what is alike.
    large = plan.where("blocks > 1")
    if large.isEmpty():
        linked = components(linked_in(small))
    else:
        every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
        blocks = large.select(F.col("c").alias("g"), F.col("block").alias("part"), "c", "v", F.lit(0).alias("side"), "text")
        leaders = large.where("v = leader").select(F.col("c").alias("g"), every.alias("part"), "c", "v", F.lit(0).alias("side"), "text")
        links = settled(linked_in(small.unionAll(blocks).unionAll(leaders)), "links")
        # Only what the leader did not reach can still lack a link: that against all blocks.
        own = large.select("c", "v", "n", "leader").join(components(links).withColumnRenamed("c", "own"), "v", "left").withColumn("own", F.coalesce("own", "v"))
        led = settled(own.where("v = leader").select("c", F.col("own").alias("led")), "led")
        apart = settled(own.join(led, "c").where("own <> led").select("c", "v", "n"), "apart")
        parts = settled(apart.groupBy("c").agg(F.ceil(F.sum("n") / limit).cast("int").alias("parts")), "parts")
        rest = large.join(apart.select("v"), "v").join(parts, "c").withColumn("r", F.pmod(F.xxhash64("v", F.lit(1)), F.col("parts").cast("long")).cast("int"))
        rest = rest.select("c", "v", "text", "r", "blocks", every.alias("b"))
        met = large.join(parts, "c").select("c", "v", "text", "block", "blocks", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("r"))
        pair = lambda df, b, side: df.select(F.col("c").alias("g"), (F.col("r") * F.col("blocks") + F.col(b)).alias("part"), "c", "v", F.lit(side).alias("side"), "text")
        linked = components(links.unionAll(linked_in(pair(rest, "b", 0).unionAll(pair(met, "block", 1)))))
    released(stored)
    rooted = one.join(linked, "v", "left").select("v", "id", F.coalesce("c", "v").alias("root"))
    least = settled(rooted.groupBy("root").agg(F.min("id").alias("component_id")), "least")  # a plain join side, whose hot keys can be split
    place = rooted.join(least, "root").select("v", "component_id")
    out = sets.join(place, "v", "left")
    return out.select("id", "t", "n", F.when(F.col("v").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"))


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, threshold: Threshold | None = None) -> DataFrame:
    """The rows of ``docs``, all columns, that have the smallest id of their component.

    See :func:`jaccard_components`; texts without shingles all stay, and so do rows with null ids.
    Rows go by id and text: one that repeats the id of a near copy stays.
    """
    found = _placed(docs, id_col, text_col, words, threshold or Threshold(80, 100))
    gone = settled(found.where("id <> component_id").select("id", "t").distinct(), "gone")
    return docs.join(gone, (docs[id_col] == gone["id"]) & (F.xxhash64(docs[text_col]) == gone["t"]), "left_anti")
