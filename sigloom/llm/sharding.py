"""K-d tree sharding with column functions only: weighted medians by distributed histograms."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import settled

_BITS = 24  # of a dimension's value, and of the hash that orders equal values
_BINS = 8192
_ALL = (1 << 63) - 1


class Tree:
    """A k-d tree as lists by node: the root is 1, the halves of ``n`` are ``2 n`` and ``2 n + 1``.

    ``parts`` is how many shards a node holds and ``first`` the first of them. A node of one shard
    hands all its rows to its low half.
    """

    def __init__(self, dims: list[str], shards: int):
        self.dims, self.depth = dims, 0
        self.parts, self.first = [0, shards], [0, 0]
        self.dim, self.cut = [0, 0], [_ALL, _ALL]

    def level(self) -> range:
        """The nodes that rows are in now."""
        return range(1 << self.depth, 2 << self.depth)

    def node(self) -> Column:
        """The node of the last level that a row falls into."""
        keys, dim, cut = F.array(*self.dims), _by_node(self.dim), _by_node(self.cut)
        step = lambda n, _: n * 2 + (F.get(keys, F.get(dim, n)) >= F.get(cut, n)).cast("int")
        return F.aggregate(F.array_repeat(F.lit(0), self.depth), F.lit(1), step)

    def place(self) -> Column:
        """The shard that a row falls into."""
        return F.get(_by_node(self.first), self.node()).cast("int")

    def split(self) -> None:
        """Adds a level of halves under the last one, whose cuts are known."""
        for n in self.level():
            k, first = self.parts[n], self.first[n]
            low = k // 2 if k > 1 else k
            self.parts += [low, k - low]
            self.first += [first, first + low]
        self.depth += 1
        self.dim += [0] * len(self.level())
        self.cut += [_ALL] * len(self.level())


def _by_node(values: list) -> Column:
    """A list by node as one constant."""
    return F.lit(np.array(values))


def kd_tree(points: DataFrame, dims: list[str], shards: int, weight: str = "size", spread: float = 1e-4) -> Tree:
    """Splits ``points`` recursively until each leaf is one shard.

    A node of k shards is cut along the dimension that spans the largest part of its whole range,
    where ``k // 2`` of its k shares of weight lie below. ``points`` is scanned once for the
    ranges and two to four times for the cuts of a whole level, without a shuffle of its rows. Sums
    by bin meet in a task for each node, at most ``_BINS`` of them, and the driver gets one row a
    node, so that the tree alone is held there. A cut is exact to ``spread`` of its node's weight
    or to one key. Nodes without rows stay empty, and so does every node of an empty table.
    """
    tree, whole = Tree(dims, shards), None
    while max(tree.parts[n] for n in tree.level()) > 1:
        at = points.withColumn("node", tree.node()).where(F.get(_by_node(tree.parts), F.col("node")) > 1)
        sums = [F.sum(weight).alias("w"), *[f(d).alias(f"{d}_{f.__name__}") for d in dims for f in (F.min, F.max)]]
        seen = {r["node"]: r for r in at.groupBy("node").agg(*sums).collect()}
        whole = whole or seen.get(1)
        goal = [0.0] * len(tree.parts)
        search: dict[int, tuple[int, int, int]] = {}  # by node: low key, high key, weight below low
        for n, r in seen.items():
            tree.dim[n] = max(range(len(dims)), key=lambda i, r=r: (r[f"{dims[i]}_max"] - r[f"{dims[i]}_min"]) / max(1, whole[f"{dims[i]}_max"] - whole[f"{dims[i]}_min"]))
            d = dims[tree.dim[n]]
            search[n] = r[f"{d}_min"], r[f"{d}_max"] + 1, 0
            goal[n] = r["w"] * (tree.parts[n] // 2) / tree.parts[n]
        while search:
            lists = [[0] * len(tree.parts) for _ in range(4)]
            for n, (lo, hi, before) in search.items():
                for values, value in zip(lists, (lo, hi, before, max(1, -(-(hi - lo) // _BINS)))):
                    values[n] = value
            low, high, below, width = (F.get(_by_node(x), F.col("node")) for x in lists)
            key = F.get(F.array(*dims), F.get(_by_node(tree.dim), F.col("node")))
            rows = at.select("node", weight, key.alias("key")).where((F.col("key") >= low) & (F.col("key") < high))
            bins = rows.groupBy("node", F.floor((F.col("key") - low) / width).cast("long").alias("bin")).agg(F.sum(weight).alias("w"))
            run = bins.withColumn("run", below + F.sum("w").over(Window.partitionBy("node").orderBy("bin")))
            hits = run.where(F.col("run") >= F.get(_by_node(goal), F.col("node"))).groupBy("node").agg(F.min(F.struct("bin", "run", "w")).alias("hit"))
            found = {r["node"]: r["hit"] for r in hits.collect()}
            for n, (lo, hi, _) in list(search.items()):
                step = lists[3][n]
                if n not in found:
                    tree.cut[n] = hi
                    del search[n]
                    continue
                b, total, w = found[n]
                start, end, before = lo + b * step, min(hi, lo + (b + 1) * step), total - w
                if step == 1 or w <= spread * seen[n]["w"]:
                    tree.cut[n] = end if total - goal[n] < goal[n] - before else start
                    del search[n]
                else:
                    search[n] = start, end, before
        tree.split()
    return tree


def kd_shards(docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text", rows_a_task: int = 50_000, target_bytes: int | None = None) -> DataFrame:
    """One row per input row: id, ``size, text_crc32, law, shard, slot, grown_shard``.

    Nodes are split until they are one of ``shards`` equal shares or, with ``target_bytes``, one of
    as many shares as leave about that much in each, whatever ``shards`` says.

    The law is ``bytes``: sizes (UTF-8 bytes of the text plus 8) are near equal. The dimensions
    are length, bytes per character and line length of the text, each followed by a hash of the
    text where values tie. All depend on the text alone, so equal texts share a shard without any
    join, and a group of copies of any size meets in no task. Where such a group outweighs a
    shard, its shard is that much larger: groups are not split.

    ``slot`` numbers a shard's rows without gaps: rows are counted by shard and a hash of the id,
    and each count's rows are numbered by themselves. A null text has 0 bytes; null ids and
    repeated rows get slots of their own; an empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    n_bytes, n_chars = F.octet_length(text), F.char_length(text)
    lines = F.length(F.regexp_replace(text, r"[^\n]+", "")) + 1
    unit = {"k_length": F.log2(n_bytes + 1) / 40, "k_width": (n_bytes + 1) / (n_chars + 1) / 4, "k_line": F.log2(n_bytes / lines + 1) / 40}
    tie = F.shiftrightunsigned(F.xxhash64(text), 64 - _BITS)
    keys = [(F.floor(F.least(u, F.lit(1.0)) * ((1 << _BITS) - 1)).cast("long") * (1 << _BITS) + tie).alias(k) for k, u in unit.items()]
    points = settled(docs.select(F.col(id_col).alias("id"), (n_bytes + 8).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), *keys), "points")
    total, weight = points.agg(F.count("*"), F.sum("size")).first()
    if target_bytes:
        shards = max(1, -(-(weight or 0) // target_bytes))
    placed = points.withColumn("shard", kd_tree(points, list(unit), shards).place())
    parts = max(1, -(-total // (shards * rows_a_task)))
    placed = placed.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int"))
    counts = placed.groupBy("shard", "part").agg(F.count("*").alias("n"))
    starts = counts.select("shard", "part", (F.sum("n").over(Window.partitionBy("shard").orderBy("part")) - F.col("n")).alias("start"))
    numbered = placed.withColumn("rank", F.row_number().over(Window.partitionBy("shard", "part").orderBy("id", "text_crc32")))
    out = numbered.join(starts, ["shard", "part"])
    return out.select(F.col("id").alias(id_col), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("start") + F.col("rank") - 1).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
