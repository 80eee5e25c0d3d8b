"""Spelling variants by pivotal grams: words at edit distance one, found by rare bigrams that one edit leaves alone.

Bigrams are ordered from rare to common. A word's prefix is its three rarest bigrams and all that
are as common as the third; of these, dynamic programming chooses two disjoint pivots of least total
frequency. One edit leaves one of two disjoint pivots whole, and a whole pivot that stands in the
other word stands in its prefix if that word's prefix reaches at least as far in the order. So of two
near words the one whose prefix ends first has a pivot in the other's prefix. The edit is then all to
one side of it: the words agree up to the pivot's end or from its start on, and the pivot's place moves by
one at most. That is what pivots and prefixes are joined on.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import released, settled, ship
from .batches import by_bytes

LETTERS = "[A-Za-z\\u00C0-\\u00FF]"
_BUCKETS = 1 << 16

Edit = Callable[[object, list[str]], list[str]]


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = 6, letters: str = LETTERS, edit: Edit | None = None, most_words: int = 200_000) -> DataFrame:
    """``word, n``: maximal runs of ``letters`` of at least ``least_chars``, A-Z lower-cased.

    Each task counts its own words and hands on its table whenever that holds ``most_words``; Spark
    adds the counts up, in each task first. ``edit(id, runs)`` may change the runs of a slice of a
    text before they are measured, and may not lengthen them.
    """
    ship(docs.sparkSession)
    pattern = f"{letters}{{{least_chars},}}"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, counts = re.compile(pattern).findall, Counter()

        def table() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"])

        for batch in by_bytes(batches, 1):
            for i, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = find(raw.lower().decode())  # of bytes, lower() knows A-Z only
                counts.update([w for w in edit(i, words) if len(w) >= least_chars] if edit else words)
            if len(counts) >= most_words:
                yield table()
                counts.clear()
        if counts:
            yield table()

    rows = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("raw"))
    return rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def pivots(places: list[int], weights: list[int], k: int, q: int = 2) -> list[int]:
    """``k`` of the grams at ``places`` (rising), no two overlapping, of least total weight; the earliest of equals.

    ``best[j]`` is the least weight of a choice of so many grams that ends with gram ``j`` or before.
    """
    best = [(0, ())] * (len(places) + 1)
    for _ in range(k):
        now: list = [None]
        for j, (p, w) in enumerate(zip(places, weights)):
            fits = next((i for i in range(j, 0, -1) if places[i - 1] + q <= p), 0)
            before = best[fits]
            own = (before[0] + w, (*before[1], p)) if before is not None else None
            now.append(min((x for x in (now[-1], own) if x is not None), default=None))
        best = now
    return list(best[-1][1]) if best[-1] is not None else []


def gram_order(words: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Frequency and rank (rare first) of each of 65,536 buckets that bigrams fall in by checksum.

    The table has this size for any alphabet. Grams of one bucket count as one in the order, which
    loses nothing: all grams up to a rank are in a prefix.
    """
    grams = words.select(F.explode(F.transform(F.sequence(F.lit(1), F.char_length("word") - 1), lambda i: F.substring(F.col("word"), i, F.lit(2)))).alias("gram"))
    found = grams.select((F.crc32(F.col("gram").cast("binary")) % _BUCKETS).cast("int").alias("bucket")).groupBy("bucket").agg(F.count("*").alias("n")).collect()
    weight = np.zeros(_BUCKETS, np.int64)
    for r in found:
        weight[r["bucket"]] = r["n"]
    rank = np.empty(_BUCKETS, np.int32)
    rank[np.lexsort((np.arange(_BUCKETS), weight))] = np.arange(_BUCKETS)
    return weight, rank


def with_grams(words: DataFrame) -> DataFrame:
    """``word, n, last, pivots, prefix``: places (from 0) of two pivots and of the prefix, and the rank where the prefix ends."""
    spark = ship(words.sparkSession)
    order = spark.sparkContext.broadcast(gram_order(words))

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, rank = order.value
        known: dict[str, tuple[int, int]] = {}
        for batch in batches:
            last, chosen, prefix = [], [], []
            for word in batch.column(0).to_pylist():
                own = []
                for p in range(len(word) - 1):
                    gram = word[p : p + 2]
                    if gram not in known:
                        if len(known) > _BUCKETS:
                            known.clear()
                        bucket = zlib.crc32(gram.encode()) % _BUCKETS
                        known[gram] = int(rank[bucket]), int(weight[bucket])
                    own.append(known[gram])
                end = sorted(r for r, _ in own)[min(2, len(own) - 1)]
                places = [p for p, (r, _) in enumerate(own) if r <= end]
                last.append(end)
                prefix.append(places)
                chosen.append(pivots(places, [own[p][1] for p in places], 2))
            ints = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(last, pa.int32()), pa.array(chosen, ints), pa.array(prefix, ints)], ["word", "n", "last", "pivots", "prefix"])

    return words.select("word", "n").mapInArrow(choose, "word string, n long, last int, pivots array<int>, prefix array<int>")


def near_words(words: DataFrame) -> DataFrame:
    """``a, n_a, b, n_b``: all pairs of words at edit distance one, each once, ``a`` before ``b``. Words have four code points at least."""
    grams = settled(with_grams(words), "grams")
    size = F.char_length("word")

    def keys(places: str, lengths: list[int]) -> DataFrame:
        # Of a pivot at p: the same words up to its end if the edit is behind it, from its start on if before it.
        at = grams.select("word", "n", "last", F.explode(places).alias("p"))
        up_to, from_on = F.substring(F.col("word"), F.lit(1), F.col("p") + 2), F.substring(F.col("word"), F.col("p") + 1, size)
        sides = at.select("word", "n", "last", F.explode(F.array(F.xxhash64(F.lit(0), up_to), F.xxhash64(F.lit(1), from_on))).alias("affix"))
        return sides.select("word", "n", "last", F.explode(F.array(*[F.xxhash64("affix", size + d) for d in lengths])).alias("key"))

    a = keys("pivots", [-1, 0, 1]).select("key", F.col("word").alias("x"), F.col("n").alias("n_x"), F.col("last").alias("last_x"))
    b = keys("prefix", [0]).select("key", F.col("word").alias("y"), F.col("n").alias("n_y"), F.col("last").alias("last_y"))
    met = a.join(b, "key").where("last_x <= last_y and x <> y").where(F.levenshtein("x", "y", 1) == 1)
    first = F.col("x") < F.col("y")
    pick = lambda s, t: F.when(first, F.col(s)).otherwise(F.col(t))
    return met.select(pick("x", "y").alias("a"), pick("n_x", "n_y").alias("n_a"), pick("y", "x").alias("b"), pick("n_y", "n_x").alias("n_b")).distinct()


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = 6, least_n: int = 5, times: int = 5, edit: Edit | None = None) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for each word of at least ``least_chars`` and ``least_n`` occurrences.

    Near words differ by one inserted, deleted or replaced code point. A word's form is its near
    word of largest ``n``, the first in code-point order of equals, if that is ``times`` its own at
    least. The root follows forms to the last: as ``n`` grows by ``times`` with every step, chains
    are short, and each round of doubling joins only words that have a form.

    A null or empty text has no words, a very long one is read like any other, repeated rows count
    again, ids matter to ``edit`` only. An empty table gives no rows; other columns are not read.
    """
    assert least_chars >= 4 and times > 1
    words = settled(word_counts(docs, id_col, text_col, least_chars, edit=edit).where(F.col("n") >= least_n), "words")
    links = settled(near_words(words), "near")
    both = links.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("n_b").alias("m")).unionAll(links.select(F.col("b").alias("word"), F.col("a").alias("other"), F.col("n_a").alias("m")))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), F.col("other").alias("form"))).alias("best"))
    judged = words.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(-F.col("best.m") >= times * F.col("n"), F.struct(F.col("best.form").alias("form"), (-F.col("best.m")).alias("n"))).alias("f"))
    judged = settled(judged, "judged")
    steps = settled(judged.where("f is not null").select("word", F.col("f.form").alias("root")), "steps")
    while True:
        ahead = steps.select(F.col("word").alias("root"), F.col("root").alias("further"))
        longer = settled(steps.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "steps")
        more = not longer.where("moved").isEmpty()
        released(steps)
        steps = longer
        if not more:
            break
    out = judged.join(steps.select("word", "root"), "word", "left")
    return out.select("word", F.col("f.form").alias("form"), F.coalesce("root", "word").alias("root"), "n", "n_near", F.col("f.n").alias("form_n"))
