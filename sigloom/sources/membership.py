"""What is already done, by output path: a split-block Bloom filter before an exact anti-join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import settled

_WORDS = 8
#: Keys a block of 8 x 64 bits: 16 bits a key, which lets about 1 in 1,000 strangers through.
_KEYS = 32
#: Blocks of at most this many are broadcast: 64 MB of bits.
MOST_BLOCKS = 1 << 20


def _masks(key: Column) -> list[Column]:
    """One bit in each word, chosen by six bits of a second hash."""
    h = F.xxhash64(key, F.lit(1))
    return [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int")) for i in range(_WORDS)]


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def bloom_blocks(keys: DataFrame, key: str, blocks: int) -> DataFrame:
    """``block, w0 .. w7``: the filter's blocks that any key falls in, one row each, combined in tasks first."""
    bits = keys.select(_block(F.col(key), blocks).alias("block"), *[m.alias(f"m{i}") for i, m in enumerate(_masks(F.col(key)))])
    return bits.groupBy("block").agg(*[F.bit_or(f"m{i}").alias(f"w{i}") for i in range(_WORDS)])


def new_tasks(tasks: DataFrame, existing: DataFrame, key: str, most_blocks: int = MOST_BLOCKS) -> DataFrame:
    """The rows of ``tasks`` whose ``key`` is not in ``existing``; existence alone counts.

    The filter is sized by the measured number of existing keys and broadcast. What misses it is
    new for certain and is not shuffled; its hits, about the tasks that are done, meet the
    existing keys in an exact anti-join, so that a false hit drops nothing. Keys beyond what
    ``most_blocks`` blocks serve go to the anti-join alone. A null key is never done.
    """
    known = settled(existing.where(F.col(key).isNotNull()).select(F.col(key).alias("__key")), "existing")
    blocks = max(1, -(-known.count() // _KEYS))
    if blocks > most_blocks:
        return tasks.join(known, F.col(key) == F.col("__key"), "left_anti")
    bits = bloom_blocks(known, "__key", blocks).withColumnRenamed("block", "__block")
    marked = tasks.withColumn("__at", _block(F.col(key), blocks)).join(F.broadcast(bits), F.col("__at") == F.col("__block"), "left")
    inside = F.col("__block").isNotNull() & F.col(key).isNotNull()
    for i, m in enumerate(_masks(F.col(key))):
        inside = inside & (F.col(f"w{i}").bitwiseAND(m) != 0)
    marked = marked.withColumn("__hit", F.coalesce(inside, F.lit(False))).select(*[F.col(f"`{c}`") for c in tasks.columns], "__hit")
    hits = marked.where("__hit").drop("__hit")
    return marked.where("not __hit").drop("__hit").unionByName(hits.join(known, F.col(key) == F.col("__key"), "left_anti"))
