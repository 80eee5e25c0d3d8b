"""Exact dedup by skew-safe combining: local, then salted, then global winners."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALTS = 64  # the ways to a class are kept as the bits of one long


def exact_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", normal: Column | None = None, salts: int = SALTS) -> DataFrame:
    """One row per input row: ``id, keep_id, group_size, kept, text_sha256``.

    Rows are equal when their (normalised) texts are; of equal rows the one with the largest id
    stays. Every step groups by digest *and* text, so texts are compared in full. Each task first
    combines its own rows of a class to one; these are merged under the task's salt (its number
    modulo ``salts``), and the salts' winners over all. So a group of any size leaves a task as one
    row and meets in one task as ``salts`` rows at most. Each row finds its winner by its digest
    and a salt of its id, of which the class keeps a list; two texts under one digest would fail
    the job there.

    Null texts count as empty and form one class. Null ids lose to any other id; a class of null
    ids only has a null ``keep_id`` and every row of it is kept. Rows that repeat an id all are
    kept if that id wins. An empty table gives no rows; other columns are not read.
    """
    assert 1 <= salts <= SALTS
    text = normal if normal is not None else F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text")).withColumn("digest", F.sha2("text", 256)).withColumn("way", F.pmod(F.xxhash64("id"), F.lit(salts)).cast("int"))
    local = rows.withColumn("salt", F.spark_partition_id() % salts)
    salted = local.groupBy("digest", "salt", "text").agg(F.max("id").alias("top"), F.count("*").alias("n"), F.expr("bit_or(shiftleft(1L, way))").alias("ways"))
    winners = salted.groupBy("digest", "text").agg(F.max("top").alias("keep_id"), F.sum("n").alias("group_size"), F.expr("bit_or(ways)").alias("ways"))
    bits = F.expr(f"filter(sequence(0, {salts - 1}), s -> (ways & shiftleft(1L, s)) != 0)")
    places = winners.select("digest", "keep_id", "group_size", F.explode(bits).alias("way"))
    # One digest and way must lead to one text: a second one is a digest collision.
    places = places.groupBy("digest", "way").agg(F.max("keep_id").alias("keep_id"), F.max("group_size").alias("group_size"), F.count("*").alias("texts")).withColumn("group_size", F.when(F.col("texts") == 1, F.col("group_size")).otherwise(F.raise_error(F.lit("two texts under one digest")).cast("long")))
    out = rows.select("id", "digest", "way").join(places.drop("texts"), ["digest", "way"])
    return out.select(F.col("id").alias(id_col), "keep_id", "group_size", F.coalesce(F.col("id") == F.col("keep_id"), F.col("keep_id").isNull()).alias("kept"), F.col("digest").alias("text_sha256"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Rows that repeat both the id and the text of a winner are one row in the result. See
    :func:`exact_classes` for the steps, nulls and ties.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    hashed = [F.col(f"`{f.name}`") for f in docs.schema.fields if "map<" not in f.dataType.simpleString()]
    # The row's other columns travel in a struct of their own, so that no name of theirs can clash; the text is the grouping key itself.
    others = [c for c in docs.columns if c != text_col]
    rest = F.struct(F.col(f"`{text_col}`").isNotNull().alias("set"), F.struct(*[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(others)]).alias("row"))
    rank = F.struct(F.col(id_col), F.xxhash64(*hashed).alias("tie"))
    local = docs.select(F.sha2(text, 256).alias("digest"), (F.spark_partition_id() % salts).alias("salt"), text.alias("text"), rest.alias("rest"), rank.alias("rank"))
    one = local.groupBy("digest", "salt", "text").agg(F.max_by("rest", "rank").alias("rest"), F.max("rank").alias("rank"))
    best = one.groupBy("digest", "text").agg(F.max_by("rest", "rank").alias("rest"))
    return best.select(*[(F.when(F.col("rest.set"), F.col("text")) if c == text_col else F.col(f"rest.row.c{others.index(c)}")).alias(c) for c in docs.columns])
