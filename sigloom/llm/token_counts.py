"""Token counts: batch encoding in Arrow functions that return lengths only."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship
from . import bpe
from .batches import by_bytes

#: Between two words: a character that is no white space, then one blank and no white space.
_SAFE = re.compile(r"(?<=\S) (?=\S)")


def safe_parts(text: str, most: int) -> list[str]:
    """``text`` in parts of about ``most`` characters, cut only before a blank between two words.

    Byte-level pre-tokenisation always starts a token at such a blank, so the parts' ids are the
    text's ids. A text without such a place stays whole.
    """
    parts, start = [], 0
    while len(text) - start > most:
        m = _SAFE.search(text, start + most)
        if not m:
            break
        parts.append(text[start : m.start()])
        start = m.start()
    return [*parts, text[start:]]


def balanced(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of neighbours whose sizes sum to about ``most``; each holds one at least."""
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and total + n > most:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def token_counts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = 1024,
    path: str = bpe.DEFAULT,
    batch_bytes: int = 1 << 20,
    part_chars: int = 1 << 16,
) -> DataFrame:
    """``(id, n_bytes, n_tokens, over_limit)`` for every row, repeated rows included.

    A null or empty text has 0 bytes and 0 tokens; a null id stays null. Other columns are not
    read. Texts over ``part_chars`` are cut at safe boundaries for byte-level vocabularies and
    encoded whole for others. Each call of the encoder takes texts and parts of about
    ``batch_bytes``. Nothing is shuffled, and a task holds one Arrow batch.
    """
    ship(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = bpe.encoder(path)
        for batch in by_bytes(batches, 1):
            parts: list[str] = []
            owner: list[int] = []
            n_bytes = batch.column(2).to_pylist()
            for row, text in enumerate(batch.column(1).to_pylist()):
                own = safe_parts(text, part_chars) if enc._tik and len(text) > part_chars else [text]
                parts += own
                owner += [row] * len(own)
            tokens = [0] * batch.num_rows
            sizes = [len(p) if p.isascii() else len(p.encode("utf-8", "surrogatepass")) for p in parts]
            for lo, hi in balanced(sizes, batch_bytes):
                for row, n in zip(owner[lo:hi], enc.counts(parts[lo:hi])):
                    tokens[row] += n
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(tokens, pa.int64()), pa.array([n > limit for n in tokens])], ["id", "n_bytes", "n_tokens", "over_limit"])

    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.octet_length(text).cast("long").alias("n_bytes"))
    kind = rows.schema["id"].dataType.simpleString()
    out = rows.mapInArrow(count, f"id {kind}, n_bytes long, n_tokens long, over_limit boolean")
    return out.withColumnRenamed("id", id_col)
