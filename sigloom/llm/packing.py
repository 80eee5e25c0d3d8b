"""Packing into fixed windows by minimum bin slack.

Documents become pieces: whole windows of ``capacity`` ids, and a remainder. Remainders are packed
by their lengths alone: for each window a subset-sum DP over the multiset of remaining lengths, on
the bits of one integer, finds the fill closest to capacity and is walked back to the counts used.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship
from . import bpe
from .batches import by_bytes

_SEQUENCES = 33  # low bits of a sequence id that number a task's sequences


def least_slack(counts: list[int], capacity: int) -> dict[int, int]:
    """Counts by length, with the largest length left among them, whose sum comes closest to ``capacity``.

    ``counts[n]`` is how many pieces of length ``n`` are left; one at least must be. Bit ``s`` of
    the reach is set if lengths seen so far can sum to ``s``; a length with ``c`` pieces enters in
    binary parts 1, 2, 4, ... of ``c``. The scan ends as soon as the window can be filled exactly.
    """
    top = next(n for n in range(capacity, 0, -1) if counts[n])
    room = capacity - top
    mask, reach = (1 << (room + 1)) - 1, 1
    steps: list[tuple[int, int, int]] = []  # length, how many at once, reach before
    for n in range(min(top, room), 0, -1):
        left = min(counts[n] - (n == top), room // n)
        part = 1
        while left > 0:
            k = min(part, left)
            steps.append((n, k, reach))
            reach |= (reach << (n * k)) & mask
            left -= k
            part *= 2
        if reach >> room & 1:
            break
    at = reach.bit_length() - 1
    used = {top: 1}
    for n, k, before in reversed(steps):
        if not before >> at & 1:
            used[n] = used.get(n, 0) + k
            at -= n * k
    return used


def pack_lengths(lengths: list[int], capacity: int) -> Iterator[list[int]]:
    """Indices of ``lengths`` (1 to ``capacity``) by window. A found fill is used as often as counts allow."""
    by_length: list[list[int]] = [[] for _ in range(capacity + 1)]
    for i, n in enumerate(lengths):
        by_length[n].append(i)
    counts = [len(x) for x in by_length]
    left = len(lengths)
    while left:
        used = least_slack(counts, capacity)
        for _ in range(min(counts[n] // k for n, k in used.items())):
            members = []
            for n, k in used.items():
                counts[n] -= k
                left -= k
                members += [by_length[n].pop() for _ in range(k)]
            yield members


def pack_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = 1024,
    end_id: int = 0,
    path: str = bpe.DEFAULT,
    most_pieces: int = 1 << 20,
) -> DataFrame:
    """One row per piece: ``id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    Each document is encoded once, ended by ``end_id`` and cut at every ``capacity`` ids; whole
    windows are sequences of their own, remainders share sequences by :func:`pack_lengths`. Each
    task packs its own rows and keeps lengths and checksums only, never ids; beyond
    ``most_pieces`` remainders it packs what it has and starts anew. Nothing is shuffled. A
    sequence id is the task's partition number and a running number, so it is unique.

    A null or empty text is one piece, the end id. Repeated rows are packed once each; null ids
    stay null; an empty table gives no rows; other columns are not read.
    """
    ship(docs.sparkSession)
    end = struct.pack("<I", end_id)
    kind = docs.schema[id_col].dataType.simpleString()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, number = bpe.encoder(path), TaskContext.get().partitionId() << _SEQUENCES
        rests: list[tuple] = []

        def rows(out: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
            ids, *numbers = zip(*out)
            return pa.RecordBatch.from_arrays([pa.array(ids, id_type), *[pa.array(x, pa.int64()) for x in numbers]], ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

        def flush(id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
            nonlocal number, rests
            out = []
            for members in pack_lengths([r[2] for r in rests], capacity):
                offset = 0
                for i in members:
                    out.append((*rests[i], number, offset))
                    offset += rests[i][2]
                number += 1
                if len(out) > 50_000:
                    yield rows(out, id_type)
                    out = []
            if out:
                yield rows(out, id_type)
            rests = []

        id_type = None
        for batch in by_bytes(batches, 1):
            id_type = batch.column(0).type
            out = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = enc.id_bytes(text) + end
                n = len(ids) // 4
                for start in range(0, n - capacity + 1, capacity):
                    out.append((doc, start, capacity, zlib.crc32(ids[4 * start : 4 * (start + capacity)]), n, number, 0))
                    number += 1
                if rest := n % capacity:
                    rests.append((doc, n - rest, rest, zlib.crc32(ids[4 * (n - rest) :]), n))
            if out:
                yield rows(out, id_type)
            if len(rests) >= most_pieces:
                yield from flush(id_type)
        if rests:
            yield from flush(id_type)

    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    out = rows.mapInArrow(pack, f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
    return out.withColumnRenamed("id", id_col)
