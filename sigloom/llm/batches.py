"""Arrow batches in pieces of bounded bytes."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame


def by_bytes(batches: Iterable[pa.RecordBatch], column: int, most: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of the batches, without a copy, that hold about ``most`` bytes in a text or binary column.

    A batch counts rows, whatever their length; Python objects made from it should not. A longer
    text is a slice of its own.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        part = np.cumsum(sizes) // most
        cuts = np.flatnonzero(np.diff(part)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
            yield batch.slice(a, b - a)


def filter_rows(docs: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> DataFrame:
    """``docs`` through ``fn`` in tasks, which keeps all columns; these go by number there, as names may hold dots."""
    plain = docs.toDF(*[f"c{k}" for k in range(len(docs.columns))])
    return plain.mapInArrow(fn, plain.schema).toDF(*docs.columns)
