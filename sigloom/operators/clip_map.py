"""Functions of the user's on whole clips: any number of rows out, and failures that stay with their clip.

Clips are brought together by one exchange and stream through a task in order, so that it holds one
clip, what the function made of it, and one Arrow batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..session import ship
from .series import _clip_starts, _same_clip

#: Gets the clip's key and its rows in order; gives rows in one table or several.
ClipFunction = Callable[[tuple, pa.Table], pa.Table | pa.RecordBatch | Iterable]

_MESSAGE = 2000


def clip_tables(batches: Iterable[pa.RecordBatch], clip: list[str]) -> Iterator[tuple[tuple, pa.Table]]:
    """Each clip's key and table from batches in which a clip's rows follow each other."""
    held: list[pa.RecordBatch] = []

    def whole() -> tuple[tuple, pa.Table]:
        return tuple(held[0].column(c)[0].as_py() for c in clip), pa.Table.from_batches(held)

    for batch in batches:
        if not batch.num_rows:
            continue
        starts = _clip_starts(batch, clip).tolist()
        if held and not _same_clip(held[-1], batch, clip):
            yield whole()
            held = []
        for a, b in zip(starts, [*starts[1:], batch.num_rows]):
            if a:
                yield whole()
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield whole()


def _results(made: pa.Table | pa.RecordBatch | Iterable, schema: pa.Schema) -> Iterator[pa.Table]:
    """What a function gave, in the declared columns and types; an error if it does not fit them."""
    for part in [made] if isinstance(made, (pa.Table, pa.RecordBatch)) else made:
        table = pa.Table.from_batches([part]) if isinstance(part, pa.RecordBatch) else part
        if lacking := [n for n in schema.names if n not in table.column_names]:
            raise ValueError(f"the function gave no column {lacking}")
        yield table.select(schema.names).cast(schema)


def _in_order(df: DataFrame, clip: list[str], order: list[str]) -> DataFrame:
    return ship(df.sparkSession) and df.repartition(*[F.col(f"`{c}`") for c in clip]).sortWithinPartitions(*[F.col(f"`{c}`") for c in [*clip, *order]])


def _clip_columns(key: tuple, n: int, types: list[pa.DataType]) -> list[pa.Array]:
    return [pa.repeat(pa.scalar(k, t), n) if k is not None else pa.nulls(n, t) for k, t in zip(key, types)]


def map_clips(df: DataFrame, clip: list[str], order: list[str], fn: ClipFunction, schema: str) -> DataFrame:
    """The clip columns and the rows of ``schema`` (DDL) that ``fn`` makes of each clip; the first exception ends the job.

    A clip without rows out is absent. Null keys are a clip of their own. An empty table gives no rows.
    """
    rows = StructType.fromDDL(schema)
    keys = [df.schema[c] for c in clip]
    if clash := [c for c in clip if c in rows.names]:
        raise ValueError(f"the schema names clip columns: {clash}")
    want, types = to_arrow_schema(rows), [to_arrow_schema(StructType([k])).field(0).type for k in keys]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, table in clip_tables(batches, clip):
            for part in _results(fn(key, table), want):
                for batch in part.combine_chunks().to_batches():
                    yield pa.RecordBatch.from_arrays([*_clip_columns(key, batch.num_rows, types), *batch.columns], [*clip, *rows.names])

    return _in_order(df, clip, order).mapInArrow(run, StructType([*keys, *rows.fields]))


def map_clips_isolated(df: DataFrame, clip: list[str], order: list[str], fn: ClipFunction, schema: str, errors: tuple[type[BaseException], ...] = (Exception,)) -> DataFrame:
    """As :func:`map_clips`, but a clip whose function raises one of ``errors`` gives one row with the message.

    The result is a tagged union in one pass: rows of the function in the struct ``row``, and for
    each clip one row with ``outcome`` (``written`` or ``failed``), ``n_rows`` and ``message``. A clip's rows are held
    until its function has ended, so a clip has all of them or none; rows that do not fit the schema
    are a failure of their clip too. Write the result once, then read its two sides with
    :func:`clip_rows` and :func:`clip_outcomes`.
    """
    rows = StructType.fromDDL(schema)
    keys = [df.schema[c] for c in clip]
    tags = [StructField("outcome", StringType()), StructField("n_rows", LongType()), StructField("message", StringType()), StructField("row", rows)]
    if clash := [c for c in clip if c in {t.name for t in tags}]:
        raise ValueError(f"clip columns {clash} are names of the result")
    want, types = to_arrow_schema(rows), [to_arrow_schema(StructType([k])).field(0).type for k in keys]
    row_type = pa.struct(list(want))
    names = [*clip, *[t.name for t in tags]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, table in clip_tables(batches, clip):
            try:
                made, message = list(_results(fn(key, table), want)), None
            except errors as e:
                made, message = [], f"{type(e).__name__}: {e}"[:_MESSAGE]
            for part in made:
                for batch in part.combine_chunks().to_batches():
                    n = batch.num_rows
                    row = pa.StructArray.from_arrays(batch.columns, fields=list(want))
                    yield pa.RecordBatch.from_arrays([*_clip_columns(key, n, types), pa.nulls(n, pa.string()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.string()), row], names)
            n_rows = sum(p.num_rows for p in made)
            said = ["failed" if message is not None else "written"]
            yield pa.RecordBatch.from_arrays([*_clip_columns(key, 1, types), pa.array(said), pa.array([n_rows], pa.int64()), pa.array([message], pa.string()), pa.nulls(1, row_type)], names)

    return _in_order(df, clip, order).mapInArrow(run, StructType([*keys, *tags]))


def clip_rows(tagged: DataFrame, clip: list[str]) -> DataFrame:
    """The rows of the clips that went well."""
    return tagged.where(F.col("outcome").isNull()).select(*[F.col(f"`{c}`") for c in clip], "row.*")


def clip_outcomes(tagged: DataFrame, clip: list[str]) -> DataFrame:
    """One row per clip: ``outcome``, ``n_rows``, ``message``."""
    return tagged.where(F.col("outcome").isNotNull()).select(*[F.col(f"`{c}`") for c in clip], "outcome", "n_rows", "message")
