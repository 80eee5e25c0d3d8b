"""A file for each clip, written and read by tasks.

Spark's file writers and readers keep every file's name on the driver, which renames the files of a
job and plans those of a scan one by one. Here a task writes each of its clips to its own folder
``key=value/...`` and reports it in a row; the rows, as Spark commits them, say what is there. A
clip's draft is renamed when it is whole, so a task that runs again replaces what it wrote. Rows
stream through a task, sorted, so a clip may have any size. The store must be one that
``pyarrow.fs`` knows.
"""

from __future__ import annotations

import io
import uuid
from collections.abc import Callable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StringType, StructField, StructType

from ..session import settled, ship
from .walk import dealt, qualified, store

NO_KEY = "__HIVE_DEFAULT_PARTITION__"
_WRITTEN = "path string, length long, rows long"
#: Spark's: what it replaces in the names of partition folders.
_ESCAPED = {c: f"%{ord(c):02X}" for c in [*map(chr, range(1, 32)), *"\"#%'*/:=?\\\x7f{[]^"]}
#: Most reports in a batch, and most rows in one.
_REPORTS, _ROWS = 1_000, 10_000


def folder_name(key: str, value: str | None) -> str:
    """The folder of a key's value as Spark names it; null and empty share one."""
    return f"{key}={''.join(_ESCAPED.get(c, c) for c in value) if value else NO_KEY}"


def folder_column(key: str) -> Column:
    """:func:`folder_name` of a text column."""
    value = F.col(f"`{key}`")
    for sign in sorted(_ESCAPED, key=lambda c: c != "%"):
        value = F.replace(value, F.lit(sign), F.lit(_ESCAPED[sign]))
    return F.concat(F.lit(f"{key}="), F.when(F.length(F.col(f"`{key}`")) > 0, value).otherwise(NO_KEY))


class _Lines:
    """Text lines after a header, if there is one."""

    def __init__(self, out, header: str | None):
        self.out = out
        if header is not None:
            out.write(f"{header}\n".encode())

    def write(self, rows: pa.RecordBatch) -> None:
        self.out.write("".join(f"{line}\n" for line in rows.column(0).to_pylist()).encode())

    def close(self) -> None:
        pass


class _Parquet:
    def __init__(self, out, schema: pa.Schema):
        self.file = pq.ParquetWriter(out, schema, compression="snappy")

    def write(self, rows: pa.RecordBatch) -> None:
        self.file.write_batch(rows)

    def close(self) -> None:
        self.file.close()


def _runs(batch: pa.RecordBatch, n_keys: int) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Neighbouring rows of one clip, with its keys."""
    keys = [batch.column(i) for i in range(n_keys)]
    new = np.zeros(max(batch.num_rows - 1, 0), bool)
    for key in keys:
        new |= pc.not_equal(key[1:], key[:-1]).to_numpy(zero_copy_only=False)
    rows = batch.select(range(n_keys, batch.num_columns))
    cuts = [0, *(np.flatnonzero(new) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield tuple(key[a].as_py() for key in keys), rows.slice(a, b - a)


def _write(batches: Iterator[pa.RecordBatch], uri: str, keys: list[str], suffix: str, open_clip: Callable) -> Iterator[pa.RecordBatch]:
    """Writes each clip to its file and reports it."""
    fs, root = store(uri)
    scheme = uri.split(":", 1)[0]
    held, now = [], None
    types = [pa.string(), pa.int64(), pa.int64(), *[pa.string()] * len(keys)]
    report = lambda: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], ["path", "length", "rows", *keys])

    def close() -> None:
        clip.close()
        length, final = out.tell(), f"{place}/part-0{suffix}"
        out.close()
        try:
            fs.move(draft, final)
        except OSError:  # A store that renames onto no file: an earlier try left this clip's.
            fs.delete_file(final)
            fs.move(draft, final)
        held.append((f"{scheme}://{final}", length, n, *now))

    for batch in batches:
        for values, rows in _runs(batch, len(keys)):
            if values != now:
                if now is not None:
                    close()
                now, n = values, 0
                place = "/".join([root, *map(folder_name, keys, values)])
                draft = f"{place}/.{uuid.uuid4().hex}{suffix}"
                fs.create_dir(place, recursive=True)
                out = fs.open_output_stream(draft)
                clip = open_clip(out, rows.schema)
            clip.write(rows)
            n += rows.num_rows
        if len(held) >= _REPORTS:
            yield report()
            held = []
    if now is not None:
        close()
    if held:
        yield report()


def _written(df: DataFrame, folder: str, keys: list[str], order: list[str], keep: list[str], suffix: str, open_clip: Callable) -> DataFrame:
    """Every clip's rows in one task, side by side and in ``order``, to the clip's file."""
    spark = ship(df.sparkSession)
    uri = qualified(spark, folder)
    at = [f"__key_{i}" for i in range(len(keys))]
    text = [F.coalesce(F.col(f"`{k}`").cast("string"), F.lit("")).alias(a) for k, a in zip(keys, at)]
    rows = df.select(*text, *[F.col(f"`{c}`") for c in dict.fromkeys([*order, *keep])]).repartition(*at).sortWithinPartitions(*at, *[F.col(f"`{c}`") for c in order])
    reports = f"{_WRITTEN}, " + ", ".join(f"`{k}` string" for k in keys)
    return rows.select(*at, *[F.col(f"`{c}`") for c in keep]).mapInArrow(lambda batches: _write(batches, uri, keys, suffix, open_clip), reports)


def write_lines(df: DataFrame, folder: str, keys: list[str], order: list[str], line: str, suffix: str, header: str | None = None) -> DataFrame:
    """A text file for each clip, of the column ``line``: ``path, length, rows`` and the keys of what is written."""
    return settled(_written(df, folder, keys, order, [line], suffix, lambda out, schema: _Lines(out, header)), "clip-files")


def write_parquet(df: DataFrame, folder: str, keys: list[str]) -> DataFrame:
    """A Parquet file for each clip: ``path, length, rows`` and the keys. It is lazy and writes whenever it is run, so run it once."""
    keep = [c for c in df.columns if c not in keys]
    return _written(df, folder, keys, [], keep, ".parquet", _Parquet)


def read_lines(files: DataFrame, skip: int = 1) -> DataFrame:
    """``path, line`` of all files of ``files (path)`` after the first ``skip`` lines; blank lines are left out, no line break may stand in a value."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[str]] = [[], []]
        for batch in batches:
            for path in batch.column(0).to_pylist():
                fs, place = store(path)
                with fs.open_input_stream(place) as f:
                    text = io.TextIOWrapper(f, encoding="utf-8-sig")
                    for _ in islice(text, skip):
                        pass
                    while lines := [x.rstrip("\n") for x in islice(text, _ROWS)]:
                        lines = [x for x in lines if x.strip()]
                        held[0] += [path] * len(lines)
                        held[1] += lines
                        if len(held[0]) >= _ROWS:
                            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in held], ["path", "line"])
                            held = [[], []]
        if held[0]:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in held], ["path", "line"])

    ship(files.sparkSession)
    return dealt(files.select("path")).mapInArrow(read, "path string, line string")


def read_csv(files: DataFrame, schema: str) -> DataFrame:
    """The rows of all CSV files of ``files (path)``, whose columns are those of ``schema`` in order."""
    return read_lines(files).select(F.from_csv("line", schema).alias("row")).select("row.*")


def _fitting(rows: pa.RecordBatch, schema: pa.Schema) -> list[pa.Array]:
    """The columns of ``schema``; those that a file lacks are null."""
    there = set(rows.schema.names)
    return [pc.cast(rows.column(f.name), f.type) if f.name in there else pa.nulls(rows.num_rows, f.type) for f in schema]


def read_parquet(folders: DataFrame, schema: StructType) -> DataFrame:
    """The rows in the folders of ``folders (path, ...)``: its other columns, which are text, then those of ``schema``."""
    ship(folders.sparkSession)
    beside = [c for c in folders.columns if c != "path"]
    arrow, out = to_arrow_schema(schema), StructType([*[StructField(c, StringType()) for c in beside], *schema.fields])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        n = 0
        for batch in batches:
            for row in batch.to_pylist():
                fs, place = store(row["path"])
                for info in fs.get_file_info(pafs.FileSelector(place)):
                    if not info.is_file or info.base_name[0] in "._":
                        continue
                    with fs.open_input_file(info.path) as f:
                        file = pq.ParquetFile(f)
                        for rows in file.iter_batches(_ROWS, columns=[c for c in arrow.names if c in file.schema_arrow.names]):
                            held.append(pa.RecordBatch.from_arrays([*[pa.repeat(pa.scalar(row[c], pa.string()), rows.num_rows) for c in beside], *_fitting(rows, arrow)], [*beside, *arrow.names]))
                            n += rows.num_rows
                            if n >= _ROWS:
                                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                                held, n = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    return dealt(folders).mapInArrow(read, out)
