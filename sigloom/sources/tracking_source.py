"""Tracking tables as a Spark data source: planned by file, each parsed once under its own header.

``spark.read.format("tracking_csv")`` after :func:`register`; :func:`read_tracking_files` does both
and finds the columns. A task takes whole files of together about ``groupBytes``, and parses each in
Arrow blocks; only the columns of the requested schema are converted. Headers may all differ: the
plan holds one schema, not an expression for each.
"""

from __future__ import annotations

import csv
import fnmatch
import io
import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.csv as pacsv
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..functions.values import NA_TOKENS
from ..session import ship

FORMAT = "tracking_csv"
PATH, ROW, NAMES = "path", "row_idx", "names"
_HEADERS = f"{PATH} string, {NAMES} array<string>"


@dataclass
class FileGroup(InputPartition):
    files: list[tuple[str, int]]


def is_index(name: str) -> bool:
    """Whether a header names an index column: blank, or what a second writing made of a blank."""
    return name == "" or name.startswith("Unnamed: ")


def file_names(stream) -> tuple[list[str], int]:
    """The names in a file's header, and how many lines it takes."""
    rows = csv.reader(io.TextIOWrapper(stream, encoding="utf-8-sig", newline=""))
    return next(rows, []), rows.line_num


def numbers(text: pa.Array) -> pa.Array:
    """Text as doubles; what is no number is null."""
    text = pc.utf8_trim_whitespace(text)
    try:
        return pc.cast(text, pa.float64())
    except pa.ArrowInvalid:
        return pa.array([_number(x) for x in text.to_pylist()], pa.float64())


def _number(x: str | None) -> float | None:
    try:
        return float(x) if x is not None and "_" not in x else None
    except ValueError:
        return None


def places(index: np.ndarray) -> np.ndarray:
    """0-based place of each row in the order of its index value, rows of equal ones in file order."""
    if (index[1:] >= index[:-1]).all():
        return np.arange(len(index))
    out = np.empty(len(index), np.int64)
    out[np.argsort(index, kind="stable")] = np.arange(len(index))
    return out


class TrackingFile:
    """One file: its header, and its columns by number as text, block by block."""

    def __init__(self, fs: pafs.FileSystem, path: str, na: bool, block: int):
        self.fs, self.path, self.na, self.block = fs, path, na, block
        with fs.open_input_file(path) as f:
            self.names, self.lines = file_names(f)
        self.index = max((i for i, n in enumerate(self.names) if is_index(n)), default=None)

    def blocks(self, wanted: list[int]) -> Iterator[pa.RecordBatch]:
        """Columns ``c<i>`` of text. Rows of another width than the header send the rest of the file to a parser that pads and cuts them."""
        if not self.names:
            return
        every = [f"c{i}" for i in range(len(self.names))]
        only = [f"c{i}" for i in wanted] or every[:1]
        read = pacsv.ReadOptions(column_names=every, skip_rows=self.lines, block_size=self.block, use_threads=False)
        convert = pacsv.ConvertOptions(column_types={c: pa.string() for c in only}, include_columns=only, null_values=NA_TOKENS if self.na else [""], strings_can_be_null=True, quoted_strings_can_be_null=True)
        done = 0
        try:
            with self.fs.open_input_stream(self.path) as f:
                for batch in pacsv.open_csv(f, read, pacsv.ParseOptions(newlines_in_values=True), convert):
                    yield batch
                    done += batch.num_rows
        except pa.ArrowInvalid as e:
            if "Empty CSV file" in str(e):
                return
            yield from self._slow(only, done)

    def _slow(self, only: list[str], skip: int) -> Iterator[pa.RecordBatch]:
        nulls = set(NA_TOKENS if self.na else [""])
        at = [int(c[1:]) for c in only]
        with self.fs.open_input_file(self.path) as f:
            rows = csv.reader(io.TextIOWrapper(f, encoding="utf-8-sig", newline=""))
            next(rows, None)
            held: list[list] = []
            for row in rows:
                if not row:
                    continue
                if skip:
                    skip -= 1
                    continue
                held.append([None if i >= len(row) or row[i] in nulls else row[i] for i in at])
                if len(held) >= 10_000:
                    yield _text_batch(held, only)
                    held = []
            if held:
                yield _text_batch(held, only)

    def order(self) -> np.ndarray:
        """The index column's values; rows without a number come first."""
        parts = [_whole(b.column(0)) for b in self.blocks([self.index])]
        return np.concatenate(parts) if parts else np.zeros(0, np.int64)


def _text_batch(rows: list[list], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows)], names)


def _whole(text: pa.Array) -> np.ndarray:
    return np.nan_to_num(numbers(text).to_numpy(zero_copy_only=False), nan=-(2.0**62)).astype(np.int64)


class TrackingReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self.columns, self.arrow = schema.names, to_arrow_schema(schema)
        self.root, self.pattern = options["path"], options.get("pattern", "*.csv")
        self.na = options.get("naTokens", "true").lower() == "true"
        self.group, self.block = int(options.get("groupBytes", 32 << 20)), int(options.get("blockBytes", 4 << 20))
        self.whole = int(options.get("wholeBytes", 64 << 20))
        self.only: set[str] | None = None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Equality of the path chooses files before any is opened; all else stays with Spark."""
        for f in filters:
            if isinstance(f, (EqualTo, In)) and tuple(f.attribute) == (PATH,):
                chosen = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.only = chosen if self.only is None else self.only & chosen
            else:
                yield f

    def _uri(self, path: str) -> str:
        scheme = self.root.split(":", 1)[0] if ":" in self.root else "file"
        return f"{scheme}://{path}"

    def partitions(self) -> list[FileGroup]:
        fs, root = pafs.FileSystem.from_uri(self.root)
        found = fs.get_file_info(pafs.FileSelector(root, recursive=True)) if fs.get_file_info(root).type == pafs.FileType.Directory else [fs.get_file_info(root)]
        files = sorted((f.path, f.size) for f in found if f.is_file and fnmatch.fnmatch(f.base_name, self.pattern) and f.base_name[0] not in "._")
        groups, size = [], self.group
        for path, n in files:
            if self.only is not None and self._uri(path) not in self.only:
                continue
            if size + n > self.group:
                groups.append(FileGroup([]))
                size = 0
            groups[-1].files.append((path, n))
            size += n
        return groups

    def read(self, partition: FileGroup) -> Iterator[pa.RecordBatch]:
        fs, _ = pafs.FileSystem.from_uri(self.root)
        for path, size in partition.files:
            file = TrackingFile(fs, path, self.na, self.block)
            if self.columns == [PATH, NAMES]:
                yield pa.RecordBatch.from_arrays([pa.array([self._uri(path)]), pa.array([file.names], pa.list_(pa.string()))], schema=self.arrow)
            else:
                yield from self._rows(file, size)

    def _rows(self, file: TrackingFile, size: int) -> Iterator[pa.RecordBatch]:
        at = {n: i for i, n in reversed(list(enumerate(file.names)))}
        here = [at[c] for c in self.columns if c in at and c not in (PATH, ROW)]
        ranked = ROW in self.columns and file.index is not None
        order = None
        if ranked and size <= self.whole:
            batches = list(file.blocks([*here, file.index]))
            if batches:
                order = places(np.concatenate([_whole(b.column(f"c{file.index}")) for b in batches]))
        else:
            # A large file's index is read ahead of its rows, so that no more than that is held.
            order = places(file.order()) if ranked else None
            batches = file.blocks(here)
        done = 0
        for b in batches:
            n = b.num_rows
            out = []
            for field in self.arrow:
                if field.name == PATH:
                    out.append(pa.repeat(pa.scalar(self._uri(file.path), pa.string()), n))
                elif field.name == ROW:
                    out.append(pa.array(order[done : done + n] if order is not None else np.arange(done, done + n), pa.int64()))
                elif field.name not in at:
                    out.append(pa.nulls(n, field.type))
                else:
                    text = b.column(f"c{at[field.name]}")
                    out.append(numbers(text) if pa.types.is_floating(field.type) else text)
            yield pa.RecordBatch.from_arrays(out, schema=self.arrow)
            done += n


class TrackingSource(DataSource):
    """Options: ``path`` (a folder or a file), ``pattern``, ``naTokens``, ``groupBytes`` a task, ``blockBytes`` a block, ``wholeBytes`` up to which a file is held to put its rows in order."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return _HEADERS

    def reader(self, schema: StructType) -> DataSourceReader:
        return TrackingReader(schema, self.options)


def register(spark: SparkSession) -> SparkSession:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    ship(spark).dataSource.register(TrackingSource)
    return spark


def _uri(spark: SparkSession, root: str) -> str:
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        raise FileNotFoundError(f"no tracking table at {root}")
    uri = fs.makeQualified(path).toString()
    return uri.replace("file:/", "file:///", 1) if uri.startswith("file:/") and not uri.startswith("file://") else uri


def tracking_headers(spark: SparkSession, root: str, pattern: str = "*.csv") -> DataFrame:
    """``path, names``: the header of every file, read in tasks; no rows are parsed."""
    return register(spark).read.format(FORMAT).schema(_HEADERS).option("pattern", pattern).load(_uri(spark, root))


def read_tracking_files(spark: SparkSession, root: str, channels: list[str], columns: list[str] | None = None, pattern: str = "*.csv", na_tokens: bool = True) -> DataFrame:
    """``path, row_idx``, then ``columns`` of all files under ``root``: channels as doubles, others as text.

    Without ``columns`` all names of all headers but those of index columns are taken, channels first; they are found
    by a pass over the headers, of which the driver gets the distinct names. Columns that a file
    lacks are null in its rows; of names that a header repeats the first counts. ``row_idx`` orders a file's rows by its last index column, rows of
    equal or no index in file order. Values may hold quoted line breaks. Numbers that cannot be
    read are null; rows too short are padded with nulls and rows too long cut. A file without rows
    gives none. A filter ``path = ...`` opens only that file.
    """
    register(spark)
    if columns is None:
        names = tracking_headers(spark, root, pattern).select(F.explode(NAMES).alias("n")).distinct()
        found = {r["n"] for r in names.collect() if not is_index(r["n"])} - {PATH, ROW}
        columns = [*[c for c in channels if c in found], *sorted(found.difference(channels))]
    fields = [f"{PATH} string", f"{ROW} long", *[f"`{c.replace('`', '``')}` {'double' if c in channels else 'string'}" for c in columns]]
    return spark.read.format(FORMAT).schema(", ".join(fields)).option("pattern", pattern).option("naTokens", json.dumps(na_tokens)).load(_uri(spark, root))
