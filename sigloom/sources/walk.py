"""Directory listings walked by tasks, folder by folder, instead of planned on the driver."""

from __future__ import annotations

import fnmatch
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import released, settled, ship

_SCHEMA = "path string, folder boolean, length long, modified timestamp, status string"


_NAMES = ["path", "folder", "length", "modified", "status"]
_TYPES = [pa.string(), pa.bool_(), pa.int64(), pa.timestamp("us", "UTC"), pa.string()]
#: Entries that a task holds before it hands them on.
_HELD = 10_000


def store(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a qualified path, and the path in it; of a local one as it is written, escapes and blanks too."""
    return (pafs.LocalFileSystem(), uri[7:]) if uri.startswith("file://") else pafs.FileSystem.from_uri(uri)


def dealt(places: DataFrame, per_task: int = 1024) -> DataFrame:
    """Rows that cost a look at a folder or file each, over tasks of ``per_task`` at most; few rows still keep all cores busy."""
    n = places.count()
    return places.repartition(max(1, -(-n // per_task), min(n, places.sparkSession.sparkContext.defaultParallelism)))


def _children(batches: Iterator[pa.RecordBatch], uri: str, pattern: str) -> Iterator[pa.RecordBatch]:
    """What lies directly in each folder; a folder that is not there, or that cannot be read, says so."""
    fs, _ = store(uri)
    scheme = uri.split(":", 1)[0] if "://" in uri else "file"
    rows: list[tuple] = []
    for batch in batches:
        for place in batch.column(0).to_pylist():
            path = place.split("://", 1)[-1]
            try:
                infos = fs.get_file_info(pafs.FileSelector(path))
                rows += [(f"{scheme}://{i.path}", i.type == pafs.FileType.Directory, i.size if i.is_file else None, i.mtime, None) for i in infos if i.type == pafs.FileType.Directory or fnmatch.fnmatch(i.base_name, pattern)]
            except FileNotFoundError:
                rows.append((place, True, None, None, "missing"))
            except OSError as e:
                rows.append((place, True, None, None, f"unreadable: {e}"[:500]))
            while len(rows) >= _HELD:
                yield _entries(rows[:_HELD])
                rows = rows[_HELD:]
    if rows:
        yield _entries(rows)


def _entries(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _TYPES)], _NAMES)


def walk(spark: SparkSession, folders: DataFrame, pattern: str = "*", deep: bool = True, hidden: bool = False, per_task: int = 1024) -> DataFrame:
    """``path, length, modified, status`` of the files under the folders of ``folders (path)``.

    Each round lists one level: its folders are dealt out over tasks, at most ``per_task`` each, and what
    they hold is written; the folders among it are the next round's. So there are as many rounds as levels, the driver
    sees no path, and one folder is one task's listing. Files match ``pattern`` by name and have
    status ``listed``; a folder that is not there is a row with status ``missing``, one that
    cannot be read has ``unreadable`` and the reason: the walk goes on. Names that begin with ``.`` or ``_`` are left out
    unless ``hidden``. A folder given twice is walked once. Nothing to walk gives no rows.
    """
    ship(spark)
    uri = None
    found, todo = [], settled(folders.select("path").distinct(), "folders")
    first = todo.first()
    if first:
        uri = qualified(spark, first["path"])
    while not todo.isEmpty():
        name = F.substring_index("path", "/", -1)
        level = dealt(todo, per_task).mapInArrow(lambda batches: _children(batches, uri, pattern), _SCHEMA)
        if not hidden:
            level = level.where(F.col("status").isNotNull() | ~(name.startswith(".") | name.startswith("_")))
        level = settled(level, "level")
        released(todo)
        found.append(level.where("not folder or status is not null"))
        if not deep:
            break
        todo = settled(level.where("folder and status is null").select("path"), "folders")
    out = spark.createDataFrame([], "path string, length long, modified timestamp, status string")
    for level in found:
        out = out.unionByName(level.select("path", "length", "modified", F.coalesce("status", F.lit("listed")).alias("status")))
    return out


def qualified(spark: SparkSession, folder: str) -> str:
    """``folder`` with the scheme that Spark reads it by, as ``pyarrow.fs`` takes it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    uri = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return uri.replace("file:/", "file:///", 1) if uri.startswith("file:/") and not uri.startswith("file://") else uri
