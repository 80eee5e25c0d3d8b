"""Tracking tables from CSV files whose headers drift."""

from __future__ import annotations

import csv

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.values import na_to_null
from ..session import _delete
from . import clip_files

# The channels of a tracking table.
BOX = ["FaceRectX", "FaceRectY", "FaceRectWidth", "FaceRectHeight"]
LANDMARKS_X = [f"x_{i}" for i in range(68)]
LANDMARKS_Y = [f"y_{i}" for i in range(68)]
POSE = ["Pitch", "Roll", "Yaw"]
ACTION_UNITS = [f"AU{n:02d}" for n in (1, 2, 4, 5, 6, 7, 9, 10, 11, 12, 14, 15, 17, 20, 23, 24, 25, 26, 28, 43)]
CHANNELS = [*BOX, *LANDMARKS_X, *LANDMARKS_Y, *POSE, *ACTION_UNITS]

_INDEX = ("", "Unnamed: ")


def csv_lines(spark: SparkSession, root: str, pattern: str = "*.csv") -> DataFrame:
    """``path, at, line, header``: the lines of all files under ``root`` after each one's first.

    ``at`` orders a file's lines, also where the file is split over tasks. Lines meet their
    header by path, the partitioning that numbering rows needs anyway.
    """
    text = spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").text(root)
    at = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("place"))
    text = text.select(F.col("_metadata.file_path").alias("path"), at.alias("at"), F.col("value").alias("line"))
    first = Window.partitionBy("path").orderBy("at")
    numbered = text.withColumns({"header": F.first("line").over(first), "__n": F.row_number().over(first)})
    return numbered.where("__n > 1").drop("__n")


def file_headers(spark: SparkSession, root: str, pattern: str = "*.csv") -> DataFrame:
    """``path, header`` of every file: the first line of its first block, a row a file in the shuffle."""
    text = spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").text(root)
    begins = text.where(F.col("_metadata.file_block_start") == 0).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("line"), F.monotonically_increasing_id().alias("place"))
    return begins.groupBy("path").agg(F.min_by("line", "place").alias("header"))


def header_names(header: Column) -> Column:
    """The names in a header line, index columns left out."""
    names = F.transform(F.split(header, ","), lambda n: F.regexp_replace(n, '^"|"$', ""))
    return F.filter(names, lambda n: (n != _INDEX[0]) & ~n.startswith(_INDEX[1]))


def channel_report(headers: DataFrame, required: list[str]) -> DataFrame:
    """By file: required channels that its header lacks, in required order, and whether it may be filtered."""
    lacking = F.filter(F.array(*map(F.lit, required)), lambda c: ~F.array_contains(header_names(F.col("header")), c))
    return headers.select("path", lacking.alias("missing")).withColumn("status", F.when(F.size("missing") > 0, "missing_channels").otherwise("ok"))


def column_report(headers: DataFrame, column: str) -> DataFrame:
    """By file: null if it has the column, else a message with its first 25 columns."""
    names = F.transform(F.split("header", ","), lambda n: F.regexp_replace(n, '^"|"$', ""))
    said = F.concat(F.lit(f"no column {column}; the table has "), F.array_join(F.slice(names, 1, 25), ", "))
    return headers.select("path", F.when(~F.array_contains(names, column), said).alias("message"))


def read_clip(spark: SparkSession, place: str, channels: list[str], pattern: str = "*.csv") -> DataFrame:
    """One clip's table, as :func:`read_tracking` gives it; an error that names the place if nothing lies there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(place)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        raise FileNotFoundError(f"no clip at {place}")
    return read_tracking(spark, place, channels, pattern)


def read_tracking(spark: SparkSession, root: str, channels: list[str], pattern: str = "*.csv", na_tokens: bool = True) -> DataFrame:
    """All files as one table: ``path, row_idx``, the channels as doubles, other columns as text.

    Every line is parsed by its own file's header, so that no value moves under another name;
    leading index columns (blank or ``Unnamed``) give the row order and are dropped. A file without
    one is numbered in the order of its lines. Columns that only some files have are null
    elsewhere. The driver sees the distinct headers, never the files; a line is one row, so quoted
    line breaks are not supported.
    """
    lines = csv_lines(spark, root, pattern)
    headers = [r["header"] for r in file_headers(spark, root, pattern).select("header").distinct().orderBy("header").collect()]
    if not headers:
        raise ValueError("no rows to read")
    parsed: dict[str, Column] = {}
    order = F.lit(None).cast("long")
    for h, header in enumerate(headers):
        names = next(csv.reader([header]))
        index = [i for i, n in enumerate(names) if n == _INDEX[0] or n.startswith(_INDEX[1])]
        own = F.col("header") == header
        lines = lines.withColumn(f"__{h}", F.when(own, F.from_csv("line", ", ".join(f"c{i} string" for i in range(len(names))))))
        for i, name in enumerate(names):
            value = F.col(f"__{h}.c{i}")
            if i in index:
                order = F.when(own, value.try_cast("long")).otherwise(order) if i == index[-1] else order
                continue
            value = na_to_null(value) if na_tokens else value
            value = value.try_cast("double") if name in channels else value
            parsed[name] = F.coalesce(parsed[name], value) if name in parsed else value
    table = lines.select("path", "at", order.alias("__index"), *[c.alias(n) for n, c in parsed.items()])
    per = Window.partitionBy("path").orderBy(F.col("__index").asc_nulls_first(), "at")
    return table.withColumn("row_idx", (F.row_number().over(per) - 1).cast("long")).drop("__index", "at")


def write_clips(df: DataFrame, folder: str, codec: str = "zstd") -> None:
    """A dataset by channel and actor; partitions written anew replace only themselves."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", codec).partitionBy("channel", "actor").parquet(folder)


def write_clip_csv(df: DataFrame, folder: str, order: list[str] | None = None) -> DataFrame:
    """A CSV export without an index, a folder with one file for each clip's channel, actor and stem.

    It replaces what is in ``folder``, from which ``df`` must not be read. A clip's rows stand in ``order``.
    The result is ``path, length, rows`` and the keys of every file. Values are written as Spark writes CSV.
    """
    spark = df.sparkSession
    keys = ["channel", "actor", "stem"]
    names = [c for c in df.columns if c not in keys]
    header = spark.range(1).select(F.to_csv(F.struct(*[F.lit(n).alias(f"c{i}") for i, n in enumerate(names)]))).first()[0]
    line = F.to_csv(F.struct(*[F.col(f"`{n}`") for n in names])).alias("__line")
    lines = df.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*keys, *(order or [])])], line)
    _delete(spark, folder)
    return clip_files.write_lines(lines, folder, keys, order or [], "__line", ".csv", header)
