"""Versioned clip datasets: a run writes the clips that it changed, a manifest says which files count.

``data/run=<id>/clip=<key>/`` holds the clips that a run wrote, a file each; ``versions/<number>/`` is a manifest
``clip, run`` of a whole version. Tasks write and read the files, the driver lists none. A manifest is written beside and published by one rename, so a
reader sees a version whole or not at all, and files of unchanged clips are never touched. The store
must rename a folder as one step (HDFS and local disks do; plain object stores do not).
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from . import clip_files


class VersionConflict(RuntimeError):
    """Another run published the version that this one was to become."""


def _fs(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), spark._jvm.org.apache.hadoop.fs.Path


def latest(spark: SparkSession, root: str) -> int:
    """The number of the newest version, 0 if there is none."""
    fs, path = _fs(spark, root)
    place = path(f"{root}/versions")
    names = [f.getPath().getName() for f in fs.listStatus(place)] if fs.exists(place) else []
    return max((int(n) for n in names if n.isdigit()), default=0)


def manifest(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """``clip, run`` of a version, the newest unless given."""
    version = version or latest(spark, root)
    if not version:
        raise FileNotFoundError(f"no version at {root}")
    return spark.read.schema("clip string, run string").parquet(f"{root}/versions/{version:09d}")


def read_version(spark: SparkSession, root: str, schema: str, version: int | None = None, only: str | None = None) -> DataFrame:
    """The rows of a version: ``clip, run`` and the columns of ``schema``; a column that a file lacks is null.

    Tasks read the folders that the manifest names, and no others are listed or opened. ``only``, a condition on ``clip``
    and ``run``, chooses among them.
    """
    place = F.concat_ws("/", F.lit(f"{clip_files.qualified(spark, root)}/data"), F.concat(F.lit("run="), "run"), clip_files.folder_column("clip"))
    named = manifest(spark, root, version).where(only or "true")
    return clip_files.read_parquet(named.select(place.alias("path"), "clip", "run"), StructType.fromDDL(schema))


def publish(changed: DataFrame, root: str, clip: str, run: str | None = None, dropped: DataFrame | None = None) -> int:
    """Writes the clips of ``changed`` and publishes the version in which they replace what they were; its number.

    ``clip`` names the key column, whose text names folders; it must not be null. Clips that are not in ``changed`` keep
    their files; those in ``dropped`` (a column ``clip``) leave the version. A run that dies before the rename leaves
    files that no manifest names. Of two runs at once the later to publish fails with
    :class:`VersionConflict` and can start again from the new version. A run id may be used once.
    """
    spark = changed.sparkSession
    run = run or uuid.uuid4().hex
    base = latest(spark, root)
    fs, path = _fs(spark, root)
    place = f"{root}/data/run={run}"
    if fs.exists(path(place)):
        raise ValueError(f"run {run} has written to {root} before")
    key = F.col(f"`{clip}`").cast("string")
    keyed = changed.withColumn("clip", F.coalesce(key, F.raise_error(F.lit("a clip without a key"))))
    # The tasks that write the clips say which they wrote, and that is the draft of the manifest.
    draft, final = f"{root}/drafts/{uuid.uuid4().hex}", f"{root}/versions/{base + 1:09d}"
    fs.mkdirs(path(place))
    clip_files.write_parquet(keyed, place, ["clip"]).select("clip", F.lit(run).alias("run")).write.parquet(draft)
    if base:
        written = spark.read.schema("clip string, run string").parquet(draft)
        old = manifest(spark, root, base).join(written, "clip", "left_anti")
        if dropped is not None:
            old = old.join(dropped.select(F.col("clip").cast("string").alias("clip")), "clip", "left_anti")
        old.write.mode("append").parquet(draft)
    fs.mkdirs(path(f"{root}/versions"))
    _rename_new(spark, draft, final)
    return base + 1


def _rename_new(spark: SparkSession, source: str, target: str) -> None:
    """One rename that fails where the target is there; the file system decides between two runs."""
    jvm = spark._jvm
    a, b = jvm.org.apache.hadoop.fs.Path(source), jvm.org.apache.hadoop.fs.Path(target)
    place = a.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(a)
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(place.toUri(), spark._jsc.hadoopConfiguration())
    no_overwrite = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        files.rename(place, b.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(b), no_overwrite)
    except Py4JJavaError as e:
        if "FileAlreadyExistsException" not in str(e.java_exception.getClass().getName()):
            raise
        raise VersionConflict(f"{target} was published by another run") from None


def append_run(report: DataFrame, folder: str, run: str) -> None:
    """Adds a run's rows to a log by run. The same run again replaces its own rows, so a replay leaves one set."""
    report.withColumn("run", F.lit(run)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run").parquet(folder)


def read_runs(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """All logged rows with their ``run``."""
    return spark.read.schema(f"{schema}, run string").parquet(folder)
