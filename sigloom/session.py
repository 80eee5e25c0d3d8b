"""Session helpers: a local session for tests, shared scratch tables, worker imports."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cpus: int | str = 8, shuffle_partitions: int = 8) -> SparkSession:
    """A local session with the settings that tests and ``bench.py`` use."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("sigloom")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def ship(spark: SparkSession) -> SparkSession:
    """Lets Python workers import this package from where the driver found it.

    On a cluster whose executors do not see this folder, pass the package with ``--py-files``.
    """
    env = spark.sparkContext.environment
    known = env.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in known:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, known)])
    return spark


_own_dirs: dict[str, str] = {}


def scratch_dir(spark: SparkSession) -> str:
    """This application's folder under ``spark.checkpoint.dir``, which all executors share.

    Where that is unset, a local session gets a temporary folder, removed at exit. On a cluster it
    is an error: other machines would not see such a folder.
    """
    app = spark.sparkContext.applicationId
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = _own_dirs.get(app)
        if not folder:
            folder = _own_dirs[app] = tempfile.mkdtemp(prefix="sigloom-")
            atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return f"{folder.rstrip('/')}/sigloom/{app}"


def settled(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: lineage ends there.

    The table outlives any executor, so a later stage never recomputes what stands before it. The
    write's shuffle files are deleted when it ends; else they stay until the driver happens to
    collect its garbage, and those of many steps lie on disk at once.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    schema = df.schema
    before = spark.conf.get(_CLEAN_UP, None)
    spark.conf.set(_CLEAN_UP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(_CLEAN_UP) if before is None else spark.conf.set(_CLEAN_UP, before)
    out = spark.read.schema(schema).parquet(path)
    out._settled_at = path
    return out


def _delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def released(*tables: DataFrame | None) -> None:
    """Deletes tables that :func:`settled` wrote and that no frame reads any more."""
    for df in tables:
        if path := getattr(df, "_settled_at", None):
            _delete(df.sparkSession, path)


def clear_scratch(spark: SparkSession) -> None:
    """Deletes all that this application settled. For the end of a job: its results must be written by then."""
    _delete(spark, scratch_dir(spark))
