"""Clip catalogs from file listings, and what they ought to hold."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import codes
from . import walk


def list_files(spark: SparkSession, root: str, pattern: str, recursive: bool = True) -> DataFrame:
    """``path, length, modified`` of the files under ``root``; contents are never read.

    A tree is walked by tasks, level by level. A single file, a glob or one level is Spark's own listing.
    Ordering is left to reports and sinks. A folder without a match gives no rows.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not recursive or not fs.exists(path) or fs.getFileStatus(path).isFile():
        reader = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", str(recursive).lower())
        return reader.load(root).select("path", "length", F.col("modificationTime").alias("modified"))
    top = spark.range(1).select(F.lit(walk.qualified(spark, root)).alias("path"))
    # A folder that is gone by the time its turn comes held no file of the listing; one that cannot be read is an error.
    found = walk.walk(spark, top, pattern).where("status <> 'missing'")
    checked = F.when(F.col("status") == "listed", F.col("path")).otherwise(F.raise_error(F.concat_ws(" ", "path", "status")))
    return found.select(F.regexp_replace(checked, "^file:///", "file:/").alias("path"), "length", "modified")


def clips(files: DataFrame) -> DataFrame:
    """Listed files as clips: folder actor, stem, code, rejection reason, eligibility and channel.

    The folder gives the actor of the clip's place, the name gives the actor of its code; they
    are not compared. A rejected name keeps its row, with the reason.
    """
    stem = codes.stem_of(F.col("path"))
    out = files.withColumns({"stem": stem, "actor_dir": F.element_at(F.split("path", "/"), -2)})
    folder = F.regexp_extract("actor_dir", r"^Actor_0*(\d+)$", 1).try_cast("int")
    out = out.withColumns({"folder_actor": folder, "code": codes.clip_code(F.col("stem")), "reason": codes.reject_reason(F.col("stem"))})
    return out.withColumns({"eligible": codes.eligible(F.col("code")), "channel": codes.channel_label(F.col("code.vocal_channel"))})


def processable(catalog: DataFrame) -> DataFrame:
    """Clips that a run takes up: eligible, in a folder of the actor range."""
    return catalog.where(F.col("eligible") & codes.in_actor_range(F.col("folder_actor")))


def quarantined(catalog: DataFrame) -> DataFrame:
    """Malformed names with the reason."""
    return catalog.where(F.col("reason").isNotNull())


def first_eligible(catalog: DataFrame) -> DataFrame:
    """The first clip that a run would take up."""
    return processable(catalog).orderBy("channel", "actor_dir", "stem").limit(1)


def expected_coverage(spark: SparkSession) -> DataFrame:
    """The 47 pairs of actor and channel that a full corpus holds."""
    actors = spark.range(codes.ACTORS[0], codes.ACTORS[1] + 1).select(F.col("id").cast("int").alias("actor"))
    channel = F.explode(F.array(*map(F.lit, codes.CHANNELS.values())))
    return actors.select("actor", channel.alias("channel")).where(~((F.col("actor") == codes.NO_SONG_ACTOR) & (F.col("channel") == "song")))


def uncovered(expected: DataFrame, observed: DataFrame) -> DataFrame:
    """Expected pairs without any clip."""
    return expected.join(observed.select("actor", "channel").distinct(), ["actor", "channel"], "left_anti")


def not_yet_done(tasks: DataFrame, existing: DataFrame, key: str | list[str]) -> DataFrame:
    """Tasks whose output is not there yet; existence alone counts."""
    return tasks.join(existing, key, "left_anti")


def actor_listing(files: DataFrame, spark: SparkSession, by: list[str] | None = None) -> DataFrame:
    """The files that lie directly in each expected actor folder, ``by`` channel too if asked for.

    ``files`` has ``path``, ``folder_actor`` and the ``by`` columns. A folder without files gives
    one row with a null path and the status ``missing``: a run goes on without it.
    """
    by = by or []
    grid = spark.range(codes.ACTORS[0], codes.ACTORS[1] + 1).select(F.col("id").cast("int").alias("actor"))
    if by:
        grid = grid.select("actor", F.explode(F.array(*map(F.lit, codes.CHANNELS.values()))).alias(by[0]))
    found = files.select(F.col("folder_actor").alias("actor"), *by, "path")
    # The grid has 48 rows at most.
    known = found.join(F.broadcast(grid), ["actor", *by]).withColumn("status", F.lit("listed"))
    absent = grid.join(found.select("actor", *by).distinct(), ["actor", *by], "left_anti").withColumns({"path": F.lit(None).cast("string"), "status": F.lit("missing")})
    return known.unionByName(absent)
