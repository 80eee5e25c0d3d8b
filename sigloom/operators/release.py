"""Release audit, manifest and datasets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Artefacts with their stage folder and suffix, and the files expected by channel.
ARTEFACTS = [("raw_motion", "01_raw_motion", "csv"), ("smoothed_motion", "02_smoothed_motion", "csv"), ("au_activation", "action_unit_activation", "mp4"), ("landmark_plot", "landmark_plot", "mp4"), ("landmark_overlay", "landmark_overlay", "mp4")]
EXPECTED = {"speech": 1440, "song": 1012}
# Archives with the artefacts in them.
ARCHIVES = [("raw_motion", ["raw_motion"]), ("smoothed_motion", ["smoothed_motion"]), ("smoothed_video", ["au_activation", "landmark_plot", "landmark_overlay"])]
CODECS = {"csv": "zstd", "mp4": "uncompressed"}


def expected_counts(spark: SparkSession) -> DataFrame:
    """``artifact, channel, expected``: ten rows."""
    return spark.createDataFrame([(a, c, n) for a, _, _ in ARTEFACTS for c, n in EXPECTED.items()], "artifact string, channel string, expected long")


def archive_specs(spark: SparkSession) -> DataFrame:
    """``archive, artifact, channel, stage, ext, many, codec``: one row per source folder."""
    of = {a: (stage, ext) for a, stage, ext in ARTEFACTS}
    rows = [(f"{name}_{c}.zip", a, c, *of[a], len(sources) > 1, CODECS[of[a][1]]) for name, sources in ARCHIVES for c in EXPECTED for a in sources]
    return spark.createDataFrame(rows, "archive string, artifact string, channel string, stage string, ext string, many boolean, codec string")


def artefact_counts(files: DataFrame, specs: DataFrame) -> DataFrame:
    """Files by artefact and channel; artefacts without a file count 0.

    The static specs are a dozen rows, so the join is a broadcast of known size.
    """
    found = files.join(F.broadcast(specs.select("artifact", "stage", "channel", "ext")), ["stage", "channel", "ext"]).groupBy("artifact", "channel").agg(F.count("*").alias("n"))
    every = specs.select("artifact", "channel").distinct()
    return every.join(found, ["artifact", "channel"], "left").select("artifact", "channel", F.coalesce("n", F.lit(0)).alias("n"))


def audited(counts: DataFrame, expected: DataFrame) -> DataFrame:
    """Counts against expectations: ``ok``, ``mismatch`` or ``no_expectation``; never an error."""
    joined = counts.join(F.broadcast(expected), ["artifact", "channel"], "left")
    return joined.withColumn("status", audit_status(F.col("n"), F.col("expected")))


def audit_status(n: Column, expected: Column) -> Column:
    return F.when(expected.isNull(), "no_expectation").when(n == expected, "ok").otherwise("mismatch")


def members(files: DataFrame, specs: DataFrame) -> DataFrame:
    """Files with their archive and the name inside it: by distinct path, folder of the artefact first where archives mix."""
    one = files.dropDuplicates(["path"])
    inside = one.join(F.broadcast(specs), ["stage", "channel", "ext"])
    short = F.concat_ws("/", F.col("folder"), F.concat("stem", F.lit("."), "ext"))
    return inside.withColumn("member", F.when(F.col("many"), F.concat_ws("/", "stage", short)).otherwise(short))


def manifest(files: DataFrame, specs: DataFrame) -> DataFrame:
    """``archive, member, bytes, ordinal`` with members numbered by name within their archive.

    Archives are few and large, so they are numbered in two steps: files are counted by archive
    and folder, and numbered within their folder, which sorts by name like the whole does.
    """
    rows = members(files, specs).withColumn("part", F.regexp_replace("member", "[^/]*$", ""))
    counts = rows.groupBy("archive", "part").agg(F.count("*").alias("n"))
    before = counts.select("archive", "part", (F.sum("n").over(Window.partitionBy("archive").orderBy("part")) - F.col("n")).alias("before"))
    place = F.row_number().over(Window.partitionBy("archive", "part").orderBy("member")) - 1
    out = rows.withColumn("place", place).join(before, ["archive", "part"])
    return out.select("archive", "member", F.col("length").alias("bytes"), (F.col("before") + F.col("place")).alias("ordinal"))


def write_datasets(tables: dict[str, DataFrame], specs: DataFrame, folder: str) -> None:
    """Each stage's motion table as a dataset by channel, with the codec of its archive."""
    codec = {r["stage"]: r["codec"] for r in specs.select("stage", "codec").distinct().collect()}
    for stage, df in tables.items():
        df.write.mode("overwrite").option("compression", codec[stage]).partitionBy("channel").parquet(f"{folder}/{stage}")


def task_counts(tasks: DataFrame) -> DataFrame:
    return tasks.groupBy("stage").agg(F.count("*").alias("n_tasks"))


def run_report(status: DataFrame, stage: str) -> DataFrame:
    """Clips by status of one stage's run."""
    return status.groupBy("status").agg(F.count("*").alias("n_clips")).select(F.lit(stage).alias("stage"), "status", "n_clips")
