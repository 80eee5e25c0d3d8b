"""A file for each clip: what tasks write and read, and that the driver plans no file."""

from __future__ import annotations

import math
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from sigloom.session import scratch_dir
from sigloom.sources import catalog, clip_files, tracking, versions, walk

ODD = ["a b", "x/y=z", "100%", "%2F", "", "ü:[1]", "q'\"\\", "_u", ".v"]


def _jobs(spark, step):
    """The stages' largest number of tasks while ``step`` runs."""
    sc, group = spark.sparkContext, f"clip-files-{id(step)}"
    sc.setJobGroup(group, group)
    try:
        step()
        tracker = sc.statusTracker()
        stages = [s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds]
        return max(tracker.getStageInfo(s).numTasks for s in stages if tracker.getStageInfo(s))
    finally:
        sc._jsc.sc().clearJobGroup()


def test_export_is_what_spark_writes(spark, tmp_path):
    rows = [("song", k, f"s{k}", i, v, t) for k in range(3) for i, (v, t) in enumerate([(1e-9, "a"), (None, None), (math.inf, ""), (-0.0, 'q,"r"'), (1e300, " p ")])]
    df = spark.createDataFrame(rows, "channel string, actor int, stem string, i int, x double, t string")
    ours, plain = str(tmp_path / "ours"), str(tmp_path / "plain")
    written = tracking.write_clip_csv(df.repartition(4), ours, ["i"])
    df.repartition("stem").sortWithinPartitions("channel", "actor", "stem", "i").write.option("header", True).partitionBy("channel", "actor", "stem").csv(plain)
    texts = lambda root: {str(p.parent.relative_to(root)): p.read_text() for p in root.rglob("*.csv")}
    assert texts(tmp_path / "ours") == texts(tmp_path / "plain") and len(texts(tmp_path / "ours")) == 3
    schema = "i int, x double, t string"
    assert sorted(map(repr, clip_files.read_csv(written, schema).collect())) == sorted(map(repr, spark.read.option("header", True).schema(schema).csv(plain).select("i", "x", "t").collect()))
    assert {(r.path, r.length) for r in written.collect()} == {(f"file://{p}", p.stat().st_size) for p in (tmp_path / "ours").rglob("*.csv")}
    # A second export replaces the first.
    tracking.write_clip_csv(df.where("actor = 1"), ours, ["i"])
    assert [r.actor for r in spark.read.option("header", True).csv(ours).select("actor").distinct().collect()] == [1]


@pytest.mark.parametrize("n", [1, 20_001])
def test_clips_of_any_length_are_one_file(spark, tmp_path, n):
    df = spark.range(n).select(F.lit("song").alias("channel"), F.lit(1).alias("actor"), F.lit("s").alias("stem"), "id")
    written = tracking.write_clip_csv(df.repartition(5), str(tmp_path / "c"), ["id"])
    assert [(r.rows, r.stem) for r in written.collect()] == [(n, "s")]
    lines = [r.line for r in clip_files.read_lines(written).collect()]
    assert lines == [str(i) for i in range(n)]
    assert clip_files.read_lines(written.where("false")).count() == 0


def test_many_clips_are_few_tasks(spark, tmp_path):
    df = spark.range(600).select(F.lit("song").alias("channel"), F.lit(1).alias("actor"), F.col("id").alias("stem"), F.col("id").alias("x"))
    root = str(tmp_path / "c")
    seen = []
    most = _jobs(spark, lambda: seen.append(tracking.write_clip_csv(df, root)))
    most = max(most, _jobs(spark, lambda: seen.append(catalog.list_files(spark, root, "*.csv").count())))
    most = max(most, _jobs(spark, lambda: seen.append(clip_files.read_csv(seen[0], "x long").agg(F.sum("x")).first()[0])))
    assert seen[1:] == [600, sum(range(600))]
    # Spark's own listing of 600 folders takes 600 tasks.
    assert most <= 40
    assert not list((tmp_path / "c").rglob(".*"))


def test_one_clip_of_many_is_few_tasks(spark, tmp_path):
    from sigloom.plans.queries import QUERIES

    rows = spark.range(600).select((F.col("id") + 3).alias("user_id"), F.col("id").alias("event_id"), F.timestamp_seconds("id").alias("ts"), F.lit("a").alias("event_type"), F.lit(1.5).alias("value"))
    rows.write.parquet(str(tmp_path / "events.parquet"))
    seen = []
    most = _jobs(spark, lambda: seen.extend(QUERIES["sc5_clip_file"](spark, str(tmp_path)).collect()))
    assert [tuple(r) for r in seen] == [(0, 1.5)] and most <= 40
    stems = spark.range(600).select(F.lit("song").alias("channel"), F.lit(1).alias("actor"), F.col("id").alias("stem"), "id").repartition(3)
    # One file a clip, none left half written, wherever its rows came from.
    assert tracking.write_clip_csv(stems.union(stems), str(tmp_path / "c")).count() == len(list((tmp_path / "c").rglob("*.csv"))) == 600


def test_one_clip_by_its_path_leaves_the_driver_no_file(spark, tmp_path):
    from sigloom.plans.queries import QUERIES

    rows = spark.range(1200).select((F.col("id") % 300 + 4).alias("user_id"), F.col("id").alias("event_id"), F.timestamp_seconds(-F.col("id")).alias("ts"), F.lit("a").alias("event_type"), (F.col("id") / 2).alias("value"))
    rows.write.parquet(str(tmp_path / "events.parquet"))
    before = {p for p in _scratch(spark) if p.name.startswith("clips-")}
    got = QUERIES["sc5_clip_file"](spark, str(tmp_path)).orderBy("row_idx").collect()
    assert [tuple(r) for r in got] == [(0, 450.0), (1, 300.0), (2, 150.0), (3, 0.0)]
    (folder,) = {p for p in _scratch(spark) if p.name.startswith("clips-")} - before
    # Every clip has its file, by name the task's own: a commit on the driver would have renamed each and left its mark.
    assert {p.parent.name for p in folder.glob("channel=*/actor=*/stem=*/part-0.csv")} == {f"stem={k + 4}" for k in range(300)}
    assert not (folder / "_SUCCESS").exists() and len([p for p in folder.rglob("*") if p.is_file() and p.suffix != ".crc"]) == 300


def test_a_walk_of_many_folders_is_few_tasks(spark, tmp_path):
    for k in range(3000):
        (tmp_path / f"{k}").mkdir()
        (tmp_path / f"{k}" / "x.csv").write_text("1")
    top = spark.createDataFrame([(f"file://{tmp_path}",)], "path string")
    seen = []
    assert _jobs(spark, lambda: seen.append(walk.walk(spark, top, "*.csv").count())) <= 40
    assert seen == [3000]


def test_a_listing_names_files_as_spark_does(spark, tmp_path):
    for name in ("a b/x%2Fy.csv", "d/e/f.csv", "d/_tmp/g.csv", "d/.h.csv", "d/n.txt"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("1")
    spark_own = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").option("recursiveFileLookup", "true")
    want = sorted((r.path, r.length, r.modificationTime) for r in spark_own.load(str(tmp_path)).select("path", "length", "modificationTime").collect())
    got = sorted((r.path, r.length, r.modified) for r in catalog.list_files(spark, str(tmp_path), "*.csv").collect())
    assert [g[:2] for g in got] == [w[:2] for w in want] and len(got) == 2
    assert [g[2].replace(microsecond=0) for g in got] == [w[2].replace(microsecond=0) for w in want]
    assert catalog.list_files(spark, str(tmp_path / "d" / "e" / "f.csv"), "*.csv").count() == 1
    assert catalog.list_files(spark, str(tmp_path / "d*"), "*.csv").count() == 1
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        catalog.list_files(spark, str(tmp_path / "none"), "*.csv").count()


def test_texts_of_many_clips_are_few_tasks(spark, tmp_path):
    from sigloom.plans.queries import QUERIES

    rows = spark.range(600).select((F.col("id") + 3).alias("user_id"), F.col("id").alias("event_id"), F.timestamp_seconds("id").alias("ts"), F.lit("a").alias("event_type"), F.lit(1.5).alias("value"))
    rows.write.parquet(str(tmp_path / "events.parquet"))
    before = {p for p in _scratch(spark) if p.name.startswith("drifting-")}
    got = QUERIES["sc4_tracking_source"](spark, str(tmp_path)).collect()
    assert {(r.user_id, r.event_id) for r in got} == {(k + 3, k) for k in range(600)} and len(got) == 600
    (folder,) = {p for p in _scratch(spark) if p.name.startswith("drifting-")} - before
    # One file a clip at a name of its own; the driver's commit, which renamed them, left its mark before.
    assert len(list(folder.glob("user_id=*/part-0.txt"))) == 600 and not (folder / "_SUCCESS").exists()


def _scratch(spark):
    place = Path(scratch_dir(spark))
    return place.iterdir() if place.exists() else ()


def test_versions_hold_clips_of_any_key(spark, tmp_path):
    root, schema = str(tmp_path / "set of"), "clip_id string, i int, x double"
    rows = [(k, i, float(i)) for k in ODD for i in range(2)]
    versions.publish(spark.createDataFrame(rows, schema), root, "clip_id", "r 1")
    assert {p.parent.name for p in (tmp_path / "set of").rglob("part-0.parquet")} == {clip_files.folder_name("clip", k) for k in ODD}
    got = versions.read_version(spark, root, f"{schema}, later timestamp")
    assert sorted((r.clip_id, r.i, r.x) for r in got.collect()) == sorted(rows)
    assert {(r.clip, r.run, r.later) for r in got.collect()} == {(k, "r 1", None) for k in ODD}
    assert {r.clip for r in versions.read_version(spark, root, schema, only="clip = '100%'").collect()} == {"100%"}
    # Folders that Spark itself wrote are read as well.
    spark.createDataFrame(rows, schema).where("clip_id <> ''").withColumn("clip", F.col("clip_id")).write.partitionBy("clip").parquet(str(tmp_path / "own"))
    assert {p.name for p in (tmp_path / "own").glob("clip=*")} == {clip_files.folder_name("clip", k) for k in ODD if k}


def test_many_versioned_clips_are_few_tasks(spark, tmp_path):
    root, rows = str(tmp_path / "set"), spark.range(600).select("id", F.col("id").alias("x"))
    seen = []
    most = _jobs(spark, lambda: seen.append(versions.publish(rows, root, "id", "one")))
    most = max(most, _jobs(spark, lambda: seen.append(versions.read_version(spark, root, "id long, x long").agg(F.sum("x")).first()[0])))
    assert seen == [1, sum(range(600))]
    assert most <= 40
