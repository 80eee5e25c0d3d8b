"""What is done, versioned clips, and the run log."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from sigloom.sources import membership, versions


def test_new_tasks_are_the_anti_join(spark):
    tasks = spark.createDataFrame([(k, f"out/{k}.csv") for k in range(3000)] + [(-1, None), (5, "out/5.csv")], "k int, output string")
    done = spark.createDataFrame([(f"out/{k}.csv",) for k in range(0, 6000, 3)] + [("out/3.csv",), (None,)], "output string")
    want = sorted([k for k in range(3000) if k % 3] + [-1, 5])
    for most in (membership.MOST_BLOCKS, 1):
        assert sorted(r.k for r in membership.new_tasks(tasks, done, "output", most).collect()) == want
    assert membership.new_tasks(tasks, done.where("false"), "output").count() == 3002
    assert membership.new_tasks(tasks.where("false"), done, "output").count() == 0


def test_the_filter_misses_nothing_and_lets_few_through(spark):
    keys = spark.range(20_000).select(F.concat(F.lit("p/"), "id").alias("key"))
    blocks = 20_000 // 32
    bits = membership.bloom_blocks(keys, "key", blocks)
    assert bits.count() == blocks

    def hits(of):
        at = of.withColumn("at", membership._block(F.col("key"), blocks)).join(bits, F.col("at") == F.col("block"))
        for i, m in enumerate(membership._masks(F.col("key"))):
            at = at.where(F.col(f"w{i}").bitwiseAND(m) != 0)
        return at.count()

    assert hits(keys) == 20_000
    assert hits(spark.range(20_000).select(F.concat(F.lit("other/"), "id").alias("key"))) < 100


def test_only_hits_are_shuffled(spark):
    tasks = spark.range(1000).select(F.concat(F.lit("p/"), "id").alias("output"), "id")
    new = membership.new_tasks(tasks, tasks.where("id < 100").select("output"), "output")
    plan = new._jdf.queryExecution().executedPlan().toString()
    # The branch of misses has no exchange but the broadcast of the filter.
    misses = plan[plan.index("Union") :].split("\n:  ")[0] if "Union" in plan else plan
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning(output" not in misses
    assert new.count() == 900


SCHEMA = "clip_id string, i int, x double"


def stamps(root):
    return {str(p): p.stat().st_mtime_ns for p in Path(root).rglob("*.parquet") if "/data/" in str(p)}


def test_unchanged_clips_keep_their_files(spark, tmp_path):
    root = str(tmp_path / "set")
    first = spark.createDataFrame([(c, i, float(i)) for c in ("01", "1", "b c", "d=e/f") for i in range(3)], SCHEMA)
    assert versions.latest(spark, root) == 0
    with pytest.raises(FileNotFoundError):
        versions.manifest(spark, root)
    assert versions.publish(first, root, "clip_id", "one") == 1
    before = stamps(root)
    assert len(before) == 4
    changed = spark.createDataFrame([("01", 0, 9.0), ("new", 0, 1.0)], SCHEMA)
    assert versions.publish(changed, root, "clip_id", "two") == 2
    after = stamps(root)
    assert {k: after[k] for k in before} == before and len(after) == 6
    rows = sorted((r.clip_id, r.i, r.x, r.run) for r in versions.read_version(spark, root, SCHEMA).collect())
    assert rows == sorted([("01", 0, 9.0, "two"), ("new", 0, 1.0, "two"), *[(c, i, float(i), "one") for c in ("1", "b c", "d=e/f") for i in range(3)]])
    old = versions.read_version(spark, root, SCHEMA, 1)
    assert sorted((r.clip_id, r.i, r.x) for r in old.collect()) == sorted(tuple(r) for r in first.collect())
    gone = spark.createDataFrame([("1",), ("new",)], "clip string")
    assert versions.publish(changed.where("false"), root, "clip_id", dropped=gone) == 3
    assert {r.clip for r in versions.manifest(spark, root).collect()} == {"01", "b c", "d=e/f"}
    with pytest.raises(ValueError, match="before"):
        versions.publish(changed, root, "clip_id", "two")
    with pytest.raises(Exception, match="without a key"):
        versions.publish(spark.createDataFrame([(None, 0, 1.0)], SCHEMA), root, "clip_id", "bad")


def test_a_reader_sees_whole_versions_only(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "set")
    rows = spark.createDataFrame([("a", 0, 1.0), ("b", 0, 2.0)], SCHEMA)
    versions.publish(rows, root, "clip_id", "one")
    # A run that has written its clips but not published: nothing of it is seen.
    rows.where("clip_id = 'a'").withColumns({"x": F.lit(7.0), "clip": F.col("clip_id")}).write.partitionBy("clip").parquet(f"{root}/data/run=half")
    assert sorted(r.x for r in versions.read_version(spark, root, SCHEMA).collect()) == [1.0, 2.0]
    # Two runs from one version: the later one fails and leaves the version as it is.
    monkeypatch.setattr(versions, "latest", lambda *_: 0)
    with pytest.raises(versions.VersionConflict):
        versions.publish(rows.withColumn("x", F.lit(8.0)), root, "clip_id", "late")
    monkeypatch.undo()
    assert sorted(r.x for r in versions.read_version(spark, root, SCHEMA).collect()) == [1.0, 2.0]


def test_replayed_runs_leave_one_set_of_rows(spark, tmp_path):
    folder = str(tmp_path / "log")
    rows = lambda *n: spark.createDataFrame([("fill", "clean", k) for k in n], "stage string, status string, n_clips long")
    for run, own in (("r1", (1, 2)), ("r2", (3,)), ("r1", (4,)), ("r2", (3,))):
        versions.append_run(rows(*own), folder, run)
    got = versions.read_runs(spark, folder, "stage string, status string, n_clips long").collect()
    assert sorted((r.run, r.n_clips) for r in got) == [("r1", 4), ("r2", 3)]
