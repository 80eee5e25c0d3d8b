"""Clips in parts, walked listings, and stages stored in buckets."""

from __future__ import annotations

import time

import pytest
from pyspark.sql import functions as F

from sigloom.operators import bucketed
from sigloom.sources import walk
from sigloom.streaming.parts import run_clip_parts

SCHEMA = "clip string, part int, parts int, i long, x double"


def load(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def part(clip, k, of, rows=2):
    return [(clip, k, of, 10 * k + i, float(k) if i else None) for i in range(rows)]


def test_clips_wait_for_their_last_part(spark, tmp_path):
    folder, state, target = (str(tmp_path / x) for x in ("in", "state", "out"))

    def run(wait=3600):
        run_clip_parts(spark, folder, SCHEMA, state, target, lambda df: df.withColumn("twice", F.col("i") * 2), "clip", "part", "parts", ["i", "x"], wait)
        rows = sorted((r.clip, r.i, r.x, r.twice) for r in spark.read.parquet(f"{target}/rows").collect())
        failed = sorted((r.clip, r.status, r.n_parts) for r in spark.read.parquet(f"{target}/failed").collect())
        return rows, failed

    want = lambda *clips: sorted((c, 10 * k + i, float(k) if i else None, 2 * (10 * k + i)) for c, of in clips for k in range(of) for i in range(2))
    load(spark, folder, part("a", 1, 2) + part("one", 0, 1) + part("lost", 0, 3) + part("odd", 0, 2))
    rows, failed = run()
    assert rows == [(c, i, x, t) for c, i, x, t in want(("one", 1))] and failed == []
    # A part again before the clip is whole, and a clip that contradicts itself.
    load(spark, folder, part("a", 1, 2) + part("odd", 1, 3) + part("far", 5, 2))
    assert run() == (rows, [("far", "contradiction", 1), ("odd", "contradiction", 2)])
    load(spark, folder, part("a", 0, 2))
    rows, failed = run()
    assert rows == want(("one", 1), ("a", 2)) and {f[0] for f in failed} == {"far", "odd"}
    assert run() == (rows, failed)


def test_a_clip_that_never_ends_times_out(spark, tmp_path):
    folder, state, target = (str(tmp_path / x) for x in ("in", "state", "out"))
    for k in range(2):
        load(spark, folder, part("lost", 0, 3) if not k else part("other", 0, 1))
        run_clip_parts(spark, folder, SCHEMA, state, target, lambda df: df, "clip", "part", "parts", ["i", "x"], 1)
        time.sleep(1.5)
    failed = [(r.clip, r.status, r.n_parts) for r in spark.read.parquet(f"{target}/failed").collect()]
    assert failed == [("lost", "timeout", 1)]
    assert {r.clip for r in spark.read.parquet(f"{target}/rows").collect()} == {"other"}


def test_walk(spark, tmp_path):
    for path in ("a/x.csv", "a/y.mp4", "a/deep/er/z.csv", "b/.hidden.csv", "b/_tmp/w.csv", "c/q.csv"):
        (tmp_path / path).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / path).write_text("12345")
    folders = spark.createDataFrame([(f"file://{tmp_path}/{x}",) for x in ("a", "a", "b", "none")], "path string")
    got = sorted((r.path.removeprefix(f"file://{tmp_path}/"), r.length, r.status) for r in walk.walk(spark, folders, "*.csv", per_task=1).collect())
    assert got == [("a/deep/er/z.csv", 5, "listed"), ("a/x.csv", 5, "listed"), ("none", None, "missing")]
    flat = walk.walk(spark, folders, "*.csv", deep=False)
    assert sorted(r.path.rsplit("/", 1)[1] for r in flat.collect()) == ["none", "x.csv"]
    every = walk.walk(spark, folders, hidden=True)
    assert every.where("status = 'listed'").count() == 5 and every.where("modified is null").count() == 1
    assert walk.walk(spark, folders.where("false")).count() == 0


def test_pairs_in_buckets_need_no_exchange(spark, tmp_path):
    rows = spark.range(2000).select((F.col("id") % 37).alias("clip"), F.floor(F.col("id") / 37).alias("i"), F.col("id").cast("double").alias("x"))
    bucketed.write_bucketed(rows, "pairs_raw", str(tmp_path / "raw"), ["clip"], ["i"], 8)
    bucketed.write_bucketed(rows.withColumn("x", -F.col("x")), "pairs_smooth", str(tmp_path / "smooth"), ["clip"], ["i"], 8)
    try:
        out = bucketed.paired_buckets(spark, "pairs_raw", "pairs_smooth", ["clip"], ["i"], "x")
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "SortMergeJoin" in plan
        assert out.count() == 2000 and out.where("raw <> -smoothed").count() == 0
        assert len(list((tmp_path / "raw").glob("*.parquet"))) == 8
    finally:
        bucketed.drop_bucketed(spark, "pairs_raw", "pairs_smooth")
    with pytest.raises(Exception, match="pairs_raw"):
        spark.table("pairs_raw")
