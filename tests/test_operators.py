"""Edge cases of the series, catalog, ingest, release and incremental operators."""

from __future__ import annotations

import math
import subprocess
import sys
import shutil
import time
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from sigloom.functions import codes, values
from sigloom.operators import compare, features, release, series
from sigloom.sources import catalog, tracking
from sigloom.streaming.incremental import run_new_files


def test_codes(spark):
    stems = ["01-01-06-01-02-01-12", "02-01-06-01-02-01-12", "03-01-06-01-02-01-12", "01-03-06-01-02-01-12", "01-02-06-01-02-01-18", "01-01-06-01-02-01-18", "01-01-06-01-02-01", "01-01-06-01-02-01-12-9", "01-01-06-01-02-01-x", "01-01-06-01-02-01-", "01-01-06-01-02-01-+12", "01-01-06-01-02-01- 12", "01-01-06-01-02-01-1_2", None]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(stems)], "i int, stem string")
    rows = df.select("i", codes.clip_code(F.col("stem")).alias("c"), codes.reject_reason(F.col("stem")).alias("r")).withColumn("e", codes.eligible(F.col("c"))).orderBy("i").collect()
    assert [r.e for r in rows] == [True, False, False, False, False, True, False, False, False, False, True, True, False, False]
    assert [r.i for r in rows if r.r] == [6, 7, 8, 9, 12, 13] and all((r.c is None) == (r.r is not None) for r in rows)
    assert rows[10].c.actor == rows[11].c.actor == 12 and rows[0].c.emotion == "06"
    one = spark.range(1).select(codes.actor_folder(F.lit(7)).alias("a"), codes.actor_folder(F.lit(123)).alias("b"), codes.stem_of(F.lit("a/b.c/d.e.csv")).alias("s"), codes.member_name(F.lit("r/other/f"), ["r/x"]).alias("m"), codes.member_name(F.lit("r/x/A/f"), ["r/x"]).alias("m1"), codes.member_name(F.lit("q/y/A/f"), ["r/x", "q/y"]).alias("m2")).first()
    assert tuple(one) == ("Actor_07", "Actor_123", "d.e", None, "A/f", "q/A/f")


def frame(spark, rows):
    return spark.createDataFrame(rows, "clip string, i int, x double, kind string")


def test_fill_and_its_gate(spark):
    nan = math.nan
    rows = [("clean", k, 1.0 * k, "a") for k in range(3)] + [("filled", 0, 1.0, "a"), ("filled", 1, nan, None), ("filled", 2, None, "b")]
    rows += [("lead", 0, nan, "a"), ("lead", 1, 2.0, "a"), ("none", 0, None, None), ("none", 1, None, None)]
    df = frame(spark, rows)
    got = {(r.clip, r.i): (r.x, r.kind) for r in series.forward_fill(df, ["clip"], ["i"], ["x", "kind"]).collect()}
    assert got["filled", 1] == (1.0, "a") and got["filled", 2] == (1.0, "b") and got["lead", 0] == (None, "a") and got["none", 1] == (None, None)
    report = {r.clip: (r.nulls_before, r.nulls_after, r.status) for r in series.fill_report(df, ["clip"], ["i"], ["x", "kind"]).collect()}
    assert report == {"clean": (0, 0, "clean"), "filled": (3, 0, "filled"), "lead": (1, 1, "failed"), "none": (4, 4, "failed")}
    filled = series.forward_fill(df, ["clip"], ["i"], ["x"])
    assert {r.clip for r in series.complete_clips(filled, ["clip"], ["x"]).collect()} == {"clean", "filled"}
    with pytest.raises(ValueError, match="lead|none"):
        series.complete_clips(filled, ["clip"], ["x"], strict=True)


def test_clean_signals_gates(spark):
    rng = np.random.default_rng(0)
    rows = [(c, i, None if (c, i) == ("hole", 5) else float(rng.normal()), f"{c}{i}") for c, n in (("short", 18), ("just", 19), ("long", 60), ("hole", 40)) for i in range(n)]
    df = frame(spark, rows)
    out = series.clean_signals(df, ["clip"], ["i"], ["x"])
    got = {}
    for r in out.collect():
        got.setdefault(r.clip, {})[r.i] = r.x
        assert r.kind == f"{r.clip}{r.i}"
    assert set(got) == {"just", "long"}
    for c, own in got.items():
        x = np.array([[v] for k, _, v, _ in rows if k == c])
        assert np.allclose([own[i] for i in range(len(own))], series.chain(series.low_pass(), series.savgol())(x)[:, 0])
    report = {r.clip: r.status for r in series.signal_report(df, ["clip"], ["x"]).collect()}
    assert report == {"short": "too_short", "just": "ready", "long": "ready", "hole": "has_null"}
    outcome = {r.clip: r.outcome for r in series.isolated(series.signal_report(df, ["clip"], ["x"]), out, ["clip"]).collect()}
    assert outcome == {"short": "too_short", "just": "written", "long": "written", "hole": "has_null"}
    with pytest.raises(ValueError, match="short|hole"):
        series.clean_signals(df, ["clip"], ["i"], ["x"], strict=True)
    with pytest.raises(ValueError, match="AU01"):
        series.clean_signals(df, ["clip"], ["i"], ["x", "AU01"])
    with pytest.raises(ValueError, match="no column"):
        series.require_column(df, "y")
    assert series.clean_signals(df.where("false"), ["clip"], ["i"], ["x"]).count() == 0


def test_all_channels_at_once(spark):
    rng, names = np.random.default_rng(4), tracking.CHANNELS
    clips = {"a": rng.normal(size=(40, 163)), "b": rng.normal(size=(25, 163)), "c": rng.normal(size=(130, 163))}
    rows = [(c, i, *map(float, v)) for c, x in clips.items() for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "clip string, i int, " + ", ".join(f"{n} double" for n in names))
    got = {(r.clip, r.i): r[2:] for r in series.clean_signals(df, ["clip"], ["i"], names).collect()}
    for c, x in clips.items():
        assert np.allclose([got[c, i] for i in range(len(x))], series.chain(series.low_pass(), series.savgol())(x))


def test_absent_clips_and_columns(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="nowhere"):
        tracking.read_clip(spark, str(tmp_path / "nowhere"), ["x_0"])
    (tmp_path / "a.csv").write_text(",x_0,kind\n0,1.5,p\n")
    assert [(r.x_0, r.kind) for r in tracking.read_clip(spark, str(tmp_path), ["x_0"]).collect()] == [(1.5, "p")]
    heads = tracking.file_headers(spark, str(tmp_path))
    assert [r.missing for r in tracking.channel_report(heads, ["y_0", "x_0", "AU01"]).collect()] == [["y_0", "AU01"]]
    assert [r.message for r in tracking.column_report(heads, "x_0").collect()] == [None]
    files = spark.createDataFrame([("01_raw_motion/Actor_03/s.mp4", 3)], "path string, folder_actor int")
    found = catalog.actor_listing(files, spark).collect()
    assert len(found) == 24 and [r.path for r in found if r.status == "listed"] == ["01_raw_motion/Actor_03/s.mp4"]


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    from sigloom import session

    table = session.settled(spark.range(3), "three")
    assert table.count() == 3 and Path(table._settled_at).is_dir()
    session.released(table)
    assert not Path(table._settled_at).exists()
    session.settled(spark.range(3), "three")
    session.clear_scratch(spark)
    assert not Path(session.scratch_dir(spark)).exists()
    monkeypatch.setattr(spark.sparkContext, "master", "spark://host:7077")
    if not spark.conf.get("spark.checkpoint.dir", None):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            session.scratch_dir(spark)


def test_settled_leaves_no_shuffle_files(spark):
    from sigloom import session

    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    disk, before = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager(), spark.conf.get(key, None)
    shuffles = lambda: {f.name() for f in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(disk.getAllBlocks()) if f.name().startswith("shuffle_")}
    held = shuffles()
    table = session.settled(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count().repartition(3, "count"), "shuffled")
    end = time.time() + 10
    while shuffles() - held and time.time() < end:
        time.sleep(0.1)
    assert not shuffles() - held and table.count() == 7 and spark.conf.get(key, None) == before
    session.released(table)


def test_clips_that_span_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        df = frame(spark, [(c, i, float(i * (k + 1)), None) for k, c in enumerate("abcd") for i in range(5 + 9 * k)])
        out = series.map_channels(df, ["clip"], ["i"], ["x"], lambda x: np.full_like(x, len(x)))
        assert {(r.clip, r.x) for r in out.collect()} == {(c, 5.0 + 9 * k) for k, c in enumerate("abcd")}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_native_smoothing_is_the_matrix(spark):
    rng = np.random.default_rng(3)
    df = frame(spark, [(f"c{n}", i, float(rng.normal()), None) for n in (1, 11, 12, 19, 50) for i in range(n)])
    native = series.savgol_native(df, ["clip"], ["i"], "x", "y").select("clip", "i", "y")
    both = native.join(series.map_channels(df, ["clip"], ["i"], ["x"], series.savgol()), ["clip", "i"]).collect()
    assert len(both) == 93 and all(abs(r.x - r.y) < 1e-9 for r in both)


def test_mixed_headers(spark, tmp_path):
    place = tmp_path / "01_raw_motion" / "speech" / "Actor_01"
    place.mkdir(parents=True)
    (place / "a.csv").write_text(",x_0,kind\n1,2.5,NA\n0,1.5,p\n")
    (place / "b.csv").write_text(",Unnamed: 0,extra,x_0\n0,0,e,null\n1,1,f,7\n")
    (place / "c.csv").write_text("x_0,kind\n3,q\n4,r\n")
    (place / "notes.txt").write_text("no")
    files = catalog.list_files(spark, str(tmp_path), "*.csv")
    assert files.count() == 3 and files.columns == ["path", "length", "modified"]
    rows = {(Path(r.path).name, r.row_idx): (r.x_0, r.kind, r.extra) for r in tracking.read_tracking(spark, str(tmp_path), ["x_0"]).collect()}
    assert rows == {("a.csv", 0): (1.5, "p", None), ("a.csv", 1): (2.5, None, None), ("b.csv", 0): (None, None, "e"), ("b.csv", 1): (7.0, None, "f"), ("c.csv", 0): (3.0, "q", None), ("c.csv", 1): (4.0, "r", None)}
    found = catalog.clips(files).select("stem", "folder_actor", "reason", "eligible").collect()
    assert {(r.folder_actor, r.eligible) for r in found} == {(1, False)} and all(r.reason for r in found)
    assert len(tracking.CHANNELS) == 163


def test_values(spark):
    df = spark.createDataFrame([("1.5", 2.0), ("NaN", math.nan), ("x", None), (None, 1.0)], "t string, v double")
    assert [r[0] for r in df.select(values.numeric(F.col("t"))).collect()] == [1.5, None, None, None]
    assert [r[0] for r in df.select(values.na_to_null(F.col("t"))).collect()] == ["1.5", None, "x", None]
    framed = df.withColumn("frame", F.lit("3"))
    assert framed.select(compare.frame_or_position(framed, ["t"], ["v"])).first()[0] == 3.0
    bad = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, None]), (3, [math.nan]), (4, [math.inf]), (5, []), (6, None)], "i int, v array<double>")
    assert [r.i for r in bad.where(features.usable(F.col("v"))).collect()] == [1]


def test_release_counts_keep_empty_artefacts(spark):
    files = spark.createDataFrame([("01_raw_motion", "speech", "Actor_01", "s", "csv", "p", 3)], "stage string, channel string, folder string, stem string, ext string, path string, length long")
    specs = release.archive_specs(spark)
    counts = {(r.artifact, r.channel): (r.n, r.status) for r in release.audited(release.artefact_counts(files, specs), release.expected_counts(spark)).collect()}
    assert len(counts) == 10 and counts["raw_motion", "speech"] == (1, "mismatch") and counts["landmark_plot", "song"] == (0, "mismatch")
    again = release.manifest(files.unionAll(files), specs).collect()
    assert [tuple(r) for r in again] == [("raw_motion_speech.zip", "Actor_01/s.csv", 3, 0)]
    assert catalog.expected_coverage(spark).count() == 47


def test_incremental_runs_see_each_file_once(spark, tmp_path):
    folder, state, target = (str(tmp_path / x) for x in ("in", "state", "out"))
    sizes = []
    for k in range(3):
        if k < 2:
            spark.range(10 * k, 10 * k + 10).coalesce(1).write.mode("append").parquet(folder)
        run_new_files(spark, folder, "id long", state, target, lambda df: df.withColumn("twice", F.col("id") * 2))
        sizes.append(spark.read.parquet(target).count())
    assert sizes == [10, 20, 20]


def test_sinks_replace_only_their_partitions(spark, tmp_path):
    df = spark.createDataFrame([(1, "speech", 1), (2, "song", 2)], "v int, channel string, actor int")
    tracking.write_clips(df, str(tmp_path / "d"))
    tracking.write_clips(df.where("v = 1").withColumn("v", F.lit(9)), str(tmp_path / "d"))
    assert sorted(r.v for r in spark.read.parquet(str(tmp_path / "d")).collect()) == [2, 9]
    tracking.write_clip_csv(df.withColumn("stem", F.lit("s")), str(tmp_path / "c"))
    assert (tmp_path / "c" / "channel=song" / "actor=2" / "stem=s").is_dir()


def test_entry_works_without_the_text_operators(tmp_path):
    root = Path(__file__).resolve().parent.parent
    shutil.copytree(root / "sigloom", tmp_path / "sigloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    run = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; q = e.queries(); assert len(q) > 40 and set(e.oracle_sql()) <= set(q); print(len(q))"], cwd=tmp_path, capture_output=True, text=True)
    assert run.returncode == 0, run.stderr
