"""Clips of any length, and functions of the user's on clips."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sigloom.operators import clip_map, long_series, series


def rows_of(spark, sizes, seed=0):
    rng = np.random.default_rng(seed)
    rows = []
    for c, n in sizes.items():
        for i in range(n):
            hole = rng.random() < 0.4
            rows.append((c, i // 3, i, [None, math.nan][int(rng.integers(2))] if hole else float(rng.normal()), None if rng.random() < 0.6 else f"{c}{i}"))
    order = rng.permutation(len(rows))
    return spark.createDataFrame([rows[k] for k in order], "clip string, t int, i int, x double, kind string")


@pytest.mark.parametrize("parts", [1, 3, 17, 200])
@pytest.mark.parametrize("batch", [4, 10_000])
def test_scan_is_fill_and_position(spark, parts, batch):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        df = rows_of(spark, {"long": 900, "a": 1, "b": 2, "c": 30, None: 5, "z": 40}, parts)
        got = long_series.scanned(df, ["clip"], ["t", "i"], ["x", "kind"], "row_idx", parts)
        assert got.columns == [*df.columns, "row_idx"]
        want = series.with_position(series.forward_fill(df, ["clip"], ["t", "i"], ["x", "kind"]), ["clip"], ["t", "i"])
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.select(*got.columns).collect()))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_scan_edges(spark):
    df = rows_of(spark, {"a": 3})
    assert long_series.scanned(df.where("false"), ["clip"], ["i"], ["x"], "p").count() == 0
    with pytest.raises(ValueError, match="__own"):
        long_series.scanned(df.withColumn("__own", F.lit(1)), ["clip"], ["i"])
    again = long_series.scanned(df.withColumn("p", F.lit("old")), ["clip"], ["i"], (), "p")
    assert sorted(r.p for r in again.collect()) == [0, 1, 2]
    # A hole over whole ranges is filled from the last range that holds a value.
    gap = spark.createDataFrame([("a", i, 7.0 if i == 2 else None) for i in range(500)], "clip string, i int, x double")
    got = {r.i: r.x for r in long_series.scanned(gap, ["clip"], ["i"], ["x"], parts=40).collect()}
    assert got == {i: 7.0 if i >= 2 else None for i in range(500)}


def test_fill_report_without_a_window(spark):
    df = rows_of(spark, {"long": 300, "a": 1, "b": 2, "c": 30, None: 5})
    df = df.unionByName(spark.createDataFrame([("none", 0, i, None, None) for i in range(3)] + [("full", 0, i, 1.0, "k") for i in range(3)], df.schema))
    got = {r.clip: tuple(r) for r in long_series.long_fill_report(df, ["clip"], ["t", "i"], ["x", "kind"]).collect()}
    assert got == {r.clip: tuple(r) for r in series.fill_report(df, ["clip"], ["t", "i"], ["x", "kind"]).collect()}
    assert got["none"][4] == "failed" and got["full"][4] == "clean"


def test_a_long_clip_is_many_tasks(spark):
    df = spark.range(20_000).select(F.lit("a").alias("clip"), F.col("id").alias("i"), F.when(F.col("id") % 7 == 0, F.col("id").cast("double")).alias("x"))
    out = long_series.scanned(df, ["clip"], ["i"], ["x"], "row_idx", 16)
    assert out.where("row_idx <> i or x <> i - i % 7").count() == 0
    sizes = []
    real, long_series.settled = long_series.settled, lambda df, name: sizes.append(df) or real(df, name)
    try:
        long_series.scanned(df, ["clip"], ["i"], (), "row_idx", 16)
    finally:
        long_series.settled = real
    ranges = [r["count"] for r in sizes[0].groupBy("__part").count().collect()]
    assert len(ranges) > 10 and max(ranges) < 4000
    assert sizes[1].count() < 16


def test_reach_forgets_the_start():
    for cutoff in (2.0, 6.0, 12.0):
        reach = long_series.low_pass_reach(cutoff)
        x = np.random.default_rng(1).normal(size=(4 * reach, 2))
        far = x.copy()
        far[: reach + 10] += 10
        a, b = (series.low_pass(cutoff)(v) for v in (x, far))
        assert np.allclose(a[2 * reach + 10 :], b[2 * reach + 10 :], rtol=0, atol=1e-12)
        assert not np.allclose(a[reach : reach + 20], b[reach : reach + 20], rtol=0, atol=1e-3)
    assert 100 < long_series.low_pass_reach() < 200


@pytest.mark.parametrize("n", [19, 20, 643, 644, 645, 689, 1400, 2300])
def test_blocks_are_the_whole_clip(spark, n):
    rng = np.random.default_rng(n)
    x = {"a": rng.normal(size=(n, 2)) + 50, "b": rng.normal(size=(23, 2))}
    df = spark.createDataFrame([(c, i, *map(float, v), f"{c}{i}") for c, m in x.items() for i, v in enumerate(m)], "clip string, i long, p double, q double, kind string")
    for long, whole in ((long_series.long_low_pass, series.low_pass()), (long_series.long_savgol, series.savgol()), (long_series.long_clean_signals, series.chain(series.low_pass(), series.savgol()))):
        rows = long(df, ["clip"], "i", ["p", "q"], block=64).collect()
        assert len(rows) == n + 23
        got = {(r.clip, r.i): (r.p, r.q) for r in rows}
        assert all(r.kind == f"{r.clip}{r.i}" for r in rows)
        for c, m in x.items():
            assert np.allclose([got[c, i] for i in range(len(m))], whole(m), rtol=0, atol=1e-9)


def test_long_gates(spark):
    df = spark.createDataFrame([(c, i, None if (c, i) == ("hole", 5) else float(i)) for c, n in (("short", 18), ("just", 19), ("hole", 40), (None, 25)) for i in range(n)], "clip string, i long, x double")
    out = long_series.long_clean_signals(df, ["clip"], "i", ["x"])
    assert {r.clip for r in out.collect()} == {"just", None} and out.count() == 44
    assert long_series.long_clean_signals(df.where("false"), ["clip"], "i", ["x"]).count() == 0


# --- functions on clips


def test_functions_of_any_shape(spark):
    def sums(key, table):
        x = table.column("x").to_numpy()
        return pa.table({"n": pa.array([len(x)], pa.int64()), "total": [float(np.nansum(x))]})

    df = spark.createDataFrame([(c, i, float(i)) for c, n in (("a", 5), ("b", 1), (None, 3)) for i in range(n)], "clip string, i int, x double")
    assert {tuple(r) for r in clip_map.map_clips(df, ["clip"], ["i"], sums, "n long, total double").collect()} == {("a", 5, 10.0), ("b", 1, 0.0), (None, 3, 3.0)}

    def twice(key, table):
        two = table.slice(0, 2 if key[0] == "a" else 0)
        for k in range(2):
            yield two.append_column("k", pa.array([k] * two.num_rows, pa.int32()))

    got = sorted(tuple(r) for r in clip_map.map_clips(df, ["clip"], ["i"], twice, "k int, i int").collect())
    assert got == [("a", 0, 0), ("a", 0, 1), ("a", 1, 0), ("a", 1, 1)]
    assert clip_map.map_clips(df.where("false"), ["clip"], ["i"], sums, "n long, total double").count() == 0
    with pytest.raises(ValueError, match="clip"):
        clip_map.map_clips(df, ["clip"], ["i"], sums, "clip string")


@pytest.mark.parametrize("batch", [3, 10_000])
def test_failures_stay_with_their_clip(spark, batch):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        df = spark.createDataFrame([(f"c{k}", i, float(i)) for k in range(20) for i in range(k)] + [(None, 0, 1.0)], "clip string, i int, x double")

        def fn(key, table):
            if key[0] in ("c5", "c11"):
                raise ValueError(f"cannot read {key[0]}")
            yield table.select(["i", "x"])
            if key[0] == "c7":
                raise KeyError("late")
            if key[0] == "c8":
                yield pa.table({"i": [1]})
            if key[0] == "c9":
                yield pa.table({"i": ["no number"], "x": [1.0]})

        tagged = clip_map.map_clips_isolated(df, ["clip"], ["i"], fn, "i int, x double").cache()
        outcomes = {r.clip: (r.outcome, r.n_rows, r.message) for r in clip_map.clip_outcomes(tagged, ["clip"]).collect()}
        bad = {"c5": "ValueError: cannot read c5", "c11": "ValueError: cannot read c11", "c7": "KeyError: 'late'", "c8": "ValueError: the function gave no column ['x']"}
        assert len(outcomes) == 20
        for k in range(1, 20):
            if k == 9:
                assert outcomes["c9"][0] == "failed" and "no number" in outcomes["c9"][2]
            else:
                assert outcomes[f"c{k}"] == (("failed", 0, bad[f"c{k}"]) if f"c{k}" in bad else ("written", k, None))
        rows = sorted((r.clip or "", r.i, r.x) for r in clip_map.clip_rows(tagged, ["clip"]).collect())
        assert rows == sorted([("", 0, 1.0), *[(f"c{k}", i, float(i)) for k in range(20) for i in range(k) if f"c{k}" not in bad and k != 9]])
        with pytest.raises(Exception, match="cannot read"):
            clip_map.map_clips_isolated(df, ["clip"], ["i"], fn, "i int, x double", errors=(KeyError,)).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
