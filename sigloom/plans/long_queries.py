"""Queries of clips of any length and of the user's functions on clips."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import clip_map, long_series, series
from ..session import settled
from .filter_sql import low_pass_sql, savgol_sql
from .fixtures import CLIP, LONG_CLIP, LONG_SQL, ORDER, SERIES_SQL, long_series_table, numbered
from .registry import register, rounded

#: Rows a block and ranges a scan: small, so that the clips of the given tables span many.
_BLOCK, _RANGES = 512, 24

_LONG = f"long AS ({LONG_SQL})"
_OVER = "OVER (PARTITION BY clip ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


@register(f"WITH {_LONG} SELECT clip, event_id, last_value(holed IGNORE NULLS) {_OVER} AS holed, last_value(kind IGNORE NULLS) {_OVER} AS kind FROM long")
def wn1_long_clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forward fill of a number and a text where a clip spans many tasks."""
    return long_series.scanned(long_series_table(spark, sf_dir), LONG_CLIP, ORDER, ["holed", "kind"], parts=_RANGES).select("clip", "event_id", "holed", "kind")


@register(f"WITH {_LONG} SELECT clip, event_id, row_idx FROM long")
def wn2_long_clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _numbered(spark, sf_dir).select("clip", "event_id", "row_idx")


def _numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return long_series.scanned(long_series_table(spark, sf_dir), LONG_CLIP, ORDER, position="row_idx", parts=_RANGES)


_OWN = f"{_LONG}, own AS (SELECT clip, row_idx, value AS x FROM long)"


@register(f"WITH RECURSIVE {_OWN}, {low_pass_sql('own', 'low')} SELECT clip, row_idx, round(x, 6) + 0.0 AS value FROM low")
def wn3_long_clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _numbered(spark, sf_dir).select("clip", "row_idx", "value")
    return long_series.long_low_pass(rows, LONG_CLIP, "row_idx", ["value"], _BLOCK).select("clip", "row_idx", rounded("value"))


@register(f"WITH {_OWN}, {savgol_sql('own', 'fit')} SELECT clip, row_idx, round(x, 6) + 0.0 AS value FROM fit")
def wn4_long_clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _numbered(spark, sf_dir).select("clip", "row_idx", "value")
    return long_series.long_savgol(rows, LONG_CLIP, "row_idx", ["value"], _BLOCK).select("clip", "row_idx", rounded("value"))


@register(f"""WITH RECURSIVE {_LONG}, filled AS (SELECT *, last_value(holed IGNORE NULLS) {_OVER} AS full_value FROM long),
    good AS (SELECT clip FROM filled GROUP BY clip HAVING count(*) = count(full_value) AND count(*) > 18),
    own AS (SELECT clip, row_idx, full_value AS x FROM filled WHERE clip IN (SELECT clip FROM good)),
    {low_pass_sql('own', 'low')}, {savgol_sql('low', 'fit')}
    SELECT l.clip, l.row_idx, l.event_type, round(fit.x, 6) + 0.0 AS holed FROM fit JOIN long l ON l.clip = fit.clip AND l.row_idx = fit.row_idx""")
def wn5_long_clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fill, position, gate, low-pass and smoothing: two exchanges, and no clip in one task."""
    rows = long_series.scanned(long_series_table(spark, sf_dir), LONG_CLIP, ORDER, ["holed"], "row_idx", _RANGES).select("clip", "row_idx", "event_type", "holed")
    return long_series.long_clean_signals(rows, LONG_CLIP, "row_idx", ["holed"], _BLOCK).select("clip", "row_idx", "event_type", rounded("holed"))


@register(f"""WITH {_LONG}, filled AS (SELECT *, last_value(holed IGNORE NULLS) {_OVER} AS f_holed, last_value(kind IGNORE NULLS) {_OVER} AS f_kind FROM long)
    SELECT clip, count(*) AS n_rows, 2 * count(*) - count(holed) - count(kind) AS nulls_before, 2 * count(*) - count(f_holed) - count(f_kind) AS nulls_after,
    CASE WHEN 2 * count(*) = count(holed) + count(kind) THEN 'clean' WHEN 2 * count(*) = count(f_holed) + count(f_kind) THEN 'filled' ELSE 'failed' END AS status FROM filled GROUP BY clip""")
def qg1_long_clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fill gate from minima and counts alone."""
    return long_series.long_fill_report(long_series_table(spark, sf_dir), LONG_CLIP, ORDER, ["holed", "kind"])


# --- functions on clips, and their failures


def _smooth_or_fail(key: tuple, table: pa.Table) -> pa.Table:
    """Smooths a clip; some clips cannot be read, some are cut short."""
    if key[0] % 7 == 3:
        raise ValueError(f"clip {key[0]} cannot be read")
    if key[0] % 11 == 4:
        raise EOFError(f"clip {key[0]} ends after row {table.num_rows - 1}")
    x = table.column("value").to_numpy().reshape(-1, 1)
    return pa.table({"row_idx": table.column("row_idx"), "value": series.savgol()(x)[:, 0]})


def _tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = numbered(spark, sf_dir).select("user_id", "row_idx", "value")
    return settled(clip_map.map_clips_isolated(rows, CLIP, ["row_idx"], _smooth_or_fail, "row_idx long, value double"), "isolated")


_FAILED = "user_id % 7 = 3 OR user_id % 11 = 4"


@register(f"""SELECT user_id, CASE WHEN {_FAILED} THEN 'failed' ELSE 'written' END AS outcome, CASE WHEN {_FAILED} THEN 0 ELSE count(*) END AS n_rows,
    CASE WHEN user_id % 7 = 3 THEN 'ValueError: clip ' || user_id || ' cannot be read' WHEN user_id % 11 = 4 THEN 'EOFError: clip ' || user_id || ' ends after row ' || (count(*) - 1) END AS message FROM events GROUP BY user_id""")
def qg6_failure_isolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What became of each clip where the function raises on some."""
    return clip_map.clip_outcomes(_tagged(spark, sf_dir), CLIP)


@register(f"WITH series AS ({SERIES_SQL}), own AS (SELECT user_id AS clip, row_idx, value AS x FROM series WHERE NOT ({_FAILED})), {savgol_sql('own', 'fit')} SELECT clip AS user_id, row_idx, round(x, 6) + 0.0 AS value FROM fit")
def qg6_isolated_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the clips that the function did not fail on."""
    return clip_map.clip_rows(_tagged(spark, sf_dir), CLIP).select("user_id", "row_idx", rounded("value"))


def _summary(key: tuple, table: pa.Table) -> pa.Table:
    x = table.column("value").to_numpy()
    return pa.table({"n_frames": pa.array([len(x)], pa.int64()), "least": [x.min()], "most": [x.max()], "path_length": [float(np.abs(np.diff(x)).sum())]})


@register(f"""WITH series AS ({SERIES_SQL}), steps AS (SELECT user_id, value, abs(value - lag(value) OVER (PARTITION BY user_id ORDER BY row_idx)) AS step FROM series)
    SELECT user_id, count(*) AS n_frames, min(value) AS least, max(value) AS most, round(coalesce(sum(step), 0), 6) + 0.0 AS path_length FROM steps GROUP BY user_id""")
def ud2_clip_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row of its own schema for each clip."""
    rows = numbered(spark, sf_dir).select("user_id", "row_idx", "value")
    out = clip_map.map_clips(rows, CLIP, ["row_idx"], _summary, "n_frames long, least double, most double, path_length double")
    return out.select("user_id", "n_frames", "least", "most", rounded("path_length"))


def _halves(key: tuple, table: pa.Table):
    """Each frame and a frame half-way to the next one, in two tables."""
    x, at = table.column("value").to_numpy(), table.column("row_idx").to_numpy()
    yield pa.table({"half_frame": 2 * at, "value": x})
    yield pa.table({"half_frame": 2 * at + 1, "value": (x + np.append(x[1:], x[-1:])) / 2})


@register(f"""WITH series AS ({SERIES_SQL}) SELECT user_id, 2 * row_idx AS half_frame, round(value, 6) + 0.0 AS value FROM series
    UNION ALL SELECT user_id, 2 * row_idx + 1, round((value + coalesce(lead(value) OVER (PARTITION BY user_id ORDER BY row_idx), value)) / 2, 6) + 0.0 FROM series""")
def ud2_two_per_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two rows for each frame."""
    rows = numbered(spark, sf_dir).select("user_id", "row_idx", "value")
    return clip_map.map_clips(rows, CLIP, ["row_idx"], _halves, "half_frame long, value double").select("user_id", "half_frame", rounded("value"))
