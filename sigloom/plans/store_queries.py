"""Queries of readers, listings and stores over files that Spark writes from the given tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import codes
from ..operators import bucketed, release, series
from ..sources import clip_files, membership, tracking_source, versions, walk
from ..streaming.parts import run_clip_parts
from .filter_sql import low_pass_sql, savgol_sql
from .fixtures import CLIP, FILES_SQL, ORDER, SERIES_SQL, files, numbered
from .fixtures import series as events_series
from .queries import _clip_csv, _fill_report, _place, _smoothed
from .registry import register, rounded

_SERIES = f"series AS ({SERIES_SQL})"

# --- tracking tables by file


def _drifting_csv(spark: SparkSession, sf_dir: str) -> str:
    """CSV files of 40 headers: one or two index columns, columns in two orders and a column of the file's own; some texts hold line breaks."""
    folder = _place(spark, "drifting")
    text = F.when(F.col("event_id") % 3 == 0, F.concat("event_type", F.lit("\nand, more"))).otherwise(F.col("event_type"))
    rows = numbered(spark, sf_dir).select("user_id", "row_idx", "event_id", F.when(F.col("holed").isNull(), "NA").otherwise(F.col("value").cast("string")).alias("x_0"), text.alias("kind"), (F.col("user_id") % 20).alias("own"))
    header = F.when(F.col("own") % 2 == 0, F.concat(F.lit(",event_id,x_0,kind,own_"), "own")).otherwise(F.concat(F.lit(",Unnamed: 0,kind,own_"), "own", F.lit(",x_0,event_id")))
    quoted = F.concat(F.lit('"'), "kind", F.lit('"'))
    line = F.when(F.col("own") % 2 == 0, F.concat_ws(",", "row_idx", "event_id", "x_0", quoted, "own")).otherwise(F.concat_ws(",", "event_id", "row_idx", quoted, "own", "x_0", "event_id"))
    lines = rows.select("user_id", "row_idx", header.alias("header"), line.alias("line"))
    # One text a clip: the header, then its lines in an order that the index undoes.
    body = lines.groupBy("user_id").agg(F.first("header").alias("header"), F.array_join(F.array_sort(F.collect_list(F.struct(F.hash("row_idx").alias("h"), "line")))["line"], "\n").alias("body"))
    clip_files.write_lines(body.select("user_id", F.concat("header", F.lit("\n"), "body").alias("value")), folder, ["user_id"], [], "value", ".txt")
    return folder


@register(f"WITH {_SERIES} SELECT user_id, row_idx, event_id, holed AS x_0, CASE WHEN event_id % 3 = 0 THEN event_type || chr(10) || 'and, more' ELSE event_type END AS kind FROM series")
def sc4_tracking_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every file parsed once under its own header, with quoted line breaks, rows in the order of the index."""
    table = tracking_source.read_tracking_files(spark, _drifting_csv(spark, sf_dir), ["x_0", "event_id"], ["x_0", "event_id", "kind"], pattern="*.txt")
    clip = F.regexp_extract("path", "user_id=([0-9]+)", 1).cast("long")
    return table.select(clip.alias("user_id"), "row_idx", F.col("event_id").cast("long").alias("event_id"), "x_0", "kind")


@register(f"WITH {_SERIES} SELECT row_idx, value FROM series WHERE user_id = (SELECT min(user_id) FROM events)")
def sc5_clip_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One clip by its path; an absent one is an error."""
    rows = numbered(spark, sf_dir).select("user_id", "row_idx", "value")
    first = rows.agg(F.min("user_id")).first()[0]
    place = f"{_clip_csv(spark, rows)[0]}/channel={'speech' if first % 2 == 0 else 'song'}/actor={first % 24 + 1}/stem={first}"
    table = tracking_source.read_tracking_files(spark, place, ["value"], ["value"])
    return table.select("row_idx", "value")


# --- what is done


_TASKS = f"SELECT k, '02_smoothed_motion/' || channel || '/' || folder || '/' || stem || '.csv' AS output FROM ({FILES_SQL}) WHERE stage = '01_raw_motion'"


@register(f"WITH tasks AS ({_TASKS}), done AS (SELECT path AS output FROM ({FILES_SQL}) WHERE stage = '02_smoothed_motion' UNION ALL SELECT output FROM tasks WHERE k % 3 = 0) SELECT k, output FROM tasks WHERE output NOT IN (SELECT output FROM done)")
def jn1_skip_by_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw clips whose own output path is not there: a filter of the existing paths, exact for its hits."""
    found = files(spark, sf_dir)
    tasks = found.where("stage = '01_raw_motion'").select("k", codes.output_path("02_smoothed_motion", F.col("channel"), F.col("folder"), F.col("stem"), "csv").alias("output"))
    done = found.where("stage = '02_smoothed_motion'").select(F.col("path").alias("output")).unionAll(tasks.where("k % 3 = 0").select("output"))
    return membership.new_tasks(tasks, done, "output")


# --- stores

_FILLED = f"{_SERIES}, filled AS (SELECT *, last_value(holed IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS full_value FROM series)"
_STATUS = f"{_FILLED}, report AS (SELECT user_id, CASE WHEN count(*) = count(holed) THEN 'clean' WHEN count(*) = count(full_value) THEN 'filled' ELSE 'failed' END AS status FROM filled GROUP BY user_id)"


@register(f"WITH {_STATUS} SELECT f.user_id, f.event_id, CASE WHEN r.status = 'filled' THEN full_value ELSE holed END AS holed, CASE WHEN r.status = 'filled' THEN 'fill' ELSE 'raw' END AS run FROM filled f JOIN report r ON f.user_id = r.user_id")
def sk1_changed_clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second version of a dataset: filled clips come from the run that filled them, all others from their first files."""
    root = _place(spark, "versions")
    raw = events_series(spark, sf_dir).select("user_id", "ts", "event_id", "holed")
    versions.publish(raw, root, "user_id", "raw")
    changed = _fill_report(spark, sf_dir).where("status = 'filled'").select("user_id")
    filled = series.forward_fill(raw.join(changed, "user_id", "left_semi"), CLIP, ORDER, ["holed"])
    versions.publish(filled, root, "user_id", "fill")
    return versions.read_version(spark, root, "user_id long, ts timestamp, event_id long, holed double").select("user_id", "event_id", "holed", "run")


@register(f"WITH {_STATUS}, counts AS (SELECT status, count(*) AS n_clips FROM report GROUP BY status) SELECT 'one' AS run, 'fill' AS stage, status, n_clips FROM counts UNION ALL SELECT 'two', 'fill', status, n_clips FROM counts UNION ALL SELECT 'two', 'refill', status, n_clips FROM counts")
def sk5_run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log that two runs append to, of which one runs again."""
    folder, report = _place(spark, "log"), _fill_report(spark, sf_dir)
    once = release.run_report(report, "fill")
    for run, rows in (("one", once), ("two", once), ("one", once), ("two", once.unionAll(release.run_report(report, "refill")))):
        versions.append_run(rows, folder, run)
    return versions.read_runs(spark, folder, "stage string, status string, n_clips long").select("run", "stage", "status", "n_clips")


_OWN = f"{_SERIES}, own AS (SELECT user_id AS clip, row_idx, value AS x FROM series)"


@register(f"WITH {_OWN}, {savgol_sql('own', 'fit')} SELECT own.clip AS user_id, own.row_idx, round(own.x, 6) + 0.0 AS raw, round(fit.x, 6) + 0.0 AS smoothed FROM own JOIN fit ON own.clip = fit.clip AND own.row_idx = fit.row_idx")
def jn2_bucketed_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw and smoothed series stored in buckets by clip and joined where they lie."""
    names = [f"{stage}_{uuid.uuid4().hex}" for stage in ("raw", "smoothed")]
    raw = numbered(spark, sf_dir).select("user_id", "row_idx", "value")
    for name, rows in zip(names, (raw, _smoothed(spark, sf_dir))):
        bucketed.write_bucketed(rows, name, _place(spark, name), CLIP, ["row_idx"], 16)
    out = bucketed.paired_buckets(spark, *names, CLIP, ["row_idx"], "value")
    return out.select("user_id", "row_idx", rounded("raw"), rounded("smoothed"))


_PARTS = 3


def _parts_sql(late: str) -> str:
    return f"""WITH RECURSIVE {_OWN.replace("FROM series)", f"FROM series WHERE NOT ({late}))")}, {low_pass_sql('own', 'low')}, {savgol_sql('low', 'fit')} SELECT clip AS user_id, row_idx, round(x, 6) + 0.0 AS value FROM fit"""


@register(_parts_sql("user_id % 11 = 5"))
def in1_clip_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clips whose parts come over three loads, out of order and one twice, are cleaned once each; clips of which a part never comes stay out."""
    rows = numbered(spark, sf_dir).select("user_id", "row_idx", "value", F.lit(_PARTS).alias("parts"), (F.col("row_idx") % _PARTS).cast("int").alias("part"))
    rows = rows.where("not (user_id % 11 = 5 and part = 1)")
    folder, target, state = (_place(spark, x) for x in ("parts", "whole", "state"))
    loads = (F.col("part") + F.col("user_id")) % _PARTS
    for load in range(_PARTS):
        due = loads == load if load else (loads == load) | ((F.col("user_id") % 4 == 0) & (loads == 1))
        rows.where(due).repartition(2).write.mode("append").parquet(folder)
        run_clip_parts(spark, folder, "user_id long, row_idx long, value double, parts int, part int", state, target, lambda df: series.clean_signals(df, CLIP, ["row_idx"], ["value"]), "user_id", "part", "parts", ["row_idx", "value"])
    return spark.read.parquet(f"{target}/rows").select("user_id", "row_idx", rounded("value"))


# --- listings


@register(f"""WITH grid AS (SELECT CAST(a AS INTEGER) AS actor, c AS channel FROM range(1, 25) t(a), (VALUES ('speech'), ('song')) v(c)),
    clips AS (SELECT DISTINCT CASE WHEN user_id % 2 = 0 THEN 'speech' ELSE 'song' END AS channel, CAST(user_id % 24 + 1 AS INTEGER) AS actor, user_id AS stem FROM events)
    SELECT g.channel, g.actor, c.stem, CASE WHEN c.stem IS NULL THEN 'missing' ELSE 'listed' END AS status FROM grid g LEFT JOIN clips c ON c.actor = g.actor AND c.channel = g.channel""")
def sc1_walked_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files under every expected actor folder of a real tree, listed by tasks; folders that are not there are reported."""
    root = walk.qualified(spark, _clip_csv(spark, numbered(spark, sf_dir).select("user_id", "row_idx", "value"))[0])
    grid = spark.range(1, 25).select(F.col("id").cast("int").alias("actor"), F.explode(F.array(F.lit("speech"), F.lit("song"))).alias("channel"))
    found = walk.walk(spark, grid.select(F.concat(F.lit(f"{root}/channel="), "channel", F.lit("/actor="), "actor").alias("path")), "*.csv")
    named = lambda key: F.regexp_extract("path", f"{key}=([^/]*)", 1)
    return found.select(named("channel").alias("channel"), named("actor").cast("int").alias("actor"), named("stem").try_cast("long").alias("stem"), "status")
