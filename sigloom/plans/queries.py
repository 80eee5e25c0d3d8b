"""The registered queries of the signal and release operators, with their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import codes
from ..functions.values import FILTER_RATE, RENDER_RATE, numeric, seconds
from ..operators import compare, features, release, series
from ..session import scratch_dir, settled
from ..sources import catalog, clip_files, tracking
from ..streaming.incremental import run_new_files
from .filter_sql import low_pass_sql, savgol_sql
from .fixtures import CLIP, FILES_SQL, LINE_CHANNELS, LINE_CLIP, LINE_ORDER, ORDER, SERIES_SQL, STEM, files, lines, numbered, stems, table
from .fixtures import series as events_series
from .registry import ORACLE_SQL, QUERIES, register, rounded

# --- names and codes ---------------------------------------------------------------------------

_STEMS = f"stems AS (SELECT k, {STEM} AS stem FROM (SELECT o_orderkey AS k FROM orders))"
_CODES = f"""{_STEMS}, parts AS (SELECT k, stem, string_split(stem, '-') AS p FROM stems),
    codes AS (SELECT *, CASE WHEN len(p) <> 7 THEN concat('expected 7 parts, found ', len(p))
                             WHEN NOT regexp_full_match(p[7], '\\s*[+-]?[0-9]+\\s*') THEN 'actor is not an integer' END AS reason FROM parts),
    clips AS (SELECT *, CASE WHEN reason IS NULL THEN CAST(trim(p[7]) AS INTEGER) END AS actor,
                     reason IS NULL AND p[1] = '01' AND p[2] IN ('01', '02') AND NOT (CAST(CASE WHEN reason IS NULL THEN p[7] END AS INTEGER) = 18 AND p[2] = '02') AS eligible FROM codes)"""


@register(f"WITH {_CODES} SELECT k, stem, " + ", ".join(f"p[{i + 1}] AS {n}" for i, n in enumerate(codes.PARTS[:6])) + ", actor FROM clips WHERE reason IS NULL")
def pr1_decode_clip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stems(spark, sf_dir).withColumn("code", codes.clip_code(F.col("stem"))).where("code is not null").select("k", "stem", "code.*")


@register(f"WITH {_CODES} SELECT k, CASE p[2] WHEN '01' THEN 'speech' WHEN '02' THEN 'song' END AS channel FROM clips WHERE reason IS NULL")
def pr2_channel_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = stems(spark, sf_dir).withColumn("code", codes.clip_code(F.col("stem"))).where("code is not null")
    return coded.select("k", codes.channel_label(F.col("code.vocal_channel")).alias("channel"))


@register("SELECT o_orderkey AS k, printf('Actor_%02d', o_orderkey) AS folder FROM orders")
def pr3_actor_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), codes.actor_folder(F.col("o_orderkey")).alias("folder"))


@register(f"SELECT k, '02_smoothed_motion/' || channel || '/' || folder || '/' || stem || '.csv' AS output FROM ({FILES_SQL})")
def pr4_output_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files(spark, sf_dir).select("k", codes.output_path("02_smoothed_motion", F.col("channel"), F.col("folder"), F.col("stem"), "csv").alias("output"))


_VIDEO = ["action_unit_activation/speech", "landmark_plot/speech", "landmark_overlay/speech"]


@register(f"""SELECT path, CASE WHEN starts_with(path, stage || '/speech/') AND stage NOT LIKE '0%' THEN stage || '/' || folder || '/' || stem || '.' || ext END AS member FROM ({FILES_SQL})""")
def pr5_archive_member(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files(spark, sf_dir).select("path", codes.member_name(F.col("path"), _VIDEO).alias("member"))


@register(f"WITH {_CODES} SELECT k, stem FROM clips WHERE eligible")
def fi1_eligible(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stems(spark, sf_dir).where(codes.eligible(codes.clip_code(F.col("stem"))))


@register(f"WITH {_CODES} SELECT k, stem, reason FROM clips WHERE reason IS NOT NULL")
def fi2_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.quarantined(stems(spark, sf_dir).withColumn("reason", codes.reject_reason(F.col("stem"))))


@register(f"SELECT k, folder FROM ({FILES_SQL}) WHERE CAST(substr(folder, 7) AS INTEGER) BETWEEN 1 AND 24")
def fi3_actor_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _catalog(spark, sf_dir).where(codes.in_actor_range(F.col("folder_actor"))).select("k", "folder")


@register(f"WITH {_CODES} SELECT k, stem, actor, eligible FROM clips WHERE actor = 18 AND p[1] = '01'")
def fi4_no_song_actor(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = stems(spark, sf_dir).withColumn("code", codes.clip_code(F.col("stem"))).where("code.actor = 18 and code.modality = '01'")
    return coded.select("k", "stem", "code.actor", codes.eligible(F.col("code")).alias("eligible"))


# --- catalogs ----------------------------------------------------------------------------------


def _catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.clips(files(spark, sf_dir).withColumn("stem", F.lit(None).cast("string")))


_CATALOG = f"""{_CODES}, files AS ({FILES_SQL}), catalog AS (SELECT f.*, c.eligible, c.reason, c.p[2] AS code_channel, CAST(substr(folder, 7) AS INTEGER) AS folder_actor FROM files f JOIN clips c ON f.k = c.k)"""


@register(f"WITH {_CATALOG} SELECT k, path, length FROM catalog WHERE eligible AND folder_actor BETWEEN 1 AND 24 AND stage = '01_raw_motion'")
def sc2_raw_clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.processable(_catalog(spark, sf_dir)).where("stage = '01_raw_motion'").select("k", "path", "length")


_LISTED = """SELECT {g}, f.path, CASE WHEN f.path IS NULL THEN 'missing' ELSE 'listed' END AS status FROM ({grid}) g LEFT JOIN ({rows}) f ON {on}"""
_ACTORS_SQL = "SELECT CAST(a AS INTEGER) AS actor FROM range(1, 25) t(a)"


@register(f"WITH {_CATALOG} " + _LISTED.format(g="g.actor", grid=_ACTORS_SQL, rows="SELECT * FROM catalog WHERE stage = 'action_unit_activation' AND ext = 'mp4' AND length < 300", on="f.folder_actor = g.actor"))
def sc1_video_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Videos by actor folder; folders without one are reported and stop nothing."""
    videos = _catalog(spark, sf_dir).where("stage = 'action_unit_activation' and ext = 'mp4' and length < 300")
    return catalog.actor_listing(videos, spark)


@register(f"WITH {_CATALOG} " + _LISTED.format(g="g.actor, g.channel", grid=f"SELECT actor, channel FROM ({_ACTORS_SQL}), (VALUES ('speech'), ('song')) v(channel)", rows="SELECT * FROM catalog WHERE stage = '02_smoothed_motion' AND ext = 'csv' AND length < 200", on="f.folder_actor = g.actor AND f.channel = g.channel"))
def sc3_smoothed_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = _catalog(spark, sf_dir).drop("channel").join(files(spark, sf_dir).select("k", "channel"), "k")
    return catalog.actor_listing(tables.where("stage = '02_smoothed_motion' and ext = 'csv' and length < 200"), spark, ["channel"])


@register(
    f"""WITH {_CATALOG}, grid AS (SELECT a AS actor, c AS channel FROM range(1, 25) t(a), (VALUES ('speech'), ('song')) v(c) WHERE NOT (a = 18 AND c = 'song'))
    SELECT CAST(g.actor AS INTEGER) AS actor, g.channel FROM grid g WHERE NOT EXISTS (SELECT 1 FROM catalog x WHERE x.eligible AND x.folder_actor = g.actor AND x.channel = g.channel AND x.stage = '02_smoothed_motion' AND x.length < 140)"""
)
def sc7_uncovered(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _catalog(spark, sf_dir).drop("channel").join(files(spark, sf_dir).select("k", "channel"), "k")
    seen = found.where("eligible and stage = '02_smoothed_motion' and length < 140").select(F.col("folder_actor").alias("actor"), "channel")
    return catalog.uncovered(catalog.expected_coverage(spark), seen)


@register(f"WITH {_CATALOG} SELECT path, row_number() OVER (ORDER BY code_channel = '02', folder, stem, path) - 1 AS place FROM catalog WHERE eligible AND folder_actor BETWEEN 1 AND 24 AND stage = '01_raw_motion'")
def st1_ordered_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = catalog.processable(_catalog(spark, sf_dir)).where("stage = '01_raw_motion'")
    rows = rows.withColumn("song", F.col("code.vocal_channel") == "02")
    # Numbered within folders and shifted by what stands before, so that no task sorts all paths.
    place = F.row_number().over(Window.partitionBy("song", "folder").orderBy("stem", "path")) - 1
    counts = rows.groupBy("song", "folder").agg(F.count("*").alias("n"))
    before = counts.select("song", "folder", (F.sum("n").over(Window.orderBy("song", "folder")) - F.col("n")).alias("before"))
    return rows.withColumn("within", place).join(F.broadcast(before), ["song", "folder"]).select("path", (F.col("before") + F.col("within")).alias("place"))


@register(f"WITH files AS ({FILES_SQL}) SELECT DISTINCT path FROM (SELECT path FROM files UNION ALL SELECT path FROM files WHERE k % 3 = 0)")
def st2_distinct_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = files(spark, sf_dir)
    return found.unionAll(found.where("k % 3 = 0")).dropDuplicates(["path"]).select("path")


@register(f"WITH {_CATALOG} SELECT path FROM catalog WHERE eligible AND folder_actor BETWEEN 1 AND 24 ORDER BY CASE code_channel WHEN '02' THEN 'song' ELSE 'speech' END, folder, stem, path LIMIT 1")
def st3_first_eligible(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.processable(_catalog(spark, sf_dir)).orderBy("channel", "actor_dir", "stem", "path").limit(1).select("path")


@register(f"WITH files AS ({FILES_SQL}) SELECT k, stem FROM files f WHERE stage = '01_raw_motion' AND NOT EXISTS (SELECT 1 FROM files o WHERE o.stage = '02_smoothed_motion' AND o.length < 110 AND o.channel = f.channel AND o.folder = f.folder)")
def jn1_skip_done(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = files(spark, sf_dir)
    done = found.where("stage = '02_smoothed_motion' and length < 110").select("channel", "folder")
    return catalog.not_yet_done(found.where("stage = '01_raw_motion'"), done, ["channel", "folder"]).select("k", "stem")


# --- series ------------------------------------------------------------------------------------

_SERIES = f"series AS ({SERIES_SQL})"
_FILLED = f"{_SERIES}, filled AS (SELECT *, last_value(holed IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS full_value FROM series)"


@register(f"""WITH {_SERIES}, holes AS (SELECT *, CASE WHEN event_id % 5 = 0 THEN NULL ELSE event_type END AS kind FROM series)
    SELECT user_id, event_id, last_value(holed IGNORE NULLS) OVER w AS holed, last_value(kind IGNORE NULLS) OVER w AS kind FROM holes
    WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def wn1_forward_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = events_series(spark, sf_dir).withColumn("kind", F.when(F.col("event_id") % 5 != 0, F.col("event_type")))
    return series.forward_fill(df, CLIP, ORDER, ["holed", "kind"]).select("user_id", "event_id", "holed", "kind")


@register(f"WITH {_SERIES} SELECT user_id, event_id, row_idx FROM series")
def wn2_row_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    return numbered(spark, sf_dir).select("user_id", "event_id", "row_idx")


_WHOLE = f"{_SERIES}, own AS (SELECT user_id AS clip, row_idx, value AS x FROM series)"


@register(f"WITH RECURSIVE {_WHOLE}, {low_pass_sql('own', 'low')} SELECT clip AS user_id, row_idx, round(x, 6) + 0.0 AS value FROM low")
def wn3_low_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = numbered(spark, sf_dir).select("user_id", "row_idx", "value")
    return series.map_channels(rows, CLIP, ["row_idx"], ["value"], series.low_pass()).select("user_id", "row_idx", rounded("value"))


@register(f"WITH {_WHOLE}, {savgol_sql('own', 'fit')} SELECT clip AS user_id, row_idx, round(x, 6) + 0.0 AS value FROM fit")
def wn4_savgol(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = numbered(spark, sf_dir).select("user_id", "row_idx", "value")
    return series.map_channels(rows, CLIP, ["row_idx"], ["value"], series.savgol()).select("user_id", "row_idx", rounded("value"))


@register(ORACLE_SQL["wn4_savgol"])
def wn4_savgol_native(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = series.savgol_native(numbered(spark, sf_dir), CLIP, ["row_idx"], "value", "smoothed")
    return out.select("user_id", "row_idx", rounded("smoothed", "value"))


@register(f"WITH {_SERIES}, own AS (SELECT user_id AS clip, row_idx, value AS x FROM series WHERE row_idx < 9 + user_id % 6), {savgol_sql('own', 'fit')} SELECT clip AS user_id, row_idx, round(x, 6) + 0.0 AS value FROM fit")
def wn4_savgol_short(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = numbered(spark, sf_dir).where("row_idx < 9 + user_id % 6").select("user_id", "row_idx", "value")
    return series.map_channels(rows, CLIP, ["row_idx"], ["value"], series.savgol()).select("user_id", "row_idx", rounded("value"))


@register(f"""WITH RECURSIVE {_FILLED}, good AS (SELECT user_id FROM filled GROUP BY user_id HAVING count(*) = count(full_value) AND count(*) > 18),
    own AS (SELECT user_id AS clip, row_idx, full_value AS x FROM filled WHERE user_id IN (SELECT user_id FROM good)),
    {low_pass_sql('own', 'low')}, {savgol_sql('low', 'fit')}
    SELECT s.user_id, s.row_idx, s.event_type, round(fit.x, 6) + 0.0 AS holed FROM fit JOIN series s ON s.user_id = fit.clip AND s.row_idx = fit.row_idx""")
def wn5_clean_signal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Position, fill, gate, low-pass and smoothing: one exchange by clip serves them all."""
    filled = series.forward_fill(numbered(spark, sf_dir), CLIP, ORDER, ["holed"])
    ready = series.complete_clips(filled, CLIP, ["holed"]).select("user_id", "row_idx", "event_type", "holed")
    return series.clean_signals(ready, CLIP, ["row_idx"], ["holed"]).select("user_id", "row_idx", "event_type", rounded("holed"))


_LINES = f"numbered AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY {', '.join(LINE_ORDER)}) - 1 AS row_idx FROM lineitem)"
_CHANNEL_CTES = ", ".join(f"o{i} AS (SELECT l_suppkey AS clip, row_idx, {c} AS x FROM numbered), {savgol_sql(f'o{i}', f's{i}')}" for i, c in enumerate(LINE_CHANNELS))


@register(f"WITH {_LINES}, {_CHANNEL_CTES} SELECT s0.clip AS l_suppkey, s0.row_idx, " + ", ".join(f"round(s{i}.x, 6) + 0.0 AS {c}" for i, c in enumerate(LINE_CHANNELS)) + " FROM s0 " + " ".join(f"JOIN s{i} ON s{i}.clip = s0.clip AND s{i}.row_idx = s0.row_idx" for i in range(1, 4)))
def ud1_channel_function(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A matrix function of the user's on four channels of each series."""
    rows = series.with_position(lines(spark, sf_dir), LINE_CLIP, LINE_ORDER).select("l_suppkey", "row_idx", *LINE_CHANNELS)
    out = series.map_channels(rows, LINE_CLIP, ["row_idx"], LINE_CHANNELS, series.savgol())
    return out.select("l_suppkey", "row_idx", *[rounded(c) for c in LINE_CHANNELS])


@register(f"WITH {_SERIES} SELECT user_id, row_idx, round(value - first_value(value) OVER (PARTITION BY user_id ORDER BY row_idx), 6) + 0.0 AS value FROM series")
def ud2_clip_function(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = numbered(spark, sf_dir).select("user_id", "row_idx", "value")
    return series.map_channels(rows, CLIP, ["row_idx"], ["value"], lambda x: x - x[0]).select("user_id", "row_idx", rounded("value"))


@register(f"WITH {_SERIES} SELECT user_id, count(*) AS n_rows, count(*) - count(holed) AS nulls_holed, count(*) - count(event_type) AS nulls_event_type, 2 * count(*) - count(holed) - count(event_type) AS nulls FROM series GROUP BY user_id")
def ag1_null_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.null_counts(events_series(spark, sf_dir), CLIP, ["holed", "event_type"])


_REPORT = f"""{_FILLED}, report AS (SELECT user_id, count(*) AS n_rows, count(*) - count(holed) AS nulls_before, count(*) - count(full_value) AS nulls_after,
    CASE WHEN count(*) = count(holed) THEN 'clean' WHEN count(*) = count(full_value) THEN 'filled' ELSE 'failed' END AS status FROM filled GROUP BY user_id)"""


def _fill_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.fill_report(events_series(spark, sf_dir), CLIP, ORDER, ["holed"])


@register(f"WITH {_REPORT} SELECT user_id % 10 AS folder, count(*) OVER (PARTITION BY user_id % 10) AS n_modified, row_number() OVER (PARTITION BY user_id % 10 ORDER BY user_id) - 1 AS place, user_id FROM report WHERE nulls_before > 0")
def ag2_modified_clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changed clips by folder: how many, and each with its place in the ordered list."""
    changed = settled(_fill_report(spark, sf_dir).where("nulls_before > 0").select((F.col("user_id") % 10).alias("folder"), "user_id"), "changed")
    listed = series.place_in_groups(changed, ["folder"], F.floor(F.col("user_id") / 10_000), ["user_id"])
    return listed.join(changed.groupBy("folder").agg(F.count("*").alias("n_modified")), "folder").select("folder", "n_modified", "place", "user_id")


@register(f"WITH {_REPORT} SELECT * FROM report")
def qg1_fill_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fill_report(spark, sf_dir)


@register(f"""WITH {_FILLED}, short AS (SELECT * FROM filled WHERE row_idx < CASE user_id % 4 WHEN 0 THEN 18 WHEN 1 THEN 19 ELSE 1000000 END)
    SELECT user_id, count(*) AS n_rows, count(*) - count(full_value) AS nulls, CASE WHEN count(*) <= 18 THEN 'too_short' WHEN count(*) > count(full_value) THEN 'has_null' ELSE 'ready' END AS status FROM short GROUP BY user_id""")
def qg3_signal_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.signal_report(_shortened(spark, sf_dir), CLIP, ["holed"])


def _shortened(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = series.forward_fill(numbered(spark, sf_dir), CLIP, ORDER, ["holed"])
    return filled.where("row_idx < CASE user_id % 4 WHEN 0 THEN 18 WHEN 1 THEN 19 ELSE 1000000 END")


@register(ORACLE_SQL["qg3_signal_gate"].replace("AS status FROM", "AS status, CASE WHEN count(*) <= 18 THEN 'too_short' WHEN count(*) > count(full_value) THEN 'has_null' ELSE 'written' END AS outcome FROM"))
def qg6_isolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _shortened(spark, sf_dir).select("user_id", "row_idx", "holed")
    written = settled(series.clean_signals(rows, CLIP, ["row_idx"], ["holed"]), "clean")
    return series.isolated(series.signal_report(rows, CLIP, ["holed"]), written, CLIP)


# --- features ----------------------------------------------------------------------------------

_DIMS = 64


def _frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as frames; by rule, one element of some is null, NaN or infinite."""
    at = lambda i: F.col("embedding")[i].cast("double")
    broken = F.when(F.col("vec_id") % 11 == 0, F.lit(None).cast("double")).when(F.col("vec_id") % 13 == 0, F.lit(float("nan"))).when(F.col("vec_id") % 17 == 0, F.lit(float("inf"))).otherwise(at(0))
    return table(spark, sf_dir, "embeddings").select("vec_id", "label", broken.alias("c0"), *[at(i).alias(f"c{i}") for i in range(1, _DIMS)])


_BROKEN = "(vec_id % 11 = 0 OR vec_id % 13 = 0 OR vec_id % 17 = 0)"


@register("SELECT l_suppkey, " + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in LINE_CHANNELS) + ", l_returnflag FROM lineitem")
def pr6_channel_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.project_channels(lines(spark, sf_dir).select("l_suppkey", *LINE_CHANNELS, "l_returnflag"), LINE_CHANNELS)


@register("SELECT vec_id, u - 1 AS unit, round(CAST(embedding[u] AS DOUBLE), 6) + 0.0 AS value FROM embeddings, range(1, 21) t(u) WHERE NOT (u = 1 AND (vec_id % 11 = 0 OR vec_id % 13 = 0 OR vec_id % 17 = 0))")
def pr7_au_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _frames(spark, sf_dir).select("vec_id", features.au_vector([f"c{i}" for i in range(20)]).alias("aus"))
    out = rows.select("vec_id", F.posexplode("aus").alias("unit", "value")).where("not (unit = 0 and (vec_id % 11 = 0 or vec_id % 13 = 0 or vec_id % 17 = 0))")
    return out.select("vec_id", F.col("unit").cast("long").alias("unit"), rounded("value"))


@register(f"SELECT vec_id FROM embeddings WHERE NOT {_BROKEN}")
def fi6_usable_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _frames(spark, sf_dir).where(features.usable(features.au_vector([f"c{i}" for i in range(20)]))).select("vec_id")


@register(f"SELECT CAST(floor(vec_id / 100) AS BIGINT) AS clip, count(*) AS n_frames, count(*) FILTER ({_BROKEN}) AS n_omitted, coalesce(array_to_string(list(vec_id ORDER BY vec_id) FILTER ({_BROKEN}), ','), '') AS omitted FROM embeddings GROUP BY clip")
def ag4_omitted_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = _frames(spark, sf_dir).withColumn("clip", F.floor(F.col("vec_id") / 100))
    found = features.omitted_frames(frames, ["clip"], "vec_id", features.au_vector([f"c{i}" for i in range(20)]))
    return found.withColumn("omitted", F.array_join(F.transform("omitted", lambda x: x.cast("string")), ","))


@register("SELECT user_id, count(*) AS n_frames FROM events GROUP BY user_id")
def ag5_frames_per_clip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_series(spark, sf_dir).groupBy("user_id").agg(F.count("*").alias("n_frames"))


_GEOMETRY = [f"c{i}" for i in range(20, 30)], [f"c{i}" for i in range(30, 40)], [f"c{i}" for i in range(40, 44)], [f"c{i}" for i in range(44, 47)]
_POINTS = """SELECT vec_id, u - 21 AS point, round(CAST(embedding[u] AS DOUBLE) * {sx}, 6) + 0.0 AS x, round(CAST(embedding[u + 10] AS DOUBLE) * {sy}, 6) + 0.0 AS y,
    round(CAST(embedding[43] AS DOUBLE) * {sx}, 6) + 0.0 AS box_width, round(CAST(embedding[46] AS DOUBLE), 6) + 0.0 AS roll FROM embeddings, range(21, 31) t(u)"""


def _points(df: DataFrame) -> DataFrame:
    flat = df.select("vec_id", "g", F.posexplode("g.points").alias("point", "p"))
    return flat.select("vec_id", F.col("point").cast("long").alias("point"), rounded("p.x", "x"), rounded("p.y", "y"), rounded("g.box.width", "box_width"), rounded("g.pose.roll", "roll"))


@register(_POINTS.format(sx="1.0", sy="1.0"))
def pr8_landmark_geometry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _points(_frames(spark, sf_dir).select("vec_id", features.geometry(*_GEOMETRY).alias("g")))


@register(_POINTS.format(sx="CAST(1280.0 / 640.0 AS DOUBLE)", sy="CAST(720.0 / 480.0 AS DOUBLE)"))
def pr9_pixel_scaling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _points(_frames(spark, sf_dir).select("vec_id", features.scaled(features.geometry(*_GEOMETRY), (640.0, 480.0)).alias("g")))


@register(f"WITH files AS ({FILES_SQL}), points AS ({_POINTS.format(sx='CAST(1280.0 / 640.0 AS DOUBLE)', sy='CAST(720.0 / 480.0 AS DOUBLE)')}) SELECT p.*, f.path AS source_path FROM points p JOIN files f ON f.k = p.vec_id")
def jn5_geometry_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scaled geometry with the clip file that it is drawn on."""
    clips = files(spark, sf_dir).select(F.col("k").alias("vec_id"), "path")
    frames = _frames(spark, sf_dir).select("vec_id", features.scaled(features.geometry(*_GEOMETRY), (640.0, 480.0)).alias("g"))
    placed = features.on_source(frames, clips, "vec_id")
    flat = placed.select("vec_id", "g", "source_path", F.posexplode("g.points").alias("point", "p"))
    return flat.select("vec_id", F.col("point").cast("long").alias("point"), rounded("p.x", "x"), rounded("p.y", "y"), rounded("g.box.width", "box_width"), rounded("g.pose.roll", "roll"), "source_path")


# --- raw against smoothed ----------------------------------------------------------------------


@register("SELECT event_id, TRY_CAST(regexp_extract(props, '[0-9]+') || CASE WHEN event_id % 3 = 0 THEN 'x' ELSE '' END AS DOUBLE) AS number FROM events")
def pr10_numeric_coercion(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.regexp_extract("props", "[0-9]+", 0), F.when(F.col("event_id") % 3 == 0, "x").otherwise(""))
    return table(spark, sf_dir, "events").select("event_id", numeric(text).alias("number"))


@register(f"WITH {_SERIES} SELECT user_id, event_id, CAST(row_idx AS DOUBLE) AS frame FROM series")
def pr11_frame_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events_series(spark, sf_dir)
    return rows.select("user_id", "event_id", compare.frame_or_position(rows, CLIP, ORDER).alias("frame"))


@register(f"WITH {_SERIES} SELECT user_id, event_id, TRY_CAST(CASE WHEN event_id % 9 = 0 THEN 'lost' ELSE CAST(2 * row_idx AS VARCHAR) END AS DOUBLE) AS frame FROM series")
def pr11_frame_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A frame column that the table has: its numbers, null where it holds none."""
    framed = F.when(F.col("event_id") % 9 == 0, "lost").otherwise((2 * F.col("row_idx")).cast("string"))
    rows = numbered(spark, sf_dir).withColumn("frame", framed)
    return rows.select("user_id", "event_id", compare.frame_or_position(rows, CLIP, ORDER).alias("frame"))


@register(f"WITH {_SERIES} SELECT user_id, row_idx, round(row_idx / CAST(29.97 AS DOUBLE), 6) + 0.0 AS filter_seconds, round(row_idx / CAST(30 AS DOUBLE), 6) + 0.0 AS render_seconds FROM series")
def pr13_frame_clock(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = numbered(spark, sf_dir).withColumns({"f": seconds(F.col("row_idx"), FILTER_RATE), "r": seconds(F.col("row_idx"), RENDER_RATE)})
    return rows.select("user_id", "row_idx", rounded("f", "filter_seconds"), rounded("r", "render_seconds"))


@register(f"WITH {_SERIES} SELECT user_id, CAST(row_idx AS DOUBLE) AS frame, holed AS value, 'Raw' AS series FROM series WHERE holed IS NOT NULL")
def fi5_drop_incomplete(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.long_series(events_series(spark, sf_dir), CLIP, ORDER, "holed", "Raw")


def _smoothed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.map_channels(numbered(spark, sf_dir).select("user_id", "row_idx", "value"), CLIP, ["row_idx"], ["value"], series.savgol())


@register(f"""WITH {_WHOLE}, {savgol_sql('own', 'fit')} SELECT clip AS user_id, CAST(row_idx AS DOUBLE) AS frame, round(x, 6) + 0.0 AS value, 'Raw' AS series FROM own
    UNION ALL SELECT clip, CAST(row_idx AS DOUBLE), round(x, 6) + 0.0, 'Smoothed' FROM fit""")
def un1_stack(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = compare.long_series(numbered(spark, sf_dir), CLIP, ["row_idx"], "value", "Raw")
    smooth = compare.long_series(_smoothed(spark, sf_dir), CLIP, ["row_idx"], "value", "Smoothed")
    return compare.stacked(raw, smooth).select("user_id", "frame", rounded("value"), "series")


@register(f"WITH {_SERIES} SELECT user_id, series, count(*) AS n_points FROM (SELECT user_id, 'Raw' AS series FROM series UNION ALL SELECT user_id, 'Smoothed' FROM series) GROUP BY ALL")
def pr12_series_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = compare.long_series(numbered(spark, sf_dir), CLIP, ["row_idx"], "value", "Raw")
    return compare.stacked(raw, compare.long_series(_smoothed(spark, sf_dir), CLIP, ["row_idx"], "value", "Smoothed")).groupBy("user_id", "series").agg(F.count("*").alias("n_points"))


@register(f"WITH {_WHOLE}, {savgol_sql('own', 'fit')} SELECT own.clip AS user_id, own.row_idx, round(own.x, 6) + 0.0 AS raw, round(fit.x, 6) + 0.0 AS smoothed FROM own JOIN fit ON own.clip = fit.clip AND own.row_idx = fit.row_idx")
def jn2_raw_smoothed(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = compare.paired(numbered(spark, sf_dir).select("user_id", "row_idx", "value"), _smoothed(spark, sf_dir), ["user_id", "row_idx"], "value")
    return out.select("user_id", "row_idx", rounded("raw"), rounded("smoothed"))


# --- release -----------------------------------------------------------------------------------

_SPECS = "specs AS (SELECT * FROM (VALUES " + ", ".join(f"('{name}_{c}.zip', '{a}', '{c}', '{stage}', '{ext}', {len(of) > 1})" for name, of in release.ARCHIVES for c in release.EXPECTED for a, stage, ext in release.ARTEFACTS if a in of) + ") v(archive, artifact, channel, stage, ext, many))"
_COUNTS = f"files AS ({FILES_SQL}), {_SPECS}, counts AS (SELECT s.artifact, s.channel, count(f.k) AS n FROM specs s LEFT JOIN files f ON f.stage = s.stage AND f.channel = s.channel AND f.ext = s.ext GROUP BY ALL)"


def _counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return release.artefact_counts(files(spark, sf_dir), release.archive_specs(spark))


@register(f"WITH {_COUNTS} SELECT * FROM counts")
def ag3_artefact_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _counts(spark, sf_dir)


@register(f"SELECT stage, count(*) AS n_tasks FROM ({FILES_SQL}) GROUP BY stage")
def ag6_task_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return release.task_counts(files(spark, sf_dir))


@register(f"WITH {_COUNTS} SELECT artifact, channel, n, CAST(CASE channel WHEN 'speech' THEN 1440 ELSE 1012 END AS BIGINT) AS expected, CASE WHEN n = CASE channel WHEN 'speech' THEN 1440 ELSE 1012 END THEN 'ok' ELSE 'mismatch' END AS status FROM counts")
def qg4_release_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return release.audited(_counts(spark, sf_dir), release.expected_counts(spark))


@register(f"WITH {_COUNTS} SELECT artifact, channel, n, CASE WHEN artifact LIKE '%motion' THEN CASE WHEN n = CASE channel WHEN 'speech' THEN 1440 ELSE 1012 END THEN 'ok' ELSE 'mismatch' END ELSE 'no_expectation' END AS status FROM counts")
def jn3_observed_expected(spark: SparkSession, sf_dir: str) -> DataFrame:
    expected = release.expected_counts(spark).where("artifact like '%motion'")
    return release.audited(_counts(spark, sf_dir), expected).drop("expected")


_MEMBERS = f"{_COUNTS}, members AS (SELECT DISTINCT archive, path, CASE WHEN many THEN f.stage || '/' ELSE '' END || folder || '/' || stem || '.' || f.ext AS member FROM files f JOIN specs s ON f.stage = s.stage AND f.channel = s.channel AND f.ext = s.ext)"


@register(f"WITH {_MEMBERS} SELECT archive, path, member FROM members")
def jn4_spec_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return release.members(files(spark, sf_dir), release.archive_specs(spark)).select("archive", "path", "member")


@register(f"WITH {_COUNTS}, one AS (SELECT stage, channel, folder, stem, ext, min(length) AS length FROM files GROUP BY ALL HAVING count(*) = 1), m AS (SELECT archive, CASE WHEN many THEN f.stage || '/' ELSE '' END || folder || '/' || stem || '.' || f.ext AS member, length FROM one f JOIN specs s ON f.stage = s.stage AND f.channel = s.channel AND f.ext = s.ext) SELECT archive, member, length AS bytes, row_number() OVER (PARTITION BY archive ORDER BY member) - 1 AS ordinal FROM m")
def sk3_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = files(spark, sf_dir)
    once = found.groupBy("path").agg(F.count("*").alias("n")).where("n = 1").select("path")
    return release.manifest(found.join(once, "path"), release.archive_specs(spark))


@register(f"WITH {_REPORT} SELECT 'fill' AS stage, status, count(*) AS n_clips FROM report GROUP BY status")
def sk5_run_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return release.run_report(_fill_report(spark, sf_dir), "fill")


# --- sources, sinks and incremental runs over tables that Spark writes --------------------------


def _place(spark: SparkSession, name: str) -> str:
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _placed(df: DataFrame) -> DataFrame:
    """Series with the channel and actor folder that they lie in."""
    return df.withColumns({"channel": F.when(F.col("user_id") % 2 == 0, "speech").otherwise("song"), "actor": (F.col("user_id") % 24 + 1).cast("int")})


@register(f"WITH {_REPORT} SELECT f.user_id, f.event_id, full_value AS holed, CASE WHEN f.user_id % 2 = 0 THEN 'speech' ELSE 'song' END AS channel, CAST(f.user_id % 24 + 1 AS INTEGER) AS actor FROM filled f JOIN report r ON f.user_id = r.user_id WHERE r.status <> 'failed'")
def sk1_filled_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filled series written anew by channel and actor, clips that still miss values left out."""
    filled = series.forward_fill(events_series(spark, sf_dir), CLIP, ORDER, ["holed"])
    folder = _place(spark, "filled")
    tracking.write_clips(_placed(series.complete_clips(filled, CLIP, ["holed"])).select("user_id", "event_id", "holed", "channel", "actor"), folder)
    return spark.read.parquet(folder)


@register(ORACLE_SQL["wn4_savgol"])
def sk2_smoothed_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _place(spark, "smoothed")
    tracking.write_clips(_placed(_smoothed(spark, sf_dir)), folder)
    return spark.read.parquet(folder).select("user_id", "row_idx", rounded("value"))


def _clip_csv(spark: SparkSession, rows: DataFrame) -> tuple[str, DataFrame]:
    """One CSV folder a clip, with one file in it, and the list of the files."""
    folder = _place(spark, "clips")
    return folder, tracking.write_clip_csv(_placed(rows).withColumn("stem", F.col("user_id")), folder, ["row_idx"])


@register(ORACLE_SQL["wn4_savgol"])
def sk2_smoothed_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The export without an index column, read back clip by clip."""
    _, written = _clip_csv(spark, _smoothed(spark, sf_dir))
    return clip_files.read_csv(written, "user_id long, row_idx long, value double").select("user_id", "row_idx", rounded("value"))


@register(f"""WITH {_WHOLE}, {savgol_sql('own', 'fit')}, every AS (SELECT '01_raw_motion' AS stage, clip, row_idx, x FROM own UNION ALL SELECT '02_smoothed_motion', clip, row_idx, x FROM fit)
    SELECT stage, 'zstd' AS codec, CASE WHEN clip % 2 = 0 THEN 'speech' ELSE 'song' END AS channel, clip AS user_id, row_idx, round(x, 6) + 0.0 AS value FROM every""")
def sk4_release_datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both motion datasets, every row read back, with the codec that their files have."""
    folder = _place(spark, "release")
    raw = numbered(spark, sf_dir).select("user_id", "row_idx", "value")
    release.write_datasets({"01_raw_motion": _placed(raw), "02_smoothed_motion": _placed(_smoothed(spark, sf_dir))}, release.archive_specs(spark), folder)
    out = None
    for stage in ("01_raw_motion", "02_smoothed_motion"):
        part = spark.read.parquet(f"{folder}/{stage}").select(F.lit(stage).alias("stage"), F.regexp_extract("_metadata.file_name", r"\.(\w+)\.parquet$", 1).alias("codec"), "channel", "user_id", "row_idx", rounded("value"))
        out = part if out is None else out.unionAll(part)
    return out


def _written_csv(spark: SparkSession, sf_dir: str) -> str:
    """The events as CSV files of two header widths: half have an index column, half two and another order."""
    folder = _place(spark, "csv")
    rows = _placed(numbered(spark, sf_dir)).select("user_id", "channel", "actor", "row_idx", "event_id", F.when(F.col("holed").isNull(), "NA").otherwise(F.col("value").cast("string")).alias("x_0"), F.col("event_type").alias("kind"))
    one = rows.where("actor % 2 = 0").select("channel", "actor", F.col("row_idx").alias("Unnamed: 0"), "event_id", "x_0", "kind")
    two = rows.where("actor % 2 = 1").select("channel", "actor", F.col("event_id").alias("Unnamed: 0"), F.col("row_idx").alias("Unnamed: 0.1"), "kind", "x_0", "event_id")
    for part in (one, two):
        part.write.mode("append").option("header", True).partitionBy("channel", "actor").csv(folder)
    return folder


@register(f"WITH {_SERIES} SELECT event_id, holed AS x_0, event_type AS kind FROM series")
def sc4_tracking_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tracking.read_tracking(spark, _written_csv(spark, sf_dir), ["x_0"]).select(F.col("event_id").cast("long").alias("event_id"), "x_0", "kind")


@register(f"WITH {_SERIES} SELECT event_id, holed AS x_0, event_type AS kind FROM series WHERE user_id % 24 = 0")
def sc5_one_clip(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = f"{_written_csv(spark, sf_dir)}/channel=speech/actor=1"
    return tracking.read_clip(spark, place, ["x_0"]).select(F.col("event_id").cast("long").alias("event_id"), "x_0", "kind")


@register("SELECT CASE WHEN user_id % 2 = 0 THEN 'speech' ELSE 'song' END AS channel, CAST(user_id % 24 + 1 AS INTEGER) AS actor, user_id AS stem, 1 AS n_files, true AS has_bytes FROM events GROUP BY user_id")
def sc6_artefact_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every clip's file of an export, found by a recursive listing."""
    listed = catalog.list_files(spark, _clip_csv(spark, numbered(spark, sf_dir).select("user_id", "row_idx", "value"))[0], "*.csv")
    named = lambda key: F.regexp_extract("path", f"{key}=([^/]*)", 1)
    found = listed.select(named("channel").alias("channel"), named("actor").cast("int").alias("actor"), named("stem").cast("long").alias("stem"), "length")
    return found.groupBy("channel", "actor", "stem").agg(F.count("*").cast("int").alias("n_files"), (F.sum("length") > 0).alias("has_bytes"))


_PASSED = [f"p_{i}" for i in range(30)]


def _partial_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headers of a file for each channel and actor: half lack ``y_0``; thirty columns pass through."""
    folder = _place(spark, "partial")
    rows = _placed(numbered(spark, sf_dir)).select("channel", "actor", F.col("value").alias("x_0"), F.col("value").alias("y_0"), F.col("row_idx").alias("Pitch"), *[(F.col("event_id") + i).alias(n) for i, n in enumerate(_PASSED)])
    for part in (rows.where("actor % 2 = 0"), rows.where("actor % 2 = 1").drop("y_0")):
        part.repartition("channel", "actor").write.mode("append").option("header", True).partitionBy("channel", "actor").csv(folder)
    heads = tracking.file_headers(spark, folder)
    return heads.withColumns({"channel": F.regexp_extract("path", "channel=([^/]*)", 1), "actor": F.regexp_extract("path", "actor=([^/]*)", 1).cast("int")})


_FOLDERS = "SELECT DISTINCT CASE WHEN user_id % 2 = 0 THEN 'speech' ELSE 'song' END AS channel, CAST(user_id % 24 + 1 AS INTEGER) AS actor FROM events"


@register(f"SELECT channel, actor, CASE WHEN actor % 2 = 0 THEN 'Roll' ELSE 'y_0,Roll' END AS missing FROM ({_FOLDERS})")
def un2_missing_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    heads = _partial_csv(spark, sf_dir)
    found = tracking.channel_report(heads, ["x_0", "y_0", "Pitch", "Roll"])
    return found.join(heads, "path").select("channel", "actor", F.array_join("missing", ",").alias("missing"))


@register(f"SELECT channel, actor, CASE WHEN actor % 2 = 0 THEN 'ok' ELSE 'missing_channels' END AS status FROM ({_FOLDERS})")
def qg2_required_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    heads = _partial_csv(spark, sf_dir)
    return tracking.channel_report(heads, ["x_0", "y_0", "Pitch"]).join(heads, "path").select("channel", "actor", "status")


@register(f"SELECT channel, actor, 'no column AU01; the table has ' || CASE WHEN actor % 2 = 0 THEN 'x_0, y_0, Pitch, {', '.join(_PASSED[:22])}' ELSE 'x_0, Pitch, {', '.join(_PASSED[:23])}' END AS message FROM ({_FOLDERS})")
def qg5_column_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    heads = _partial_csv(spark, sf_dir)
    return tracking.column_report(heads, "AU01").join(heads, "path").select("channel", "actor", "message")


@register(f"""WITH RECURSIVE {_WHOLE}, {low_pass_sql('own', 'low')}, {savgol_sql('low', 'fit')} SELECT clip AS user_id, row_idx, round(x, 6) + 0.0 AS value FROM fit""")
def in1_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Series that arrive in two loads are cleaned once each; a third run finds nothing new."""
    rows = numbered(spark, sf_dir).select("user_id", "row_idx", "value")
    folder, target, state = (_place(spark, x) for x in ("arrived", "cleaned", "state"))
    step = lambda df: series.clean_signals(df, CLIP, ["row_idx"], ["value"])
    for load in ("user_id % 3 = 0", "user_id % 3 <> 0", None):
        if load:
            rows.where(load).repartition("user_id").write.mode("append").parquet(folder)
        run_new_files(spark, folder, "user_id long, row_idx long, value double", state, target, step)
    return spark.read.parquet(target).select("user_id", "row_idx", rounded("value"))


# More queries, in modules of their own, enter the same table.
from . import long_queries, store_queries  # noqa: E402, F401
