"""How the given tables stand in for clips, stems and frames: one rule, written once for both engines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.series import with_position

CLIP, ORDER = ["user_id"], ["ts", "event_id"]
LINE_CLIP = ["l_suppkey"]
LINE_CHANNELS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LINE_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", *LINE_CHANNELS, "l_returnflag", "l_linestatus"]

_two = lambda x: f"lpad(cast({x} as string), 2, '0')"
_part = lambda by, of: _two(f"1 + cast(floor(k / {by}) as bigint) % {of}")

#: Stems by order key ``k``; some have a wrong number of parts, channel or actor.
STEM = f"""concat_ws('-', {_two("1 + (k + cast(floor(k / 48) as bigint)) % 3")}, case when k % 17 = 0 then '03' else {_part(3, 2)} end, {_part(7, 8)}, {_part(5, 2)}, {_part(11, 2)},
    case when k % 19 = 0 then {_part(2, 24)} else concat({_part(13, 2)}, '-', case when k % 23 = 0 then 'x' when k % 29 = 0 then '+12' else {_part(2, 24)} end) end)"""

#: Where a clip's file lies: by stage, channel folder and actor folder. Two actor numbers are out of range.
STAGE = "case k % 5 when 0 then '01_raw_motion' when 1 then '02_smoothed_motion' when 2 then 'action_unit_activation' when 3 then 'landmark_plot' else 'landmark_overlay' end"
EXT = "case when k % 5 < 2 then 'csv' else 'mp4' end"
CHANNEL = "case when cast(floor(k / 3) as bigint) % 2 = 0 then 'speech' else 'song' end"
FOLDER = f"concat('Actor_', {_part(2, 26)})"

#: DuckDB: the catalog of files that the orders stand for.
FILES_SQL = f"""SELECT *, concat_ws('/', stage, channel, folder, concat(stem, '.', ext)) AS path FROM (
    SELECT k, {STEM} AS stem, {STAGE} AS stage, {EXT} AS ext, {CHANNEL} AS channel, {FOLDER} AS folder, 100 + k % 900 AS length
    FROM (SELECT o_orderkey AS k FROM orders))"""

#: DuckDB: the series that the events stand for, with and without holes.
SERIES_SQL = """SELECT *, CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS holed,
    row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS row_idx FROM events"""

#: The same rows as few long clips.
LONG_CLIP = ["clip"]
LONG_SQL = """SELECT event_id, ts, event_type, value, user_id % 15 AS clip, CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS holed, CASE WHEN event_id % 5 = 0 THEN NULL ELSE event_type END AS kind,
    row_number() OVER (PARTITION BY user_id % 15 ORDER BY ts, event_id) - 1 AS row_idx FROM events"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stems(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k")).select("k", F.expr(STEM).alias("stem"))


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"))
    out = base.select("k", *[F.expr(e).alias(n) for n, e in (("stem", STEM), ("stage", STAGE), ("ext", EXT), ("channel", CHANNEL), ("folder", FOLDER), ("length", "100 + k % 900"))])
    return out.withColumn("path", F.concat_ws("/", "stage", "channel", "folder", F.concat("stem", F.lit("."), "ext")))


def series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by user: a series with a whole and a holed channel and a text column."""
    events = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type", "value")
    return events.withColumn("holed", F.when(F.col("event_id") % 7 != 0, F.col("value")))


def long_series_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events of many users as one clip each, with two holed columns."""
    return series(spark, sf_dir).select("event_id", "ts", "event_type", "value", (F.col("user_id") % 15).alias("clip"), "holed", F.when(F.col("event_id") % 5 != 0, F.col("event_type")).alias("kind"))


def numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_position(series(spark, sf_dir), CLIP, ORDER)


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items by supplier: series of four channels."""
    return table(spark, sf_dir, "lineitem")
