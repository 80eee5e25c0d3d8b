"""Raw against smoothed series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.values import frame_or_position, numeric


def long_series(df: DataFrame, clip: list[str], order: list[str], column: str, label: str) -> DataFrame:
    """``clip, frame, value, series`` of one channel, without points that miss a frame or a value."""
    value = numeric(F.col(f"`{column}`").cast("string"))
    out = df.select(*clip, frame_or_position(df, clip, order).alias("frame"), value.alias("value"), F.lit(label).alias("series"))
    return out.dropna(subset=["frame", "value"])


def stacked(raw: DataFrame, smoothed: DataFrame) -> DataFrame:
    """Both series as rows; repeated rows stay."""
    return raw.unionByName(smoothed)


def paired(raw: DataFrame, smoothed: DataFrame, key: list[str], column: str) -> DataFrame:
    """Raw and smoothed value of each point side by side."""
    return raw.select(*key, F.col(column).alias("raw")).join(smoothed.select(*key, F.col(column).alias("smoothed")), key)


def change(raw: Column, smoothed: Column) -> Column:
    return smoothed - raw
