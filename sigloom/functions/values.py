"""Values of series: what is missing, numbers from text, clocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts that mean a missing value in a CSV.
NA_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]
FILTER_RATE, RENDER_RATE = 29.97, 30.0


def missing(df: DataFrame, column: str) -> Column:
    """True for null, and for NaN in floating-point columns."""
    c = F.col(f"`{column}`")
    if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def nan_to_null(df: DataFrame, column: str) -> Column:
    c = F.col(f"`{column}`")
    return F.when(~missing(df, column), c).alias(column)


def numeric(column: Column) -> Column:
    """A number, or null where the text is none or NaN."""
    x = column.try_cast("double")
    return F.when(~F.isnan(x), x)


def na_to_null(column: Column) -> Column:
    return F.when(~F.trim(column).isin(NA_TOKENS), column)


def frame_or_position(df: DataFrame, clip: list[str], order: list[str], frame: str = "frame") -> Column:
    """The frame column as a number if the table has one, else the row's place in its clip."""
    if frame in df.columns:
        return numeric(F.col(f"`{frame}`").cast("string"))
    return (F.row_number().over(Window.partitionBy(*clip).orderBy(*order)) - 1).cast("double")


def seconds(frame: Column, rate: float) -> Column:
    return frame / F.lit(rate)
