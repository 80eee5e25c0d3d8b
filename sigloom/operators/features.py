"""Feature and geometry tables of single frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def project_channels(df: DataFrame, channels: list[str]) -> DataFrame:
    """The channels as doubles, every other column as it is."""
    return df.withColumns({c: F.col(f"`{c}`").cast("double") for c in channels})


def au_vector(columns: list[str]) -> Column:
    return F.array(*[F.col(f"`{c}`").cast("double") for c in columns])


def usable(vector: Column) -> Column:
    """No element null, NaN or infinite, and at least one."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~bad & (F.size(vector) > 0), F.lit(False))


def omitted_frames(df: DataFrame, clip: list[str], frame: str, vector: Column) -> DataFrame:
    """By clip: frames, how many are unusable, and which, in order."""
    bad = ~usable(vector)
    return df.groupBy(*clip).agg(F.count("*").alias("n_frames"), F.count_if(bad).alias("n_omitted"), F.array_sort(F.collect_list(F.when(bad, F.col(frame)))).alias("omitted"))


def geometry(xs: list[str], ys: list[str], box: list[str], pose: list[str]) -> Column:
    """Landmark points, face box and head pose of a frame as one struct."""
    points = F.arrays_zip(F.array(*xs).alias("x"), F.array(*ys).alias("y"))
    return F.struct(
        F.transform(points, lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y"))).alias("points"),
        F.struct(*[F.col(b).alias(n) for b, n in zip(box, ("x", "y", "width", "height"))]).alias("box"),
        F.struct(*[F.col(p).alias(n) for p, n in zip(pose, ("pitch", "roll", "yaw"))]).alias("pose"),
    )


def scaled(geometry: Column, source: tuple[float, float], target: tuple[float, float] = (1280.0, 720.0)) -> Column:
    """The geometry on a canvas of another size; angles stay."""
    sx, sy = target[0] / source[0], target[1] / source[1]
    box = geometry["box"]
    return F.struct(
        F.transform(geometry["points"], lambda p: F.struct((p["x"] * sx).alias("x"), (p["y"] * sy).alias("y"))).alias("points"),
        F.struct((box["x"] * sx).alias("x"), (box["y"] * sy).alias("y"), (box["width"] * sx).alias("width"), (box["height"] * sy).alias("height")).alias("box"),
        geometry["pose"].alias("pose"),
    )


def on_source(frames: DataFrame, clips: DataFrame, key: str = "stem") -> DataFrame:
    """Each frame's geometry with the clip file that it belongs on."""
    return frames.join(clips.select(key, F.col("path").alias("source_path")), key)
