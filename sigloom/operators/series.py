"""Series operators: row position, forward fill, filters, and their gates.

A series is a clip (``clip`` columns) in the order of ``order`` columns. Fill, position and the
filters all need rows by clip in order, so one exchange serves them together.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import filters
from ..functions.values import FILTER_RATE, missing, nan_to_null
from ..session import ship

CUTOFF, LOW_PASS_ORDER, WINDOW, POLY_ORDER = 6.0, 5, 11, 5

Matrix = Callable[[np.ndarray], np.ndarray]


def with_position(df: DataFrame, clip: list[str], order: list[str], name: str = "row_idx") -> DataFrame:
    """0-based place of a row in its clip."""
    return df.withColumn(name, (F.row_number().over(Window.partitionBy(*clip).orderBy(*order)) - 1).cast("long"))


def place_in_groups(df: DataFrame, group: list[str], part: Column, order: list[str], name: str = "place") -> DataFrame:
    """0-based place of a row in its group, however large that is: no task sorts more than a part.

    ``part`` must not fall as ``order`` rises. Rows are numbered within their part and moved by
    what stands in earlier parts of the group.
    """
    rows = df.withColumn("__part", part)
    counts = rows.groupBy(*group, "__part").agg(F.count("*").alias("__n"))
    before = counts.select(*group, "__part", (F.sum("__n").over(Window.partitionBy(*group).orderBy("__part")) - F.col("__n")).alias("__before"))
    own = F.row_number().over(Window.partitionBy(*group, "__part").orderBy(*order)) - 1
    out = rows.withColumn("__own", own).join(before, [*group, "__part"])
    return out.withColumn(name, (F.col("__before") + F.col("__own")).cast("long")).drop("__part", "__own", "__before")


def forward_fill(df: DataFrame, clip: list[str], order: list[str], columns: list[str]) -> DataFrame:
    """Missing values (null, NaN) become the last one before them; leading ones stay null."""
    so_far = Window.partitionBy(*clip).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns({c: F.last(nan_to_null(df, c), ignorenulls=True).over(so_far) for c in columns})


def null_counts(df: DataFrame, clip: list[str], columns: list[str]) -> DataFrame:
    """By clip: rows, missing values by column, and all of them."""
    each = [F.count_if(missing(df, c)).alias(f"nulls_{c}") for c in columns]
    found = df.groupBy(*clip).agg(F.count("*").alias("n_rows"), *each)
    return found.withColumn("nulls", sum((F.col(f"`nulls_{c}`") for c in columns), F.lit(0).cast("long")))


def fill_status(before: Column, after: Column) -> Column:
    """``clean`` without a missing value, ``filled`` if none is left, else ``failed``."""
    return F.when(before == 0, "clean").when(after == 0, "filled").otherwise("failed")


def fill_report(raw: DataFrame, clip: list[str], order: list[str], columns: list[str]) -> DataFrame:
    """One row per clip: missing values before and after the fill, and its status.

    All clips are judged in one pass over the window's output: a value is missing after the fill
    only where nothing stands before it.
    """
    kept = raw.select(*clip, *order, *[missing(raw, c).alias(f"was_{c}") for c in columns], *[nan_to_null(raw, c) for c in columns])
    filled = forward_fill(kept, clip, order, columns)
    count = lambda f: sum((F.count_if(f(c)) for c in columns), F.lit(0).cast("long"))
    out = filled.groupBy(*clip).agg(F.count("*").alias("n_rows"), count(lambda c: F.col(f"`was_{c}`")).alias("nulls_before"), count(lambda c: F.col(f"`{c}`").isNull()).alias("nulls_after"))
    return out.withColumn("status", fill_status(F.col("nulls_before"), F.col("nulls_after")))


def complete_clips(filled: DataFrame, clip: list[str], columns: list[str], strict: bool = False) -> DataFrame:
    """The rows of clips without a missing value; with ``strict``, an error if any clip has one.

    The test is a window over the clip, in the partitioning that the fill already has.
    """
    bad = F.count_if(sum((missing(filled, c).cast("int") for c in columns), F.lit(0)) > 0).over(Window.partitionBy(*clip))
    marked = filled.withColumn("__bad", bad)
    if strict:
        failed = marked.where("__bad > 0").select(*clip).distinct().limit(20).collect()
        if failed:
            raise ValueError(f"clips still hold missing values: {[tuple(r) for r in failed]}")
    return marked.where("__bad = 0").drop("__bad")


def signal_status(n: Column, nulls: Column, order: int = LOW_PASS_ORDER) -> Column:
    """What forbids the low-pass: ``too_short``, ``has_null``, or nothing (``ready``)."""
    return F.when(n <= 3 * (order + 1), "too_short").when(nulls > 0, "has_null").otherwise("ready")


def low_pass(cutoff: float = CUTOFF, rate: float = FILTER_RATE, order: int = LOW_PASS_ORDER) -> Matrix:
    """The zero-phase low-pass of a frames x channels matrix."""

    def apply(x: np.ndarray) -> np.ndarray:
        return filters.zero_phase(x, order, cutoff, rate)

    return apply


def savgol(window: int = WINDOW, order: int = POLY_ORDER) -> Matrix:
    """The Savitzky-Golay smoothing of a frames x channels matrix, which stays as it is up to ``window`` rows."""

    def apply(x: np.ndarray) -> np.ndarray:
        return filters.smooth(x, window, order)

    return apply


def chain(*steps: Matrix) -> Matrix:
    def apply(x: np.ndarray) -> np.ndarray:
        for step in steps:
            x = step(x)
        return x

    return apply


def map_channels(df: DataFrame, clip: list[str], order: list[str], channels: list[str], fn: Matrix) -> DataFrame:
    """``fn`` on the frames x channels matrix of every clip; other columns pass untouched.

    Clips are brought together by one exchange and stream through each task in order, so that a
    task holds one clip and one Arrow batch, and pays no set-up for each clip.
    """
    ship(df.sparkSession)
    schema = [f"`{f.name}` {'double' if f.name in channels else f.dataType.simpleString()}" for f in df.schema.fields]
    cast = df.withColumns({c: F.col(f"`{c}`").cast("double") for c in channels})
    sorted_rows = cast.repartition(*[F.col(f"`{c}`") for c in clip]).sortWithinPartitions(*clip, *order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            cuts = _clip_starts(batch, clip)
            if held and not _same_clip(held[-1], batch, clip):
                yield from _filtered(held, clip, channels, fn)
                held = []
            # Whole clips go out together; the last one may go on in the next batch.
            last = int(cuts[-1])
            if last:
                held.append(batch.slice(0, last))
                yield from _filtered(held, clip, channels, fn)
                held = []
            held.append(batch.slice(last))
        if held:
            yield from _filtered(held, clip, channels, fn)

    return sorted_rows.mapInArrow(run, ", ".join(schema))


def _clip_starts(batch: pa.RecordBatch, clip: list[str]) -> np.ndarray:
    new = np.zeros(batch.num_rows, bool)
    new[0] = True
    for c in clip:
        code = batch.column(c).dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
        new[1:] |= code[1:] != code[:-1]
    return np.flatnonzero(new)


def _same_clip(a: pa.RecordBatch, b: pa.RecordBatch, clip: list[str]) -> bool:
    return all(a.column(c)[a.num_rows - 1].as_py() == b.column(c)[0].as_py() for c in clip)


def _filtered(parts: list[pa.RecordBatch], clip: list[str], channels: list[str], fn: Matrix) -> Iterator[pa.RecordBatch]:
    table = pa.Table.from_batches(parts).combine_chunks()
    for batch in table.to_batches():
        starts = np.append(_clip_starts(batch, clip), batch.num_rows)
        x = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in channels])
        y = np.concatenate([fn(x[a:b]) for a, b in zip(starts[:-1], starts[1:])])
        columns = [pa.array(y[:, channels.index(f.name)], pa.float64()) if f.name in channels else batch.column(i) for i, f in enumerate(batch.schema)]
        yield pa.RecordBatch.from_arrays(columns, batch.schema.names)


def clean_signals(df: DataFrame, clip: list[str], order: list[str], channels: list[str], strict: bool = False) -> DataFrame:
    """Low-pass, then smoothing, in one pass over each clip that is complete and long enough.

    Other clips are left out, or are an error with ``strict``; :func:`signal_report` names them.
    """
    require_channels(df, channels)
    per = Window.partitionBy(*clip)
    holes = F.count_if(sum((missing(df, c).cast("int") for c in channels), F.lit(0)) > 0).over(per)
    marked = df.withColumn("__status", signal_status(F.count("*").over(per), holes))
    if strict:
        bad = marked.where("__status <> 'ready'").select(*clip, "__status").distinct().limit(20).collect()
        if bad:
            raise ValueError(f"clips that cannot be filtered: {[tuple(r) for r in bad]}")
    ready = marked.where("__status = 'ready'").drop("__status")
    return map_channels(ready, clip, order, channels, chain(low_pass(), savgol()))


def signal_report(df: DataFrame, clip: list[str], channels: list[str]) -> DataFrame:
    """One row per clip: rows, missing values, and whether it can be filtered."""
    found = null_counts(df, clip, channels)
    return found.select(*clip, "n_rows", "nulls", signal_status(F.col("n_rows"), F.col("nulls")).alias("status"))


def isolated(report: DataFrame, written: DataFrame, clip: list[str]) -> DataFrame:
    """The run's outcome by clip: ``written``, or the status that kept it out."""
    done = written.select(*clip).distinct().withColumn("__done", F.lit(True))
    out = report.join(done, clip, "left")
    return out.withColumn("outcome", F.when(F.col("__done"), "written").otherwise(F.col("status"))).drop("__done")


def missing_channels(df: DataFrame, required: list[str]) -> list[str]:
    """Required channels that the table lacks, in required order."""
    return [c for c in required if c not in df.columns]


def require_channels(df: DataFrame, required: list[str]) -> None:
    if lacking := missing_channels(df, required):
        raise ValueError(f"missing channels: {lacking}")


def require_column(df: DataFrame, column: str) -> None:
    if column not in df.columns:
        raise ValueError(f"no column {column!r}; the table has {df.columns[:25]}")


def savgol_native(df: DataFrame, clip: list[str], order: list[str], column: str, out: str, window: int = WINDOW, poly: int = POLY_ORDER) -> DataFrame:
    """The smoothing of one channel by window expressions alone, for tables of few channels.

    Interior rows are weighted sums of their neighbours; end rows are weighted sums of the
    outermost window, which a window function collects once per clip.
    """
    half, fit = window // 2, filters.polynomial_fit(window, poly)
    w = Window.partitionBy(*clip).orderBy(*order)
    rows = df.withColumns({"__i": F.row_number().over(w) - 1, "__n": F.count("*").over(Window.partitionBy(*clip))})
    near = F.collect_list(F.struct(F.coalesce(F.col(column), F.lit(float("nan"))).alias("v"))).over(w.rowsBetween(-window + 1, window - 1))
    rows = rows.withColumn("__near", F.transform(near, lambda x: x["v"]))
    # In ``__near`` this row stands at min(i, window - 1).
    at = F.least(F.col("__i"), F.lit(window - 1))
    first = F.when(F.col("__i") < half, at - F.col("__i")).when(F.col("__i") >= F.col("__n") - half, F.size("__near") - window).otherwise(at - half)
    place = F.when(F.col("__i") < half, F.col("__i")).when(F.col("__i") >= F.col("__n") - half, F.lit(window) - (F.col("__n") - F.col("__i"))).otherwise(F.lit(half))
    weights = F.element_at(F.array(*[F.array(*[F.lit(float(x)) for x in row]) for row in fit]), (place + 1).cast("int"))
    part = F.slice("__near", (first + 1).cast("int"), window)
    value = F.aggregate(F.zip_with(part, weights, lambda x, y: x * y), F.lit(0.0), lambda a, x: a + x)
    return rows.withColumn(out, F.when(F.col("__n") <= window, F.col(column)).otherwise(value)).drop("__i", "__n", "__near")
