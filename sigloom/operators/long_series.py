"""Series operators for clips of any length: no task holds or sorts a whole clip.

Position and fill are a segmented prefix scan: rows are dealt out by ranges of clip and order, each
task scans its own range, and what a clip had before a range is carried into it from at most two
rows a task. Filters run on blocks of a clip with a halo of neighbouring rows on both sides.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, LongType, StructField, StructType

from ..functions import filters
from ..functions.values import FILTER_RATE, missing
from ..session import settled, ship
from .series import CUTOFF, LOW_PASS_ORDER, WINDOW, Matrix, _clip_starts, _same_clip, chain, fill_status, low_pass, map_channels, savgol, signal_status

_PART, _OWN, _HEAD, _EDGE = "__part", "__own", "__head", "__edge"


def _scan(batches: Iterator[pa.RecordBatch], clip: list[str], columns: list[str]) -> Iterator[pa.RecordBatch]:
    """Rows in order with their range's number, their place in the clip's part of it, whether that part
    is the range's first, and whether the row is the last of the first or last part; columns filled within."""
    part = TaskContext.get().partitionId()
    held: list | None = None  # the columns of the last batch, whose edge is still open
    before: pa.RecordBatch | None = None
    place, head, carry = -1, True, {}

    def out(columns: list, edge: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*columns, pa.array(edge)], names)

    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        names = [*batch.schema.names, _PART, _OWN, _HEAD, _EDGE]
        starts, at = _clip_starts(batch, clip), np.arange(n)
        goes_on = before is not None and _same_clip(before, batch, clip)
        # ``first``: rows that go on with the clip of the batch before.
        first = int(starts[1]) if len(starts) > 1 else n
        first = first if goes_on else 0
        begin = np.zeros(n, np.int64)
        begin[starts] = starts
        begin = np.maximum.accumulate(begin)
        own = at - begin
        own[:first] += place + 1
        heads, edge = np.zeros(n, bool), np.zeros(n, bool)
        if head:
            ends = starts[1:] if goes_on or before is None else starts
            stop = int(ends[0]) if len(ends) else n
            heads[:stop] = True
            if stop < n and stop:
                edge[stop - 1] = True
            if stop == 0:
                held_edge[-1] = True
            head = stop == n
        arrays = list(batch.columns)
        for c in columns:
            k = batch.schema.get_field_index(c)
            x = arrays[k]
            if pa.types.is_floating(x.type):
                x = pc.if_else(pc.is_nan(x), pa.scalar(None, x.type), x)
            last = np.maximum.accumulate(np.where(x.is_valid().to_numpy(zero_copy_only=False), at, -1))
            there = last >= begin
            source = np.where(there, last + 1, 0)
            empty = ~there & (at >= first)
            x = pa.concat_arrays([carry.get(c, pa.nulls(1, x.type)), x]).take(pa.array(source, mask=empty))
            arrays[k], carry[c] = x, x.slice(n - 1)
        if held is not None:
            yield out(held, held_edge)
        held, held_edge = [*arrays, pa.array(np.full(n, part, np.int32)), pa.array(own), pa.array(heads)], edge
        before, place = batch, int(own[-1])
    if held is not None:
        held_edge[-1] = True
        yield out(held, held_edge)


def scanned(df: DataFrame, clip: list[str], order: list[str], columns: list[str] = (), position: str | None = None, parts: int | None = None) -> DataFrame:
    """``df`` with missing values (null, NaN) of ``columns`` filled forward, and the 0-based ``position``
    in its clip if a name is given: as ``forward_fill`` and ``with_position`` give them, for clips of any length.

    One exchange by ranges of ``(clip, order)`` into ``parts`` (Spark's shuffle partitions unless
    given); each task scans its range in one pass, and its rows are written, so that the
    ranges stand. What is carried has two rows a range at most, whatever the clips' number and
    lengths, and meets the rows by the range's number without a second exchange of them. Rows that tie in ``order`` have no defined sequence.
    """
    spark = ship(df.sparkSession)
    columns = list(columns)
    if own := [c for c in (_PART, _OWN, _HEAD, _EDGE) if c in df.columns]:
        raise ValueError(f"columns {own} are names of the scan")
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(f"`{c}`") for c in [*clip, *order]]
    schema = StructType([*[StructField(f.name, f.dataType) for f in df.schema.fields], StructField(_PART, IntegerType()), StructField(_OWN, LongType()), StructField(_HEAD, BooleanType()), StructField(_EDGE, BooleanType())])
    ranges = df.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    rows = settled(ranges.mapInArrow(lambda batches: _scan(batches, clip, columns), schema), "ranges")
    earlier = Window.partitionBy(*[F.col(f"`{c}`") for c in clip]).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    carried = {f"__c{k}": F.last(F.col(f"`{c}`"), ignorenulls=True).over(earlier) for k, c in enumerate(columns)}
    carry = rows.where(F.col(_EDGE)).withColumns({"__before": F.sum(F.col(_OWN) + 1).over(earlier), **carried})
    carry = settled(carry.where(F.col(_HEAD) & F.col("__before").isNotNull()).select(_PART, "__before", *carried), "carry")
    joined = rows.join(carry, _PART, "left")
    filled = {c: F.coalesce(F.col(f"`{c}`"), F.when(F.col(_HEAD), F.col(f"__c{k}"))) for k, c in enumerate(columns)}
    out = [filled[c].alias(c) if c in filled else F.col(f"`{c}`") for c in df.columns]
    if position:
        out = [x for x, c in zip(out, df.columns) if c != position]
        out.append((F.col(_OWN) + F.when(F.col(_HEAD), F.coalesce("__before", F.lit(0))).otherwise(0)).alias(position))
    return joined.select(*out)


def long_fill_report(raw: DataFrame, clip: list[str], order: list[str], columns: list[str]) -> DataFrame:
    """As ``fill_report`` gives it, without a window: missing values before and after the fill, and the clip's status.

    The fill leaves what stands before a column's first value. That place is a minimum by clip; a
    second pass counts the rows before it. Tasks combine both before their exchange, and the
    firsts, a row a clip, meet the rows by a join that Spark can split where a clip is long.
    """
    at = F.struct(*[F.col(f"`{c}`") for c in order])
    firsts = raw.groupBy(*clip).agg(*[F.min(F.when(~missing(raw, c), at)).alias(f"__f{k}") for k, c in enumerate(columns)])
    firsts = firsts.withColumnsRenamed({c: f"__k{i}" for i, c in enumerate(clip)})
    same = [F.col(f"`{c}`").eqNullSafe(F.col(f"__k{i}")) for i, c in enumerate(clip)]
    rows = raw.join(firsts, same)
    count = lambda tests: sum((F.count_if(x) for x in tests), F.lit(0).cast("long"))
    left = [F.col(f"__f{k}").isNull() | (at < F.col(f"__f{k}")) for k in range(len(columns))]
    out = rows.groupBy(*clip).agg(F.count("*").alias("n_rows"), count(missing(raw, c) for c in columns).alias("nulls_before"), count(left).alias("nulls_after"))
    return out.withColumn("status", fill_status(F.col("nulls_before"), F.col("nulls_after")))


def low_pass_reach(cutoff: float = CUTOFF, rate: float = FILTER_RATE, order: int = LOW_PASS_ORDER) -> int:
    """After how many rows the filter's inner state has forgotten where it started, to double rounding.

    A block's state map is affine; its matrix shrinks like the largest pole to the power of the
    block's rows. After so many rows it takes any start below 2^-70 of it, so the composition of
    all earlier blocks' maps is that of the last so many rows, and a block that runs over them
    first has its true start state.
    """
    poles = filters.analog_poles(order, cutoff, rate)
    largest = np.abs((4 + poles) / (4 - poles)).max()
    return int(np.ceil(70 * np.log(2) / -np.log(largest)))


def map_long_channels(df: DataFrame, clip: list[str], position: str, channels: list[str], fn: Matrix, reach: int, block: int = 1 << 16) -> DataFrame:
    """``fn`` on the frames x channels matrix of every clip, block by block; other columns pass untouched.

    ``fn`` must give a row the same value whatever stands more than ``reach`` rows away, except at
    a clip's own ends; ``position`` counts a clip's rows from 0. Each block of ``block`` rows gets
    copies of ``reach`` rows of its neighbours, and one exchange by clip and block brings it together: rows are
    copied in the share ``2 * reach / block``, and a task holds one block. Blocks lengthen with ``reach``.
    """
    block = max(block, 4 * reach)
    at = F.col(f"`{position}`")
    own = F.floor(at / block)
    inside = at - own * block
    near = F.array_compact(F.array(own, F.when((inside < reach) & (own > 0), own - 1), F.when(inside >= block - reach, own + 1)))
    copies = df.withColumn("__block", F.explode(near)).withColumn("__core", (F.floor(at / block) == F.col("__block")).cast("double"))

    def run(x: np.ndarray) -> np.ndarray:
        # Copies alone, behind a clip's end, are no block.
        return np.column_stack([fn(x[:, :-1]), x[:, -1]]) if x[:, -1].any() else x

    out = map_channels(copies, [*clip, "__block"], [position], [*channels, "__core"], run)
    return out.where(F.col("__core") == 1).drop("__block", "__core")


def long_low_pass(df: DataFrame, clip: list[str], position: str, channels: list[str], block: int = 1 << 16) -> DataFrame:
    """The zero-phase low-pass for clips of any length."""
    return map_long_channels(df, clip, position, channels, low_pass(), low_pass_reach(), block)


def long_savgol(df: DataFrame, clip: list[str], position: str, channels: list[str], block: int = 1 << 16) -> DataFrame:
    """Savitzky-Golay for clips of any length. The halo is a whole window, so that a last block of one row is still smoothed."""
    return map_long_channels(df, clip, position, channels, savgol(), WINDOW, block)


def long_clean_signals(df: DataFrame, clip: list[str], position: str, channels: list[str], block: int = 1 << 16) -> DataFrame:
    """Low-pass, then smoothing, for clips of any length that are complete and long enough; others are left out.

    Clips are judged by counts that tasks combine before the shuffle, and those kept out are few
    rows that the others are checked against, instead of a window over each clip.
    """
    holes = F.count_if(sum((missing(df, c).cast("int") for c in channels), F.lit(0)) > 0)
    status = df.groupBy(*clip).agg(signal_status(F.count("*"), holes).alias("__status"))
    ready = status.where("__status = 'ready'").select(*[F.col(f"`{c}`").alias(f"__k{i}") for i, c in enumerate(clip)])
    same = [F.col(f"`{c}`").eqNullSafe(F.col(f"__k{i}")) for i, c in enumerate(clip)]
    kept = df.join(ready, same, "left_semi")
    return map_long_channels(kept, clip, position, channels, chain(low_pass(), savgol()), low_pass_reach() + WINDOW, block)
