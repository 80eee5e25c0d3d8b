"""Clips that arrive in parts: keyed state holds a clip until its last part is there."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..session import ship

#: What is known of a clip that is not whole: its parts by number, how many rows, how many parts it says it has.
_STATE = "parts map<int, binary>, n_rows long, expected int"

_NO_DATA = "spark.sql.streaming.noDataMicroBatches.enabled"


def _packed(frame: pd.DataFrame, schema: pa.Schema) -> bytes:
    batch = pa.RecordBatch.from_pandas(frame, schema, preserve_index=False)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, schema) as stream:
        stream.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpacked(raw: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(raw).read_all().to_pandas()


def whole_clips(stream: DataFrame, clip: str, part: str, parts: str, columns: list[str], wait_seconds: int = 86_400) -> DataFrame:
    """``clip, status, n_parts, row`` for clips whose rows come in parts over several loads.

    ``part`` numbers a clip's parts from 0, ``parts`` says how many it has. When the last one is there,
    in whatever order they came, all its rows go out once with status ``whole``, and the
    state is dropped; rows carry their own order in ``columns``. A part that comes again replaces its first copy until then. A clip that gets nothing for ``wait_seconds``
    gives one row without values, status ``timeout`` and the parts that came, and is dropped.
    A clip with a part number beyond its parts, or with two different numbers of parts, gives a row
    with status ``contradiction`` and is dropped. The state holds packed rows of open clips only; Spark keeps it
    in its checkpoint and deals it out by clip.
    """
    spark = ship(stream.sparkSession)
    kept = StructType([stream.schema[c] for c in columns])
    arrow = to_arrow_schema(kept)
    key = stream.schema[clip]
    out = StructType([key, StructField("status", StringType()), StructField("n_parts", LongType()), *kept.fields])
    def said(name, status: str, n: int) -> pd.DataFrame:
        row = {key.name: [name], "status": [status], "n_parts": [n]}
        return pd.DataFrame(row | {c: pd.Series([None], dtype="object") for c in columns})

    def step(name: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            yield said(name[0], "timeout", len(state.get[0]))
            state.remove()
            return
        held, n_rows, expected = state.get if state.exists else ({}, 0, None)
        held, fresh = dict(held), {}
        for frame in frames:
            for number, own in frame.groupby(part, sort=False):
                fresh.setdefault(int(number), []).append(own)
            counts = set(frame[parts].astype(int)) | ({expected} if expected is not None else set())
            expected = counts.pop() if len(counts) == 1 else -1
            if expected == -1:
                break
        for number, own in fresh.items():
            held[number] = _packed(pd.concat(own)[columns], arrow)
        if expected == -1 or any(not 0 <= k < expected for k in held):
            yield said(name[0], "contradiction", len(held))
            if state.exists:
                state.remove()
            return
        if len(held) < expected:
            state.update((held, n_rows + sum(len(x) for own in fresh.values() for x in own), expected))
            state.setTimeoutDuration(1000 * wait_seconds)
            return
        for number in range(expected):
            rows = _unpacked(held[number])
            rows.insert(0, "n_parts", expected)
            rows.insert(0, "status", "whole")
            rows.insert(0, key.name, name[0])
            yield rows
        if state.exists:
            state.remove()

    return stream.groupBy(clip).applyInPandasWithState(step, out, StructType.fromDDL(_STATE), "append", GroupStateTimeout.ProcessingTimeTimeout)


def run_clip_parts(spark: SparkSession, folder: str, schema: str, checkpoint: str, target: str, step: Callable[[DataFrame], DataFrame], clip: str, part: str, parts: str, columns: list[str], wait_seconds: int = 86_400, fmt: str = "parquet") -> None:
    """Takes up the files of ``folder`` that no earlier run saw, and applies ``step`` to the rows of the clips that became whole.

    Results go to ``target/rows``, clips that did not become whole to ``target/failed``. Clips whose
    time is up are found by the next run that has any new file. Every micro-batch
    writes a folder of its own, so that a batch repeated after a failure replaces what it wrote.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        step(batch.where("status = 'whole'").drop("status", "n_parts")).write.mode("overwrite").parquet(f"{target}/rows/batch={number}")
        batch.where("status <> 'whole'").select(clip, "status", "n_parts").write.mode("overwrite").parquet(f"{target}/failed/batch={number}")
        batch.unpersist()

    stream = spark.readStream.schema(schema).format(fmt).load(folder)
    whole = whole_clips(stream, clip, part, parts, columns, wait_seconds)
    before = spark.conf.get(_NO_DATA)
    # A clip could time out at any moment, for which a run would go on for ever with batches without data.
    spark.conf.set(_NO_DATA, "false")
    try:
        query = whole.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        spark.conf.set(_NO_DATA, before)
    query.awaitTermination()
