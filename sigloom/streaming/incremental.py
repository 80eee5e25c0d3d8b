"""Incremental runs: only clips that came since the last one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def run_new_files(spark: SparkSession, folder: str, schema: str, checkpoint: str, target: str, step: Callable[[DataFrame], DataFrame], fmt: str = "parquet", partition_by: list[str] | None = None) -> None:
    """Applies ``step`` to the files of ``folder`` that no earlier run saw, and writes the result.

    The checkpoint remembers the files; a clip must arrive whole, in one file. Every micro-batch
    writes a folder of its own under ``target``, named by its number, so that a batch repeated
    after a failure replaces what it wrote before.
    """

    def write(batch: DataFrame, number: int) -> None:
        out = step(batch).write.mode("overwrite")
        (out.partitionBy(*partition_by) if partition_by else out).parquet(f"{target}/batch={number}")

    stream = spark.readStream.schema(schema).format(fmt).load(folder)
    stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
