"""Series stored by clip buckets, so that stages of a clip meet without an exchange."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_bucketed(df: DataFrame, table: str, folder: str, clip: list[str], order: list[str], buckets: int) -> None:
    """Stores ``df`` at ``folder`` as ``table``, bucketed by clip and sorted by clip and order within a bucket.

    Rows are dealt out as the buckets are, so that each is one file, which keeps its order on disk.
    All stages to be paired take the same ``clip`` and ``buckets``. A clip is in one bucket whatever its length: for clips
    longer than a task should hold, put a block number (``row div size``) among the ``clip`` columns.
    """
    keys = [F.col(f"`{c}`") for c in clip]
    df.repartition(buckets, *keys).sortWithinPartitions(*clip, *order).write.mode("overwrite").option("path", folder).bucketBy(buckets, *clip).sortBy(*clip, *order).saveAsTable(table, format="parquet")


def paired_buckets(spark: SparkSession, raw: str, smoothed: str, clip: list[str], order: list[str], column: str) -> DataFrame:
    """Raw and smoothed value of each point side by side, from two tables of :func:`write_bucketed`: no exchange.

    The join keys are clip and order, the buckets are by clip alone; the session is told that such
    a partitioning will do. A merge join is asked for, as its input is sorted by file.
    """
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    key = [*clip, *order]
    left = spark.table(raw).select(*key, F.col(f"`{column}`").alias("raw"))
    right = spark.table(smoothed).select(*key, F.col(f"`{column}`").alias("smoothed"))
    return left.hint("merge").join(right, key)


def drop_bucketed(spark: SparkSession, *tables: str) -> None:
    """Forgets the tables; their files stay where they were put."""
    for table in tables:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
