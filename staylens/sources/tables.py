"""Parquet table access for the driver-provided datasets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from staylens.functions.joins import estimated_bytes


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Read ``<sf_dir>/<name>.parquet``; selecting columns here keeps the scan pruned."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


# Input bytes a task (compressed, by Catalyst's estimate) and rows a task, at most: what an under-split source is
# spread for. Rows beside bytes: a few compressed bytes may be a message that takes as long to read as any other.
SPREAD_BYTES = 16 * 1024 * 1024
SPREAD_ROWS = 50_000


def spread(df: DataFrame, key: str | None = None, min_partitions: int | None = None) -> DataFrame:
    """Spread an under-split input before CPU-heavy per-row work (JSON parsing).

    A source delivered as few large files / row groups yields fewer scan tasks
    than cores, or tasks that hold no row beside one that holds a whole row group; everything up to
    the first shuffle would then run on those few tasks. Only in that case the rows are
    hash-partitioned on ``key`` (a unique id: even and deterministic under task retry) or
    round-robin. Inputs that already have enough splits — the normal case on a cluster — are
    untouched. Enough is a task for each core and for each ``SPREAD_BYTES``, and none with more than
    ``SPREAD_ROWS`` rows: a larger input gives more tasks, not longer ones. The rows of the splits are
    counted from the files' footers.
    """
    held = (df.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n"))
            .agg(F.max("n").alias("most"), F.sum("n").alias("rows")).first())
    by_size = max(df.sparkSession.sparkContext.defaultParallelism, -(-estimated_bytes(df) // SPREAD_BYTES), -(-(held.rows or 0) // SPREAD_ROWS))
    target = min_partitions or by_size
    if df.rdd.getNumPartitions() >= target and (min_partitions or (held.most or 0) <= SPREAD_ROWS):
        return df
    return df.repartition(target, key) if key else df.repartition(target)
