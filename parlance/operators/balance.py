"""Work distribution ahead of CPU-heavy Python stages, for small sources only."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread_for_cpu(df: DataFrame, factor: int = 4) -> DataFrame:
    """Round-robin the rows of a scan that has fewer splits than cores; any other scan stays as it is.

    Parquet splits follow row groups, so a table stored as few large row groups scans
    in few tasks; an expensive per-row Python stage (alignment, NFKC) would then run on
    a handful of cores. Only a plain scan is to be passed, as the fixtures do: its splits are
    known without running a job. A large table has splits enough and is never shuffled.
    """
    sc = df.sparkSession.sparkContext
    if df.rdd.getNumPartitions() >= sc.defaultParallelism:
        return df
    return df.repartition(factor * sc.defaultParallelism)
