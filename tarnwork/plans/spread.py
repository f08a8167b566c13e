"""Small inputs in few files over all cores."""

from __future__ import annotations

from pyspark.sql import DataFrame

#: Input that one core is worth, in bytes; larger inputs come in enough splits of their own.
BYTES_A_CORE = 16 << 20


def spread(df: DataFrame, key: str) -> DataFrame:
    """df dealt by a key if its files are too small to occupy all cores before expensive work; else df as it is, without a shuffle."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return df.repartition(cores, key) if size < cores * BYTES_A_CORE else df
