"""Input that comes in fewer pieces than there are cores."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame) -> DataFrame:
    """df over as many partitions as there are cores, if it has fewer (one small file); large inputs aren't touched."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
