"""Partition profiles: rows per physical partition under default and keyed partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import IntegerType, LongType, ShortType


def partition_sizes(df: DataFrame, n_partitions: int) -> DataFrame:
    """(partition_id, n_rows) for every partition; empty ones show 0."""
    held = df.groupBy(F.spark_partition_id().alias("partition_id")).agg(
        F.count(F.lit(1)).alias("held")
    )
    every = df.sparkSession.range(n_partitions).select(
        F.col("id").cast("int").alias("partition_id")
    )
    return every.join(held, "partition_id", "left").select(
        "partition_id", F.coalesce("held", F.lit(0)).cast("bigint").alias("n_rows")
    )


def default_profile(df: DataFrame) -> DataFrame:
    """The profile of the partitions the scan itself makes."""
    return partition_sizes(df, df.rdd.getNumPartitions())


def partition_of(df: DataFrame, key: str, n_partitions: int) -> Column:
    """Integer keys modulo n, other keys by crc32: the same on every run and machine."""
    if isinstance(df.schema[key].dataType, (ShortType, IntegerType, LongType)):
        number = F.col(key).cast("bigint")
    else:
        number = F.crc32(F.col(key).cast("string"))
    return F.pmod(number, F.lit(n_partitions)).cast("int")


def partition_by_key(df: DataFrame, key: str, n_partitions: int) -> DataFrame:
    return df.repartitionById(n_partitions, partition_of(df, key, n_partitions))


def keyed_profile(df: DataFrame, key: str, n_partitions: int) -> DataFrame:
    placed = partition_by_key(df.select(key), key, n_partitions)
    return partition_sizes(placed, n_partitions)
