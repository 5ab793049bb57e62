"""How rows are spread over partitions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dist_shuffle(df: DataFrame, n: int, seed: int = 0) -> DataFrame:
    """Random spread; copies of one row are spread like any other rows."""
    return df.repartition(n, F.rand(seed))


def dist_rebalance(df: DataFrame, n: int) -> DataFrame:
    """Round robin; evens out skewed partitions."""
    return df.repartition(n)


def dist_rescale(df: DataFrame, n: int) -> DataFrame:
    """Regroup neighbours without a full shuffle when shrinking; growing needs one."""
    return df.coalesce(n) if n < df.rdd.getNumPartitions() else df.repartition(n)


def dist_broadcast(df: DataFrame, n: int, copy: str = "copy") -> DataFrame:
    """One full copy per partition: each row is repeated ``n`` times and copy i goes to partition i.

    Output is n times the input by definition; meant for small inputs.  For joins
    use :mod:`weirflow.operators.enrich`, where Spark decides by size.
    """
    copies = df.withColumn(copy, F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    return copies.repartitionById(n, F.col(copy))


def dist_global(df: DataFrame) -> DataFrame:
    """Everything in one partition.  Only for results that are known to be small."""
    return df.coalesce(1)


def dist_hash_key(df: DataFrame, n: int, key: str) -> DataFrame:
    return df.repartition(n, key)


def dist_custom(df: DataFrame, n: int, key: Column | str, fn: Callable[[Column], Column] | None = None) -> DataFrame:
    """Partition number from a column function; non-negative remainder by default."""
    c = F.col(key) if isinstance(key, str) else key
    target = fn(c) if fn else c
    return df.repartitionById(n, F.pmod(target, F.lit(n)).cast("int"))


def with_partition(df: DataFrame, name: str = "part") -> DataFrame:
    return df.withColumn(name, F.spark_partition_id())


def rows_per_partition(df: DataFrame) -> DataFrame:
    return with_partition(df).groupBy("part").agg(F.count(F.lit(1)).alias("rows"))


def write_sharded(df: DataFrame, path: str, key: str, shards: int) -> None:
    """Sharded insert: shard number from the key, one folder per shard."""
    shard = F.pmod(F.xxhash64(key), F.lit(shards)).cast("int")
    df.withColumn("shard", shard).write.partitionBy("shard").parquet(path)
