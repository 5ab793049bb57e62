"""Feed a table to a stream in order."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirflow.session import scratch_path


def replay_in_order(df: DataFrame, order: str, slices: int, path: str | None = None) -> str:
    """Write ``df`` as ``slices`` folders of ascending ``order``, one after the other, to be streamed in that order."""
    spark = df.sparkSession
    path = path or scratch_path(spark, "replay")
    low, high = df.agg(F.min(order), F.max(order)).first()
    for i in range(slices):
        a, b = low + (high - low) * i // slices, low + (high - low) * (i + 1) // slices
        upper = F.col(order) <= b if i == slices - 1 else F.col(order) < b
        df.where((F.col(order) >= a) & upper).coalesce(1).write.mode("append").parquet(path)
    return path
