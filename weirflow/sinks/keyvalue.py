"""Key/value upserts: the last value written for a field wins."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


SEQ = "_wf_seq"


def _as_long(rows: DataFrame, seq: str):
    """Order value as a number that keeps its order: microseconds for a point in time."""
    kind = rows.schema[seq].dataType.typeName()
    return F.unix_micros(F.col(seq).cast("timestamp")) if kind in ("timestamp", "timestamp_ntz", "date") else F.col(seq).cast("long")


class KeyValueTable:
    """Upsert table kept as one folder per batch.

    A put reduces the batch to one row per key and writes it to its own folder,
    overwriting it when the batch is replayed (idempotent).  Reads take the newest
    batch per key, or, for puts with ``across``, the row with the greatest ``seq`` over
    all batches; ``compact`` folds all batches into one.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str]):
        self.spark, self.path, self.keys = spark, path.rstrip("/"), list(keys)

    def put(self, rows: DataFrame, batch_id: int, seq: str | None = None, across: bool = False) -> None:
        """``seq`` orders rows of the same key inside a batch; without it keys must be unique in the batch.

        ``across``: it also orders the batches' rows, so that an older row in a later batch does not win.
        """
        kept = last_row_per_key(rows, self.keys, seq)
        kept = kept.withColumn(SEQ, _as_long(kept, seq) if seq and across else F.lit(None).cast("long"))
        kept.write.mode("overwrite").parquet(f"{self.path}/batch={batch_id}")

    def current(self) -> DataFrame:
        stored = self.spark.read.option("basePath", self.path).parquet(f"{self.path}/batch=*")
        rest = [c for c in stored.columns if c not in (*self.keys, "batch", SEQ)]
        newest = self._newest(stored, rest)
        return newest.select(*self.keys, *[F.col(f"r.{c}").alias(c) for c in rest])

    def _newest(self, stored: DataFrame, rest: list[str]) -> DataFrame:
        age = F.struct(F.coalesce(F.col(SEQ), F.lit(-(1 << 63))), F.col("batch").cast("long"))
        return stored.groupBy(*self.keys).agg(F.max_by(F.struct(*rest, SEQ), age).alias("r"))

    def get(self, condition) -> DataFrame:
        return self.current().where(condition)

    def compact(self, target: str) -> "KeyValueTable":
        stored = self.spark.read.option("basePath", self.path).parquet(f"{self.path}/batch=*")
        rest = [c for c in stored.columns if c not in (*self.keys, "batch", SEQ)]
        newest = self._newest(stored, rest)
        newest.select(*self.keys, *[F.col(f"r.{c}").alias(c) for c in [*rest, SEQ]]).write.parquet(f"{target.rstrip('/')}/batch=-1")
        return KeyValueTable(self.spark, target, self.keys)

    def attach(self, stream: DataFrame, checkpoint: str, seq: str | None = None, mode: str = "update", available_now: bool = True, across: bool = False) -> StreamingQuery:
        writer = (
            stream.writeStream.outputMode(mode)
            .foreachBatch(lambda df, batch_id: self.put(df, batch_id, seq, across))
            .option("checkpointLocation", checkpoint)
        )
        return (writer.trigger(availableNow=True) if available_now else writer).start()


def last_row_per_key(rows: DataFrame, keys: Sequence[str], seq: str | None) -> DataFrame:
    if seq is None:
        return rows
    rest = [c for c in rows.columns if c not in keys]
    out = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), seq).alias("r"))
    return out.select(*keys, *[F.col(f"r.{c}").alias(c) for c in rest])


def kv_upsert_client(rows: DataFrame, open_client: Callable[[], object], put: Callable[[object, Row], None], close: Callable[[object], None]) -> None:
    """Write rows with an external client opened and closed once per partition; puts must be idempotent."""

    def write(partition: Iterator[Row]) -> None:
        client = open_client()
        try:
            for row in partition:
                put(client, row)
        finally:
            close(client)

    rows.foreachPartition(write)
