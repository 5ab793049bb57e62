"""Plain views and views kept up to date per insert batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from weirflow.functions import states
from weirflow.operators.aggregate import agg_state_merge, agg_state_partial
from weirflow.session import scratch_path


def plain_view(spark: SparkSession, name: str, query: str) -> DataFrame:
    """Stored query without data; unusable once its source is gone."""
    spark.sql(f"CREATE OR REPLACE TEMP VIEW {name} AS {query}")
    return spark.table(name)


def temp_table(df: DataFrame, name: str) -> DataFrame:
    """Session-scoped table: holds the rows of now, whatever happens to their source later."""
    spark = df.sparkSession
    path = scratch_path(spark, "temp-table")
    df.write.parquet(path)
    spark.read.schema(df.schema).parquet(path).createOrReplaceTempView(name)
    return spark.table(name)


Aggs = dict[str, tuple[str, str]]


def incremental_rows(df: DataFrame, batch: str, keys: Sequence[str], aggs: Aggs) -> DataFrame:
    """What the view holds after all batches: each insert batch aggregated on its own, never merged with another."""
    return agg_state_partial(df, [batch, *keys], aggs)


def incremental_merged(df: DataFrame, batch: str, keys: Sequence[str], aggs: Aggs) -> DataFrame:
    """Stored states merged on read give the true totals."""
    return agg_state_merge(incremental_rows(df, batch, keys, aggs), keys, aggs)


class IncrementalView:
    """A parquet table fed by every insert batch of a source.

    Each batch writes its own ``batch=<id>`` folder and overwrites it when the
    batch is replayed, so a restart changes nothing.  The table is independent of
    the source and stays when the source is dropped.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], aggs: Aggs):
        self.spark, self.path, self.keys, self.aggs = spark, path.rstrip("/"), list(keys), aggs

    def insert(self, batch_df: DataFrame, batch_id: int) -> None:
        agg_state_partial(batch_df, self.keys, self.aggs).write.mode("overwrite").parquet(f"{self.path}/batch={batch_id}")

    def populate(self, existing: DataFrame) -> None:
        """Backfill from rows that were there before the view."""
        self.insert(existing, -1)

    def attach(self, stream: DataFrame, checkpoint: str, available_now: bool = True) -> StreamingQuery:
        writer = stream.writeStream.foreachBatch(self.insert).option("checkpointLocation", checkpoint)
        return (writer.trigger(availableNow=True) if available_now else writer).start()

    def rows(self) -> DataFrame:
        """Unmerged content."""
        return self.spark.read.option("basePath", self.path).parquet(f"{self.path}/batch=*")

    def merged(self) -> DataFrame:
        return agg_state_merge(self.rows(), self.keys, self.aggs)

    def compact(self, target: str) -> "IncrementalView":
        """Merged states as a new view table, to keep the number of parts low."""
        merged = agg_state_merge(self.rows(), self.keys, self.aggs, finish=False)
        merged.write.mode("overwrite").parquet(f"{target.rstrip('/')}/batch=-1")
        return IncrementalView(self.spark, target, self.keys, self.aggs)


def state_columns(aggs: Aggs) -> list[str]:
    return [c for n, (kind, _) in aggs.items() for c in states.columns(kind, n)]


def view_rows_without_batch(view: IncrementalView) -> DataFrame:
    return view.rows().select(*view.keys, *[F.col(c) for c in state_columns(view.aggs)])
