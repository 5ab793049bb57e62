"""A source that makes its own rows, single or in parallel."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    InputPartition,
)

SCHEMA = "split int, seq bigint, payload string"


class _Range(InputPartition):
    def __init__(self, split: int, start: int, stop: int):
        self.split, self.start, self.stop = split, start, stop


def _rows(partition: _Range, seed: int):
    """Payload depends only on seed, split and position, so a retried task makes the same rows."""
    for i in range(partition.start, partition.stop):
        rng = random.Random(f"{seed}/{partition.split}/{i}")
        yield partition.split, i, f"send-{rng.randrange(1000)}"


class _BatchReader(DataSourceReader):
    def __init__(self, options: dict):
        self.splits = int(options.get("parallelism", 1))
        self.per_split = int(options.get("rowspersplit", 10))
        self.seed = int(options.get("seed", 0))

    def partitions(self):
        return [_Range(s, 0, self.per_split) for s in range(self.splits)]

    def read(self, partition):
        return _rows(partition, self.seed)


class _StreamReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.splits = int(options.get("parallelism", 1))
        self.per_batch = int(options.get("rowsperbatch", 1))
        self.seed = int(options.get("seed", 0))
        self.limit = int(options.get("rowspersplit", 0))  # 0: never ends
        self.position = 0

    def initialOffset(self) -> dict:
        return {"next": 0}

    def latestOffset(self) -> dict:
        nxt = self.position + self.per_batch
        self.position = min(nxt, self.limit) if self.limit else nxt
        return {"next": self.position}

    def partitions(self, start: dict, end: dict):
        # after a restart the offset log, not this object, says where to go on
        self.position = max(self.position, end["next"])
        return [_Range(s, start["next"], end["next"]) for s in range(self.splits)]

    def read(self, partition):
        return _rows(partition, self.seed)


class GeneratorSource(DataSource):
    """``spark.readStream.format("generator")`` with options parallelism, rowsPerBatch, rowsPerSplit, seed."""

    @classmethod
    def name(cls) -> str:
        return "generator"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema):
        return _BatchReader(self.options)

    def streamReader(self, schema):
        return _StreamReader(self.options)


def generator_source(
    spark: SparkSession, parallelism: int = 1, rows_per_batch: int = 1, rows_per_split: int = 0, seed: int = 0, streaming: bool = True
) -> DataFrame:
    """One payload per split and trigger; trigger every 500 ms for the usual pace."""
    spark.dataSource.register(GeneratorSource)
    options = {"parallelism": str(parallelism), "rowsPerBatch": str(rows_per_batch), "seed": str(seed), "rowsPerSplit": str(rows_per_split)}
    reader = spark.readStream if streaming else spark.read
    return reader.format("generator").options(**options).load()
