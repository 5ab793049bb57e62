"""Registry of queries and their oracle SQL, and input frames they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weirflow.session import load

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    def add(fn: QueryFn) -> QueryFn:
        if key in QUERIES:
            raise ValueError(f"query {key} is registered twice")
        QUERIES[key] = fn
        if sql:
            ORACLES[key] = sql
        return fn

    return add


def events(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    df = load(spark, sf_dir, "events")
    return df.select(*columns) if columns else df


def arrival() -> Column:
    """Arrival order that differs from event time; same formula as ARRIVAL_SQL."""
    return F.col("event_id") + (F.col("event_id") * 7919) % 50


def row_count() -> Column:
    return F.count(F.lit(1))


ARRIVAL_SQL = "event_id + (event_id * 7919) % 50"

# properties of an event used as insert-batch inputs; same formulas in INSERTS_SQL
K_SCHEMA = "k bigint"


def inserts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as inserted rows: partition event_type, key user_id, version k, sign, cents, batch, _seq."""
    return events(spark, sf_dir).select(
        "event_type",
        "user_id",
        F.from_json("props", K_SCHEMA)["k"].alias("k"),
        F.round(F.col("value") * 100).cast("bigint").alias("cents"),
        F.when(F.col("event_id") % 3 == 0, -1).otherwise(1).alias("sign"),
        F.floor(F.col("event_id") / 1000).alias("_batch"),
        F.col("event_id").alias("_seq"),
    )


INSERTS_SQL = """inserts AS (
  SELECT event_type, user_id, CAST(props->>'$.k' AS BIGINT) AS k,
         CAST(round(value * 100) AS BIGINT) AS cents,
         CASE WHEN event_id % 3 = 0 THEN -1 ELSE 1 END AS sign,
         event_id // 1000 AS _batch, event_id AS _seq
  FROM events)"""


def bucket_sql(ts: str, seconds: int) -> str:
    """Start of the epoch-aligned window holding ``ts``."""
    us = seconds * 1_000_000
    return f"make_timestamp(epoch_us({ts}) // {us} * {us})"
