"""Appends and upserts into a relational database.

The database does the merge: a batch is reduced to one row per key, loaded into a
staging table and merged by one statement.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from weirflow.sinks.keyvalue import last_row_per_key


def jdbc_append(df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None, batch_size: int = 1000) -> None:
    """Parameterized inserts, ``batch_size`` rows at a time, from every partition in parallel."""
    (
        df.write.format("jdbc").mode("append").option("url", url).option("dbtable", table)
        .option("batchsize", batch_size).options(**(properties or {})).save()
    )


def merge_statement(table: str, staging: str, columns: Sequence[str], keys: Sequence[str], update: Sequence[str] | None = None) -> str:
    """Standard ``MERGE``: update on a key match, insert otherwise.

    ``update`` limits the columns changed on a match; by default all non-key columns are replaced.
    """
    changed = [c for c in columns if c not in keys] if update is None else list(update)
    on = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    parts = [f"MERGE INTO {table} t USING {staging} s ON {on}"]
    if changed:
        parts.append("WHEN MATCHED THEN UPDATE SET " + ", ".join(f"t.{c} = s.{c}" for c in changed))
    parts.append(
        f"WHEN NOT MATCHED THEN INSERT ({', '.join(columns)}) VALUES ({', '.join(f's.{c}' for c in columns)})"
    )
    return " ".join(parts)


def _execute(spark: SparkSession, url: str, statement: str, properties: dict[str, str] | None) -> None:
    """One statement on a connection of the driver; no rows pass through it."""
    jvm = spark._jvm
    props = jvm.java.util.Properties()
    for k, v in (properties or {}).items():
        props.setProperty(k, v)
    connection = jvm.java.sql.DriverManager.getConnection(url, props)
    try:
        connection.createStatement().executeUpdate(statement)
    finally:
        connection.close()


def jdbc_upsert(
    rows: DataFrame, url: str, table: str, keys: Sequence[str], seq: str | None = None, update: Sequence[str] | None = None, properties: dict[str, str] | None = None, staging: str | None = None
) -> None:
    """Upsert a batch; repeating it gives the same table."""
    stage = staging or f"{table}_stage"
    last = last_row_per_key(rows, keys, seq)
    data = last.drop(seq) if seq and seq not in keys else last
    (
        data.write.format("jdbc").mode("overwrite").option("url", url).option("dbtable", stage)
        .options(**(properties or {})).save()
    )
    _execute(rows.sparkSession, url, merge_statement(table, stage, data.columns, keys, update), properties)


def jdbc_upsert_stream(stream: DataFrame, checkpoint: str, mode: str = "update", available_now: bool = False, **target) -> StreamingQuery:
    """``target`` holds the arguments of :func:`jdbc_upsert` after ``rows``."""
    writer = (
        stream.writeStream.outputMode(mode)
        .foreachBatch(lambda df, _: jdbc_upsert(df, **target))
        .option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()
