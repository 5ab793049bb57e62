"""Rows to keyed messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def route(field: str | None, default: str, df: DataFrame) -> Column:
    """Value of a field as text; the default when the field is absent or null."""
    if field is None or field not in df.columns:
        return F.lit(default)
    return F.coalesce(F.col(field).cast("string"), F.lit(default))


def message_envelope(
    df: DataFrame, key: Column | str | None, value: Column | str, default_topic: str, topic_field: str | None = None, default_tag: str = "", tag_field: str | None = None
) -> DataFrame:
    """``(topic, tag, key, value)`` with UTF-8 bytes for key and value."""
    as_bytes = lambda c: F.encode((F.col(c) if isinstance(c, str) else c).cast("string"), "UTF-8")
    return df.select(
        route(topic_field, default_topic, df).alias("topic"),
        route(tag_field, default_tag, df).alias("tag"),
        (F.lit(None).cast("binary") if key is None else as_bytes(key)).alias("key"),
        as_bytes(value).alias("value"),
    )


def message_sink_kafka(envelope: DataFrame, servers: str, checkpoint: str | None = None, producer_options: dict[str, str] | None = None) -> StreamingQuery | None:
    """To Kafka (needs the connector package).  Delivery is at least once: a retried task may send again.

    The tag goes into the header ``tag``.  Sends are batched by the producer and
    flushed before a task ends; tune with ``producer_options`` (``kafka.linger.ms`` ...).
    """
    headers = F.array(F.struct(F.lit("tag").alias("key"), F.encode("tag", "UTF-8").alias("value")))
    rows = envelope.select("topic", "key", "value", headers.alias("headers"))
    options = {"kafka.bootstrap.servers": servers, "includeHeaders": "true", **(producer_options or {})}
    if not envelope.isStreaming:
        rows.write.format("kafka").options(**options).save()
        return None
    return rows.writeStream.format("kafka").options(**options).option("checkpointLocation", checkpoint).start()


def message_sink_files(envelope: DataFrame, path: str, checkpoint: str | None = None) -> StreamingQuery | None:
    """The same envelope as parquet files, for replay."""
    if not envelope.isStreaming:
        envelope.write.mode("append").parquet(path)
        return None
    return (
        envelope.writeStream.format("parquet").option("path", path)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
