"""Keyed messages: one envelope for a message queue and for files that replay one.

Envelope: ``topic, partition, offset, tag, key, value, timestamp`` (key and value
are bytes).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from weirflow.session import ship_package
from weirflow.sources import watched

ENVELOPE = (
    "topic string, partition int, offset bigint, tag string, key binary, value binary, timestamp timestamp"
)


def message_source(
    spark: SparkSession,
    servers: str,
    topic: str,
    start: str = "latest",
    start_timestamp_ms: int | None = None,
    tag: str | None = None,
    with_key: bool = True,
    batch_messages: int | None = None,
) -> DataFrame:
    """Stream from a Kafka topic (needs the Kafka connector package on the classpath).

    ``start`` is ``earliest``, ``latest`` or ``timestamp``; a running query
    continues from its checkpoint instead.  The tag travels in the header ``tag``.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("includeHeaders", True)
    )
    if start == "timestamp":
        reader = reader.option("startingTimestamp", start_timestamp_ms)
    else:
        reader = reader.option("startingOffsets", start)
    if batch_messages:
        reader = reader.option("maxOffsetsPerTrigger", batch_messages)
    raw = reader.load()
    header = F.filter("headers", lambda h: h["key"] == "tag")
    envelope = raw.withColumn("tag", F.decode(F.get(header, F.lit(0))["value"], "UTF-8"))
    return select_messages(envelope, tag, with_key)


def replay_source(
    spark: SparkSession,
    folder: str,
    topic: str | None = None,
    start: str = "earliest",
    start_timestamp: Column | None = None,
    tag: str | None = None,
    with_key: bool = True,
    files_per_batch: int | None = None,
    streaming: bool = True,
) -> DataFrame:
    """Messages kept as parquet files in the envelope, as a stream or a batch.

    ``latest`` skips the files present when the query was first started (streams only): the place is the stream's first offset, kept in its
    checkpoint, so a restart continues there. It takes all new files in a batch.
    """
    if streaming and start == "latest":
        watched.register(ship_package(spark))
        df = spark.readStream.format(watched.NewFilesSource.name()).schema(ENVELOPE).option("path", folder).option("start", start).load()
    elif streaming:
        reader = spark.readStream.schema(ENVELOPE).format("parquet")
        if files_per_batch:
            reader = reader.option("maxFilesPerTrigger", files_per_batch)
        df = reader.load(folder)
    else:
        df = spark.read.schema(ENVELOPE).parquet(folder)
    if start == "timestamp":
        df = df.where(F.col("timestamp") >= start_timestamp)
    if topic:
        df = df.where(F.col("topic") == topic)
    return select_messages(df, tag, with_key)


def select_messages(envelope: DataFrame, tag: str | None, with_key: bool) -> DataFrame:
    """Tag filter (``a || b`` names several, ``*`` or nothing means all) and choice of key+value or value only."""
    df = envelope
    if tag and tag.strip() != "*":
        df = df.where(F.col("tag").isin([t.strip() for t in tag.split("||")]))
    cols = ["topic", "partition", "offset", "tag", "timestamp"]
    return df.select(*cols, "key", "value") if with_key else df.select(*cols, "value")


def ingest_messages_to_table(
    messages: DataFrame, schema: str, fmt: str, target: str, checkpoint: str, available_now: bool = True
) -> StreamingQuery:
    """Parse message bodies (``csv`` or ``json``) and keep them in a parquet table.

    The table stays when the source is gone; a restart neither loses nor repeats rows.
    """
    writer = (
        parse_messages(messages, schema, fmt)
        .writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def parse_messages(messages: DataFrame, schema: str, fmt: str) -> DataFrame:
    text = F.decode("value", "UTF-8")
    if fmt == "csv":
        parsed = F.from_csv(text, schema)
    elif fmt == "json":
        parsed = F.from_json(text, schema)
    else:
        raise ValueError(f"unknown message format {fmt!r}")
    return messages.select(parsed.alias("r")).select("r.*")
