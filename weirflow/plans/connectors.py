"""Sources and sinks, run on data derived from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from weirflow.operators.reshape import flat_map_split
from weirflow.plans.aggregates import event_stream
from weirflow.plans.registry import events, query
from weirflow.session import load, scratch_path
from weirflow.sinks import files as file_sinks
from weirflow.sinks.keyvalue import KeyValueTable
from weirflow.sinks.messages import message_envelope, message_sink_files
from weirflow.sources import files, messages
from weirflow.streaming.pipelines import count_changes, run_to_keys, run_to_table

LINES_SQL = "SELECT unnest(string_split(text, chr(10))) AS line FROM conversations"


def _text_folder(spark, sf_dir):
    path = scratch_path(spark, "lines")
    file_sinks.write_text(load(spark, sf_dir, "conversations").select("text"), path)
    return path


@query("read_text_lines", f"SELECT line, CAST(count(*) AS BIGINT) AS cnt FROM ({LINES_SQL}) GROUP BY line")
def read_text_lines(spark, sf_dir):
    lines = files.read_text_lines(spark, _text_folder(spark, sf_dir))
    return lines.groupBy(F.col("value").alias("line")).agg(F.count(F.lit(1)).alias("cnt"))


@query("stream_text_lines", f"""
    WITH l AS ({LINES_SQL}), t AS (SELECT line, rtrim(line, ' ') AS r FROM l),
    w AS (SELECT unnest(string_split(r, ' ')) AS word FROM t WHERE NOT (r = '' AND line <> ''))
    SELECT word, CAST(count(*) AS BIGINT) AS cnt FROM w GROUP BY word""")
def stream_text_lines(spark, sf_dir):
    lines = files.stream_text_lines(spark, _text_folder(spark, sf_dir))
    return run_to_keys(count_changes(flat_map_split(lines, "value"), ["word"]), ["word"])


@query("stream_follow_file", """
    SELECT conv_id, CAST(count(*) * (2 - conv_id % 2) AS BIGINT) AS times FROM conversations GROUP BY conv_id""")
def stream_follow_file(spark, sf_dir):
    """A folder that changes once: its whole content comes again, so the first lines are seen twice; a start without a change adds nothing."""
    path, seen, place = (scratch_path(spark, x) for x in ("followed", "followed-out", "followed-checkpoint"))
    ids = load(spark, sf_dir, "conversations").select(F.col("conv_id").cast("string"))
    lines = files.stream_follow_file(spark, path)
    for rest in (0, 1, None):
        if rest is not None:
            ids.where(F.col("conv_id").cast("bigint") % 2 == rest).write.mode("append").text(path)
        lines.writeStream.format("parquet").option("path", seen).option("checkpointLocation", place).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("value string").parquet(seen).groupBy(F.col("value").cast("bigint").alias("conv_id")).agg(F.count(F.lit(1)).alias("times"))


@query("read_csv_typed", "SELECT c_custkey, c_name, c_acctbal, c_acctbal > 5000 AS rich FROM customer")
def read_csv_typed(spark, sf_dir):
    path = scratch_path(spark, "customer-csv")
    load(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal").write.csv(path)
    files.read_csv_typed(spark, path, "c_custkey bigint, c_name string, c_acctbal double", view="wf_csv_customer")
    return spark.sql("SELECT *, c_acctbal > 5000 AS rich FROM wf_csv_customer")


@query("read_csv_glob", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def read_csv_glob(spark, sf_dir):
    path = scratch_path(spark, "orders-csv")
    file_sinks.export_csv(load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus"), path, ",")
    return files.read_csv_glob(spark, f"{path}/*.csv", "o_orderkey bigint, o_custkey bigint, o_orderstatus string")


@query("from_values", """
    SELECT o.o_orderkey, o.o_custkey, v.priority FROM orders o JOIN (VALUES ('F', 1), ('O', 2), ('P', 3)) v(status, priority) ON o.o_orderstatus = v.status
    UNION ALL SELECT NULL, g.value, NULL FROM (SELECT unnest(generate_series((SELECT min(o_custkey) FROM orders), (SELECT max(o_custkey) FROM orders))) AS value) g""")
def from_values(spark, sf_dir):
    """Literal rows joined to the orders, and a sequence over their range of customers."""
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    ranks = files.from_values(spark, [("F", 1), ("O", 2), ("P", 3)], "status string, priority int")
    ranked = orders.join(ranks, F.col("o_orderstatus") == F.col("status")).select("o_orderkey", "o_custkey", "priority")
    low, high = orders.agg(F.min("o_custkey"), F.max("o_custkey")).first()
    numbers = files.generate_sequence(spark, low, high).select(F.col("value").alias("o_custkey"))
    return ranked.unionByName(numbers, allowMissingColumns=True)


def _envelope(spark, sf_dir):
    e = events(spark, sf_dir)
    topic = F.when(F.col("event_id") % 4 != 0, F.col("event_type"))
    return message_envelope(e.withColumn("topic_name", topic), "user_id", "props", "other", "topic_name", "plain", "no_such_field")


@query("message_sink", """
    SELECT coalesce(CASE WHEN event_id % 4 <> 0 THEN event_type END, 'other') AS topic, 'plain' AS tag,
           CAST(user_id AS VARCHAR) AS key, props AS value FROM events""")
def message_sink(spark, sf_dir):
    path = scratch_path(spark, "sent")
    message_sink_files(_envelope(spark, sf_dir), path)
    sent = spark.read.parquet(path)
    return sent.select("topic", "tag", F.decode("key", "UTF-8").alias("key"), F.decode("value", "UTF-8").alias("value"))


def _message_folder(spark, sf_dir):
    """Events as stored messages: topic, tag = type, key = user, value = JSON body."""
    return _written(spark, sf_dir, scratch_path(spark, "messages"))


def _written(spark, sf_dir, path):
    text = lambda c: F.encode(F.col(c).cast("string"), "UTF-8")
    events(spark, sf_dir).select(
        F.lit("events").alias("topic"), (F.col("user_id") % 4).cast("int").alias("partition"), F.col("event_id").alias("offset"),
        F.col("event_type").alias("tag"), text("user_id").alias("key"), text("props").alias("value"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    ).write.parquet(path)
    return path


@query("message_source", """
    SELECT event_id AS "offset", event_type AS tag, CAST(user_id AS VARCHAR) AS key, props AS value FROM events
    WHERE event_type IN ('click', 'view') AND ts >= TIMESTAMP '2024-01-05 00:00:00'""")
def message_source(spark, sf_dir):
    stream = messages.replay_source(
        spark, _message_folder(spark, sf_dir), "events", "timestamp", F.lit("2024-01-05 00:00:00").cast("timestamp"), tag="click || view")
    text = lambda c: F.decode(c, "UTF-8").alias(c)
    return run_to_table(stream.select("offset", "tag", text("key"), text("value")))


@query("message_source_latest", "SELECT event_id AS \"offset\", event_type AS tag FROM events WHERE event_id % 3 > 0")
def message_source_latest(spark, sf_dir):
    """Started when a third of the messages is there, stopped, and started again after each further third: the first is never given."""
    whole, folder, out, place = (scratch_path(spark, x) for x in ("all", "messages", "latest", "latest-checkpoint"))
    _written(spark, sf_dir, whole)
    stream = messages.replay_source(spark, folder, "events", "latest").select("offset", "tag")
    for rest in (0, 1, 2):
        spark.read.parquet(whole).where(F.col("offset") % 3 == rest).write.mode("append").parquet(folder)
        stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", place).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("offset bigint, tag string").parquet(out)


@query("ingest_messages_to_table", "SELECT CAST(props->>'$.k' AS BIGINT) AS k FROM events")
def ingest_messages_to_table(spark, sf_dir):
    stream = messages.replay_source(spark, _message_folder(spark, sf_dir), with_key=False)
    target = scratch_path(spark, "kept")
    messages.ingest_messages_to_table(stream, "k bigint", "json", target, scratch_path(spark, "kept-checkpoint")).awaitTermination()
    return spark.read.schema("k bigint").parquet(target)


@query("ingest_csv_messages", "SELECT event_id, event_type, user_id FROM events")
def ingest_csv_messages(spark, sf_dir):
    line = F.encode(F.concat_ws(",", "event_id", "event_type", "user_id"), "UTF-8")
    return messages.parse_messages(events(spark, sf_dir).select(line.alias("value")), "event_id bigint, event_type string, user_id bigint", "csv")


@query("write_text", "SELECT event_type || ' ' || CAST(event_id AS VARCHAR) AS value FROM events")
def write_text(spark, sf_dir):
    path = scratch_path(spark, "text")
    file_sinks.write_text(events(spark, sf_dir).select(F.concat_ws(" ", "event_type", "event_id")), path, 4)
    return files.read_text_lines(spark, path)


@query("rolling_file_sink", """
    SELECT strftime(ts, '%Y-%m-%d') AS date, strftime(ts, '%H') AS hour, CAST(count(*) AS BIGINT) AS cnt FROM events GROUP BY 1, 2""")
def rolling_file_sink(spark, sf_dir):
    path = scratch_path(spark, "rolled")
    stream = event_stream(spark, sf_dir).where("event_id >= 0")
    file_sinks.rolling_file_sink(stream, "ts", path, scratch_path(spark, "rolled-checkpoint"), max_rows_per_file=1_000_000, available_now=True).awaitTermination()
    rolled = spark.read.schema(f"{_ddl(stream)}, date string, hour string").parquet(path)
    return rolled.groupBy("date", "hour").agg(F.count(F.lit(1)).alias("cnt"))


def _ddl(df):
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


@query("export_csv", "SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem")
def export_csv(spark, sf_dir):
    path = scratch_path(spark, "export")
    file_sinks.export_csv(load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag"), path, "|")
    return files.read_csv_typed(spark, path, "l_orderkey bigint, l_linenumber int, l_quantity double, l_returnflag string", "|")


@query("kv_upsert", """
    SELECT user_id AS field, CAST(count(*) AS VARCHAR) AS value FROM events GROUP BY user_id""")
def kv_upsert(spark, sf_dir):
    """Hash ``field -> value`` kept by a stream of counts; the last value of a field wins."""
    counts = count_changes(event_stream(spark, sf_dir), ["user_id"])
    table = KeyValueTable(spark, scratch_path(spark, "hash"), ["field"])
    pairs = counts.select(F.col("user_id").alias("field"), F.col("cnt").cast("string").alias("value"))
    table.attach(pairs, scratch_path(spark, "hash-checkpoint")).awaitTermination()
    return table.current()
