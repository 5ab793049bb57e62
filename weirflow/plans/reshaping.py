"""Stateless row operators and data distribution."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from weirflow.operators import distribution as dist
from weirflow.operators import reshape as ops
from weirflow.plans.registry import events, query
from weirflow.session import load


@query("map_project", """
    SELECT event_type || '\t' || CAST(user_id AS VARCHAR) AS record, CAST(user_id * 10 AS BIGINT) AS times_ten,
           CAST(user_id + 10 AS BIGINT) AS plus_ten FROM events""")
def map_project(spark, sf_dir):
    return ops.map_project(
        events(spark, sf_dir, "event_type", "user_id"),
        {"record": F.concat_ws("\t", "event_type", "user_id"), "times_ten": "user_id * 10", "plus_ten": "user_id + 10"},
    )


@query("flat_map_split", """
    WITH t AS (SELECT doc_id, text, rtrim(text, ' ') AS r FROM documents)
    SELECT doc_id, unnest(string_split(r, ' ')) AS word FROM t WHERE NOT (r = '' AND text <> '')""")
def flat_map_split(spark, sf_dir):
    return ops.flat_map_split(load(spark, sf_dir, "documents"), "text", keep=["doc_id"])


@query("filter_not_contains", """
    SELECT event_id, value FROM events WHERE strpos(CAST(event_id AS VARCHAR), '0') = 0""")
def filter_not_contains(spark, sf_dir):
    return ops.filter_not_contains(events(spark, sf_dir, "event_id", "value"), "event_id")


@query("filter_not_contains_flat", """
    SELECT event_id, value FROM events WHERE strpos(CAST(event_id AS VARCHAR), '0') = 0""")
def filter_not_contains_flat(spark, sf_dir):
    return ops.flat_filter_not_contains(events(spark, sf_dir, "event_id", "value"), "event_id")


@query("sql_select_where", """
    SELECT 'fluent' AS form, c_name, c_acctbal FROM customer WHERE c_acctbal > 7000
    UNION ALL SELECT 'sql' AS form, c_name, c_acctbal FROM customer WHERE c_acctbal > 7000""")
def sql_select_where(spark, sf_dir):
    df = load(spark, sf_dir, "customer")
    df.createOrReplaceTempView("wf_customer")
    cols = ["c_name", "c_acctbal"]
    fluent = ops.select_where(df, cols, "c_acctbal > 7000").withColumn("form", F.lit("fluent"))
    text = ops.select_where_sql(spark, "wf_customer", cols, "c_acctbal > 7000").withColumn("form", F.lit("sql"))
    return fluent.unionByName(text)


@query("side_output_split", """
    SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'even' ELSE 'odd' END AS tag FROM events""")
def side_output_split(spark, sf_dir):
    df = events(spark, sf_dir, "event_id")
    return ops.side_output_split(df, {"odd": F.col("event_id") % 2 != 0}, default="even")


@query("connect_comap", """
    SELECT CAST(n_nationkey AS BIGINT) AS v, n_name AS name, 1 AS side FROM nation
    UNION ALL SELECT c_custkey, c_name, 2 FROM customer""")
def connect_comap(spark, sf_dir):
    return ops.connect_comap(
        load(spark, sf_dir, "nation"),
        load(spark, sf_dir, "customer"),
        lambda d: d.select(F.col("n_nationkey").cast("bigint").alias("v"), F.col("n_name").alias("name"), F.lit(1).alias("side")),
        lambda d: d.select(F.col("c_custkey").alias("v"), F.col("c_name").alias("name"), F.lit(2).alias("side")),
    )


@query("union_all", """
    SELECT user_id, event_type FROM events WHERE event_type = 'click'
    UNION ALL SELECT user_id, event_type FROM events""")
def union_all(spark, sf_dir):
    df = events(spark, sf_dir, "user_id", "event_type")
    return ops.union_all(df.where("event_type = 'click'"), df)


@query("udtf_split", """
    WITH t AS (SELECT text, rtrim(text, ' ') AS r FROM conversations),
    w AS (SELECT unnest(string_split(r, ' ')) AS word FROM t WHERE NOT (r = '' AND text <> ''))
    SELECT word AS "单词", CAST(count(*) AS BIGINT) AS "数量" FROM w GROUP BY word""")
def udtf_split(spark, sf_dir):
    return ops.udtf_split_count(load(spark, sf_dir, "conversations"), "text")


@query("udtf_split_sql", """
    WITH t AS (SELECT text, rtrim(text, ' ') AS r FROM conversations),
    w AS (SELECT unnest(string_split(r, ' ')) AS word FROM t WHERE NOT (r = '' AND text <> ''))
    SELECT word, CAST(count(*) AS BIGINT) AS total FROM w GROUP BY word""")
def udtf_split_sql(spark, sf_dir):
    name = ops.register_split_udtf(spark)
    load(spark, sf_dir, "conversations").select("text").createOrReplaceTempView("wf_lines")
    return spark.sql(
        f"SELECT w.word, sum(w.cnt) AS total FROM wf_lines, LATERAL {name}(text) w GROUP BY w.word"
    )


@query("map_with_lifecycle", """
    SELECT user_id, event_id, user_id * 2 AS doubled, TRUE AS opened FROM events""")
def map_with_lifecycle(spark, sf_dir):
    def process(resource: dict, batch: pd.DataFrame) -> pd.DataFrame:
        return batch.assign(doubled=batch["user_id"] * resource["factor"], opened=resource["open"])

    return ops.map_with_lifecycle(
        events(spark, sf_dir, "user_id", "event_id"),
        "user_id bigint, event_id bigint, doubled bigint, opened boolean",
        open_task=lambda: {"factor": 2, "open": True},
        process=process,
        close_task=lambda resource: resource.update(open=False),
    )


@query("iterate_until", """
    WITH RECURSIVE loop(event_id, v, rounds) AS (
      SELECT event_id, CASE WHEN k > 0 THEN k - 3 ELSE k END, CAST(1 AS BIGINT)
      FROM (SELECT event_id, CAST(props->>'$.k' AS BIGINT) AS k FROM events)
      UNION ALL SELECT event_id, v - 3, rounds + 1 FROM loop WHERE v > 0)
    SELECT event_id, v, rounds FROM loop WHERE v <= 0""")
def iterate_until(spark, sf_dir):
    df = events(spark, sf_dir, "event_id", "props")
    numbers = df.select("event_id", F.from_json("props", "k bigint")["k"].alias("v"))
    return ops.iterate_until(numbers, {"v": "CASE WHEN v > 0 THEN v - 3 ELSE v END"}, "v > 0", unroll=16)


@query("parse_json_fields", """
    SELECT event_id, CAST(CAST(props->>'$.k' AS DOUBLE) AS BIGINT) AS k FROM events""")
def parse_json_fields(spark, sf_dir):
    return ops.parse_json_fields(events(spark, sf_dir, "event_id", "props"), "props", "k double", {"k": "cast(j.k as bigint)"}, ["event_id"])


@query("decode_message_kv", """
    SELECT event_id, CASE WHEN event_id % 5 = 0 THEN NULL ELSE CAST(user_id AS VARCHAR) END AS msg_key, props AS body FROM events""")
def decode_message_kv(spark, sf_dir):
    df = events(spark, sf_dir, "event_id", "user_id", "props")
    raw = ops.encode_message_kv(df.withColumn("user_id", F.when(F.col("event_id") % 5 != 0, F.col("user_id"))), "user_id", "props")
    return ops.decode_message_kv(raw, key_as="msg_key", value_as="body")


@query("decode_message_map", """
    SELECT event_id, CASE WHEN event_id % 5 = 0 THEN NULL ELSE CAST(user_id AS VARCHAR) END AS k, props AS v FROM events""")
def decode_message_map(spark, sf_dir):
    df = events(spark, sf_dir, "event_id", "user_id", "props")
    raw = ops.encode_message_kv(df.withColumn("user_id", F.when(F.col("event_id") % 5 != 0, F.col("user_id"))), "user_id", "props")
    out = ops.decode_message_kv(raw, form="map")
    return out.select("event_id", F.col("message")["key"].alias("k"), F.col("message")["value"].alias("v"))


@query("parse_delimited_record", """
    SELECT event_id, event_type || '\t' || CAST(user_id AS VARCHAR) || '\t' || CAST(event_id AS VARCHAR)
           || '\t' || CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR) AS record FROM events""")
def parse_delimited_record(spark, sf_dir):
    q = lambda c: F.concat(F.lit("'"), F.col(c).cast("string"), F.lit("'"))
    cents = F.round(F.col("value") * 100).cast("bigint").cast("string")
    line = F.concat_ws(",", q("event_type"), F.lit("x"), q("user_id"), F.lit("y"), q("event_id"), F.lit("z"), cents)
    lines = events(spark, sf_dir).select("event_id", line.alias("line"))
    return ops.parse_delimited_record(lines, "line").select("event_id", "record")


@query("flat_map_split_whitespace", """
    WITH t AS (SELECT conv_id, turn, regexp_replace(text, '[ \\t\\n\\x0b\\f\\r]+$', '') AS r, text FROM conversations)
    SELECT conv_id, turn, unnest(regexp_split_to_array(r, '[ \\t\\n\\x0b\\f\\r]')) AS word FROM t WHERE NOT (r = '' AND text <> '')""")
def split_on_whitespace(spark, sf_dir):
    return ops.flat_map_split(load(spark, sf_dir, "conversations"), "text", r"\s", keep=["conv_id", "turn"])


# --- distribution -----------------------------------------------------------

N = 8


def _spread(df):
    """Rows and partitions in use, as one row."""
    return dist.rows_per_partition(df).agg(F.count(F.lit(1)).alias("parts"), F.sum("rows").alias("total"))


@query("dist_shuffle", f"SELECT CAST({N} AS BIGINT) AS parts, CAST(count(*) AS BIGINT) AS total FROM events")
def dist_shuffle(spark, sf_dir):
    return _spread(dist.dist_shuffle(events(spark, sf_dir, "event_id", "user_id"), N))


@query("dist_rebalance", f"SELECT CAST({N} AS BIGINT) AS parts, CAST(count(*) AS BIGINT) AS total FROM events")
def dist_rebalance(spark, sf_dir):
    return _spread(dist.dist_rebalance(events(spark, sf_dir, "event_id"), N))


@query("dist_rescale", "SELECT CAST(2 AS BIGINT) AS parts, CAST(count(*) AS BIGINT) AS total FROM events")
def dist_rescale(spark, sf_dir):
    return _spread(dist.dist_rescale(dist.dist_rebalance(events(spark, sf_dir, "event_id"), N), 2))


@query("dist_broadcast", f"""
    SELECT CAST(c AS INTEGER) AS part, CAST(count(*) AS BIGINT) AS "rows"
    FROM supplier, (SELECT unnest(generate_series(0, {N - 1})) AS c) GROUP BY c""")
def dist_broadcast(spark, sf_dir):
    return dist.rows_per_partition(dist.dist_broadcast(load(spark, sf_dir, "supplier").select("s_suppkey"), N))


@query("dist_global", """
    SELECT 0 AS part, event_type, CAST(count(*) AS BIGINT) AS cnt FROM events GROUP BY event_type""")
def dist_global(spark, sf_dir):
    small = events(spark, sf_dir).groupBy("event_type").agg(F.count(F.lit(1)).alias("cnt"))
    return dist.with_partition(dist.dist_global(small))


@query("dist_hash_key", """
    SELECT user_id, CAST(1 AS BIGINT) AS parts, CAST(count(*) AS BIGINT) AS cnt FROM events GROUP BY user_id""")
def dist_hash_key(spark, sf_dir):
    spread = dist.with_partition(dist.dist_hash_key(events(spark, sf_dir, "user_id"), N, "user_id"))
    return spread.groupBy("user_id").agg(F.countDistinct("part").alias("parts"), F.count(F.lit(1)).alias("cnt"))


@query("dist_custom", f"""
    SELECT CAST(user_id % {N} AS INTEGER) AS part, CAST(count(*) AS BIGINT) AS "rows" FROM events GROUP BY 1""")
def dist_custom(spark, sf_dir):
    return dist.rows_per_partition(dist.dist_custom(events(spark, sf_dir, "user_id"), N, "user_id"))
