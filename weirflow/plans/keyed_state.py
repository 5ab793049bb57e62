"""Keyed state, timers and de-duplication with expiry."""

from __future__ import annotations

from pyspark.sql import functions as F

from weirflow.operators import state as ops
from weirflow.operators.aggregate import running_count_by_key
from weirflow.plans.aggregates import event_stream
from weirflow.plans.registry import INSERTS_SQL, events, inserts, query
from weirflow.session import load, scratch_path
from weirflow.sources.files import stream_parquet
from weirflow.streaming.pipelines import RunningTotals, checkpointed_query, event_time_counts, for_each_batch

DAY = 86400

JUMP_SQL = f"""
    WITH {INSERTS_SQL}, p AS (SELECT *, lag(k) OVER (PARTITION BY user_id ORDER BY _seq) AS prev FROM inserts)
    SELECT _seq, CASE WHEN k - prev > 30 THEN CAST(user_id AS VARCHAR) || ' over speed: ' || CAST(k AS VARCHAR)
                      ELSE CAST(user_id AS VARCHAR) END AS message FROM p"""


@query("speed_jump_alert", JUMP_SQL)
def speed_jump_alert(spark, sf_dir):
    return ops.speed_jump_alert(inserts(spark, sf_dir), "user_id", "k", ["_seq"]).select("_seq", "message")


@query("trajectory_list", """
    SELECT user_id, event_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS BIGINT) AS pos, event_type, ts FROM events""")
def trajectory_list(spark, sf_dir):
    return ops.trajectory_steps(events(spark, sf_dir), "user_id", ["event_id"], ["event_type", "ts"])


@query("running_sum_state", f"""
    WITH {INSERTS_SQL} SELECT user_id, _seq, CAST(sum(cents) OVER (PARTITION BY user_id ORDER BY _seq) AS BIGINT) AS total FROM inserts""")
def running_sum_state(spark, sf_dir):
    df = inserts(spark, sf_dir).select("user_id", "_seq", "cents")
    return ops.running_sum_state(df, ["user_id"], "cents", ["_seq"]).drop("cents")


@query("overspeed_timer_alert", """
    SELECT DISTINCT user_id, ts + INTERVAL 2 SECOND AS fire_ts FROM events WHERE value > 100""")
def overspeed_timer_alert(spark, sf_dir):
    return ops.overspeed_timer_alert(events(spark, sf_dir, "user_id", "value", "ts"), "user_id", "value", "ts")


EPOCHS_SQL = """
    p AS (SELECT *, lag(ts) OVER w AS prev FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    e AS (SELECT *, sum(CASE WHEN prev IS NULL OR ts - prev >= INTERVAL {ttl} SECOND THEN 1 ELSE 0 END)
          OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS epoch FROM p)"""


@query("state_ttl_counter", f"""
    WITH {EPOCHS_SQL.format(ttl=DAY // 2)}
    SELECT user_id, event_id, CAST(row_number() OVER (PARTITION BY user_id, epoch ORDER BY ts, event_id) AS BIGINT) AS cnt FROM e""")
def state_ttl_counter(spark, sf_dir):
    df = events(spark, sf_dir, "user_id", "event_id", "ts")
    return ops.state_ttl_counter(df, ["user_id"], "ts", ["event_id"], DAY // 2).drop("ts")


@query("dedup_first_seen", """
    SELECT user_id, min(event_id) AS event_id FROM events GROUP BY user_id""")
def dedup_first_seen(spark, sf_dir):
    return ops.dedup_first_seen(events(spark, sf_dir, "user_id", "event_id"), ["user_id"], ["event_id"])


@query("dedup_first_seen_ttl", """
    WITH RECURSIVE r AS (SELECT user_id, event_id, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events),
    chain(user_id, event_id, n, last_ts, emit) AS (
      SELECT user_id, event_id, n, ts, TRUE FROM r WHERE n = 1
      UNION ALL
      SELECT r.user_id, r.event_id, r.n, CASE WHEN r.ts - c.last_ts >= INTERVAL 86400 SECOND THEN r.ts ELSE c.last_ts END,
             r.ts - c.last_ts >= INTERVAL 86400 SECOND
      FROM chain c JOIN r ON r.user_id = c.user_id AND r.n = c.n + 1)
    SELECT user_id, event_id FROM chain WHERE emit""")
def dedup_first_seen_ttl(spark, sf_dir):
    df = events(spark, sf_dir, "user_id", "event_id", "ts")
    return ops.dedup_first_seen_ttl(df, ["user_id"], "ts", ["event_id"], DAY).select("user_id", "event_id")


@query("dedup_with_dup_count", f"""
    WITH {EPOCHS_SQL.format(ttl=DAY // 2)}
    SELECT user_id, min(event_id) AS event_id, min(ts) AS ts, CAST(count(*) AS BIGINT) AS dup_count FROM e GROUP BY user_id, epoch""")
def dedup_with_dup_count(spark, sf_dir):
    df = events(spark, sf_dir, "user_id", "event_id", "ts")
    return ops.dedup_with_dup_count(df, ["user_id"], "ts", ["event_id"], DAY // 2)


def trade_messages(spark, sf_dir):
    """Orders as trade messages; every third message is sent twice more."""
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cent"))
    body = F.to_json(F.struct(
        F.col("o_orderkey").cast("string").alias("orderId"), F.col("o_custkey").alias("userId"), F.lit(1.0).alias("totalQty"),
        F.struct(F.col("cent").alias("cent")).alias("orderTotal")))
    copies = F.when(F.col("o_orderkey") % 3 == 0, F.sequence(F.lit(0), F.lit(2))).otherwise(F.array(F.lit(0)))
    return o.select(F.col("o_orderkey").cast("string").alias("key"), body.alias("value"), F.explode(copies).alias("copy"), "o_orderkey")


TRADE_SCHEMA = "orderId string, userId bigint, totalQty double, orderTotal struct<cent: bigint>"


def _parsed_trades(messages):
    j = messages.withColumn("j", F.from_json("value", TRADE_SCHEMA))
    seq = F.col("o_orderkey") * 3 + F.col("copy")
    return j.select("key", seq.alias("seq"), F.col("j.userId").alias("user_id"), F.col("j.totalQty").cast("bigint").alias("qty"), F.col("j.orderTotal.cent").alias("cent"))


TRADE_SQL = """
    SELECT o_custkey AS user_id, CAST(count(*) AS BIGINT) AS total_qty,
           CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS total_cent FROM orders GROUP BY 1"""


@query("trade_totals", TRADE_SQL)
def trade_totals(spark, sf_dir):
    return ops.trade_totals(_parsed_trades(trade_messages(spark, sf_dir)), "key", ["seq"], "user_id", "qty", "cent")


@query("trade_totals_stream", TRADE_SQL)
def trade_totals_stream(spark, sf_dir):
    path = scratch_path(spark, "trades")
    _parsed_trades(trade_messages(spark, sf_dir)).write.parquet(path)
    stream = stream_parquet(spark, path, "key string, seq bigint, user_id bigint, qty bigint, cent bigint")
    totals = RunningTotals(spark, scratch_path(spark, "totals"), ["user_id"], {"total_qty": F.col("qty"), "total_cent": F.col("cent")})
    for_each_batch(stream.dropDuplicates(["key"]), totals.handle, scratch_path(spark, "totals-checkpoint")).awaitTermination()
    return totals.totals()


@query("checkpointed_query", """
    WITH b AS (SELECT event_type, make_timestamp(epoch_us(ts) // 86400000000 * 86400000000) AS window_start FROM events),
    m AS (SELECT max(ts) AS last FROM events)
    SELECT event_type, window_start, CAST(count(*) AS BIGINT) AS cnt FROM b, m
    WHERE window_start + INTERVAL 1 DAY <= last GROUP BY 1, 2""")
def checkpointed(spark, sf_dir):
    stream = event_stream(spark, sf_dir, ["ts", "event_id"]).select("ts", "event_type")
    counts = event_time_counts(stream, "ts", "0 seconds", "1 day", ["event_type"])
    target, checkpoint = scratch_path(spark, "counts"), scratch_path(spark, "counts-checkpoint")
    for _ in range(2):  # stop and start again from the same checkpoint: nothing is repeated
        checkpointed_query(counts, target, checkpoint).awaitTermination()
    out = spark.read.schema(counts.schema).parquet(target)
    return out.select("event_type", F.col("window_start").cast("timestamp_ntz").alias("window_start"), "cnt")


@query("running_count_after_restart", """
    SELECT user_id, event_id, CAST(count(*) OVER (PARTITION BY user_id ORDER BY event_id) AS BIGINT) AS cnt FROM events""")
def running_count_restored(spark, sf_dir):
    """Counts of a second part go on from the stored counts of the first one."""
    df = events(spark, sf_dir, "user_id", "event_id")
    cut = df.agg(F.percentile_approx("event_id", 0.5)).first()[0]
    first, second = df.where(F.col("event_id") <= cut), df.where(F.col("event_id") > cut)
    path = scratch_path(spark, "stored-counts")
    first.groupBy("user_id").agg(F.count(F.lit(1)).alias("stored")).write.parquet(path)
    resumed = running_count_by_key(second, ["user_id"], ["event_id"]).join(spark.read.parquet(path), "user_id", "left")
    resumed = resumed.select("user_id", "event_id", (F.col("cnt") + F.coalesce("stored", F.lit(0))).alias("cnt"))
    return running_count_by_key(first, ["user_id"], ["event_id"]).unionByName(resumed)
