"""Watermarks and late data on events that arrive out of order."""

from __future__ import annotations

from pyspark.sql import functions as F

from weirflow.operators import eventtime as ops
from weirflow.plans.aggregates import event_stream
from weirflow.plans.registry import ARRIVAL_SQL, arrival, bucket_sql, events, query
from weirflow.session import scratch_path
from weirflow.streaming.pipelines import LateRouter, RefiringWindows

# sizes for rows minutes apart: 1 h windows, 30 min delay, 1 h lateness
SIZE_S, DELAY_S, LATE_S = 3600, 1800, 3600
ORDER = ["arrival", "event_id"]
BEFORE = "ORDER BY arrival, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
UPTO = "ORDER BY arrival, event_id ROWS UNBOUNDED PRECEDING"


def arrived(spark, sf_dir):
    return events(spark, sf_dir, "event_id", "ts", "user_id", "event_type").withColumn("arrival", arrival())


def _trace_sql(wm: str, wm_after: str) -> str:
    return f"""
    a AS (SELECT event_id, ts, user_id, event_type, {ARRIVAL_SQL} AS arrival FROM events),
    m AS (SELECT *, max(ts) OVER ({UPTO}) AS seen FROM a),
    t AS (SELECT *, {bucket_sql('ts', SIZE_S)} AS window_start, {bucket_sql('ts', SIZE_S)} + INTERVAL {SIZE_S} SECOND AS window_end,
          {wm} AS wm, {wm_after} AS wm_after FROM m)"""


def _bounded(delay: int) -> str:
    return _trace_sql(f"max(ts) OVER ({BEFORE}) - INTERVAL {delay} SECOND", f"max(ts) OVER ({UPTO}) - INTERVAL {delay} SECOND")


def _cls_sql(lateness: int) -> str:
    return f"""CASE WHEN window_end + INTERVAL {lateness} SECOND <= wm THEN 'too_late'
                    WHEN window_end <= wm THEN 'refire' ELSE 'on_time' END"""


FIRED_SQL = f"""
    SELECT event_type, window_start, window_end, CAST(count(*) AS BIGINT) AS cnt FROM t
    WHERE {_cls_sql(0)} = 'on_time' AND window_end <= (SELECT max(wm_after) FROM t) GROUP BY 1, 2, 3"""


def _bounded_trace(spark, sf_dir, delay):
    return ops.assign_window(ops.bounded_watermark(arrived(spark, sf_dir), "ts", ORDER, delay), "ts", "1 hour")


def _final(spark, sf_dir, delay):
    return ops.final_watermark(events(spark, sf_dir, "ts"), "ts", delay)


@query("event_time_window_count", f"WITH {_bounded(0)} {FIRED_SQL}")
def event_time_window_count(spark, sf_dir):
    return ops.fired_window_counts(_bounded_trace(spark, sf_dir, 0), ["event_type"], _final(spark, sf_dir, 0))


@query("bounded_out_of_order_window", f"WITH {_bounded(DELAY_S)} {FIRED_SQL}")
def bounded_out_of_order_window(spark, sf_dir):
    return ops.fired_window_counts(_bounded_trace(spark, sf_dir, DELAY_S), ["event_type"], _final(spark, sf_dir, DELAY_S))


PUNCT = _trace_sql(
    f"max(CASE WHEN event_type = 'signup' THEN seen - INTERVAL {DELAY_S} SECOND END) OVER ({BEFORE})",
    f"max(CASE WHEN event_type = 'signup' THEN seen - INTERVAL {DELAY_S} SECOND END) OVER ({UPTO})",
)


@query("punctuated_watermark", f"WITH {PUNCT} SELECT event_id, window_start, wm, {_cls_sql(0)} AS cls FROM t")
def punctuated_watermark(spark, sf_dir):
    trace = ops.punctuated_watermark(arrived(spark, sf_dir), "ts", ORDER, F.col("event_type") == "signup", DELAY_S)
    return ops.classify(ops.assign_window(trace, "ts", "1 hour")).select("event_id", "window_start", "wm", "cls")


@query("punctuated_watermark_stream", f"WITH {PUNCT} SELECT event_id, {_cls_sql(0)} AS cls FROM t")
def punctuated_watermark_stream(spark, sf_dir):
    return _routed(spark, sf_dir, 0, F.col("event_type") == "signup").select("event_id", "cls")


def _routed(spark, sf_dir, lateness_s, marker=None):
    stream = event_stream(spark, sf_dir, ORDER)
    router = LateRouter(spark, scratch_path(spark, "routed"), "ts", ORDER, "1 hour", DELAY_S, lateness_s, marker)
    router.attach(stream, scratch_path(spark, "routed-checkpoint")).awaitTermination()
    return router.rows()


QUEUES = [0, 1, 2, 3]


def _queues_sql(frame: str) -> str:
    cols = ", ".join(f"max(CASE WHEN user_id % 4 = {q} THEN ts END) OVER ({frame})" for q in QUEUES)
    return f"least({cols}) - INTERVAL {DELAY_S} SECOND"


@query("per_partition_watermark", f"""
    WITH {_trace_sql(_queues_sql(BEFORE), _queues_sql(UPTO))} SELECT event_id, wm, {_cls_sql(0)} AS cls FROM t""")
def per_partition_watermark(spark, sf_dir):
    df = arrived(spark, sf_dir).withColumn("queue", F.col("user_id") % 4)
    trace = ops.per_partition_watermark(df, "ts", ORDER, "queue", DELAY_S, QUEUES)
    return ops.classify(ops.assign_window(trace, "ts", "1 hour")).select("event_id", "wm", "cls")


LAG_TS_SQL = "ts + INTERVAL (((event_id * 7919) % 50) * 3) MINUTE"


@query("time_lag_watermark", f"""
    WITH t AS (SELECT event_id, {bucket_sql('ts', SIZE_S)} + INTERVAL 1 HOUR AS window_end,
                      {LAG_TS_SQL} - INTERVAL {DELAY_S} SECOND AS wm FROM events)
    SELECT event_id, wm, {_cls_sql(0)} AS cls FROM t""")
def time_lag_watermark(spark, sf_dir):
    minutes = (F.col("event_id") * 7919) % 50 * 3
    df = arrived(spark, sf_dir).withColumn("ingest_ts", F.col("ts") + F.make_dt_interval(mins=minutes.cast("int")))
    trace = ops.time_lag_watermark(df, "ingest_ts", DELAY_S)
    return ops.classify(ops.assign_window(trace, "ts", "1 hour")).select("event_id", "wm", "cls")


REFIRE_SQL = f"""
    WITH {_bounded(DELAY_S)},
    c AS (SELECT *, {_cls_sql(LATE_S)} AS cls FROM t),
    n AS (SELECT *, count(*) OVER (PARTITION BY event_type, window_start ORDER BY arrival, event_id) AS cnt FROM c
          WHERE cls <> 'too_late' AND window_end <= (SELECT max(wm_after) FROM t))
    SELECT event_type, window_start, window_end, CAST(max(cnt) AS BIGINT) AS cnt, 'on_time' AS cls FROM n WHERE cls = 'on_time' GROUP BY 1, 2, 3
    UNION ALL SELECT event_type, window_start, window_end, CAST(cnt AS BIGINT), cls FROM n WHERE cls = 'refire'"""


@query("allowed_lateness_refire", REFIRE_SQL)
def allowed_lateness_refire(spark, sf_dir):
    return ops.allowed_lateness_refire(_bounded_trace(spark, sf_dir, DELAY_S), ["event_type"], ORDER, LATE_S, _final(spark, sf_dir, DELAY_S))


@query("allowed_lateness_refire_stream", REFIRE_SQL)
def allowed_lateness_refire_stream(spark, sf_dir):
    windows = RefiringWindows(spark, scratch_path(spark, "refired"), "ts", ["event_type"], ORDER, "1 hour", DELAY_S, LATE_S)
    windows.attach(event_stream(spark, sf_dir, ORDER), scratch_path(spark, "refired-checkpoint")).awaitTermination()
    return windows.firings().withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


LATE_SQL = f"WITH {_bounded(DELAY_S)} SELECT event_id, window_start FROM t WHERE {_cls_sql(LATE_S)} = 'too_late'"


@query("late_side_output", LATE_SQL)
def late_side_output(spark, sf_dir):
    return ops.late_side_output(_bounded_trace(spark, sf_dir, DELAY_S), LATE_S).select("event_id", "window_start")


@query("late_side_output_stream", LATE_SQL)
def late_side_output_stream(spark, sf_dir):
    late = _routed(spark, sf_dir, LATE_S).where("cls = 'too_late'")
    return late.select("event_id", F.col("window_start").cast("timestamp_ntz").alias("window_start"))


@query("late_drop_default", f"""
    WITH {_bounded(DELAY_S)} SELECT event_type, window_start, CAST(count(*) AS BIGINT) AS cnt FROM t
    WHERE {_cls_sql(0)} = 'on_time' GROUP BY 1, 2""")
def late_drop_default(spark, sf_dir):
    kept = ops.late_drop(_bounded_trace(spark, sf_dir, DELAY_S))
    return kept.groupBy("event_type", "window_start").agg(F.count(F.lit(1)).alias("cnt"))
