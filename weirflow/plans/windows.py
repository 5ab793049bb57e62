"""Time, count and session windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from weirflow.operators import windows as ops
from weirflow.plans.aggregates import event_stream
from weirflow.plans.registry import bucket_sql, events, query, row_count
from weirflow.session import load
from weirflow.streaming import processors
from weirflow.streaming.pipelines import event_time_counts, run_to_keys, run_to_table, sliding_panes_stream, sliding_top_bottom_stream

HOUR = 3600
CENTS_SQL = "CAST(round(value * 100) AS BIGINT)"


def _cents(spark, sf_dir):
    return events(spark, sf_dir).withColumn("cents", F.round(F.col("value") * 100).cast("bigint"))


@query("tumbling_time_keyed", f"""
    SELECT event_type, {bucket_sql('ts', HOUR)} AS window_start, {bucket_sql('ts', HOUR)} + INTERVAL 1 HOUR AS window_end,
           CAST(count(*) AS BIGINT) AS cnt FROM events GROUP BY 1, 2, 3""")
def tumbling_time_keyed(spark, sf_dir):
    return ops.time_window(events(spark, sf_dir, "event_type", "ts"), "ts", "1 hour", {"cnt": row_count()}, ["event_type"])


@query("tumbling_time_keyed_stream", f"""
    SELECT event_type, {bucket_sql('ts', HOUR)} AS window_start, CAST(count(*) AS BIGINT) AS cnt FROM events GROUP BY 1, 2""")
def tumbling_time_keyed_stream(spark, sf_dir):
    counts = event_time_counts(event_stream(spark, sf_dir, ["ts", "event_id"]), "ts", "1 day", "1 hour", ["event_type"])
    out = run_to_keys(counts, ["event_type", "window_start", "window_end"])
    return out.select("event_type", F.col("window_start").cast("timestamp_ntz").alias("window_start"), "cnt")


@query("tumbling_time_all", f"""
    SELECT {bucket_sql('ts', HOUR)} AS window_start, {bucket_sql('ts', HOUR)} + INTERVAL 1 HOUR AS window_end,
           arg_min(event_type, event_id) AS word, CAST(count(*) AS BIGINT) AS total FROM events GROUP BY 1, 2""")
def tumbling_time_all(spark, sf_dir):
    return ops.first_word_and_total(events(spark, sf_dir, "ts", "event_type", "event_id"), "ts", "1 hour", "event_type", "event_id")


def _sliding_sql(select: str, group: str, size: int, slide: int) -> str:
    """All windows of ``size`` seconds, one per ``slide``, that hold a row."""
    s, z = slide * 1_000_000, size * 1_000_000
    return f"""
    WITH x AS (SELECT *, {CENTS_SQL} AS cents,
        unnest(generate_series(epoch_us(ts) // {s} * {s}, epoch_us(ts) // {s} * {s} - {z} + {s}, -{s})) AS w FROM events)
    SELECT {group}, make_timestamp(w) AS window_start, make_timestamp(w + {z}) AS window_end, {select}
    FROM x GROUP BY {group}, w"""


@query("sliding_avg_keyed", _sliding_sql(
    "CAST(sum(cents) AS BIGINT) AS total, CAST(count(*) AS BIGINT) AS cnt, CAST(sum(cents) AS DOUBLE) / count(*) AS avg",
    "user_id", 1800, 600))
def sliding_avg_keyed(spark, sf_dir):
    return ops.sliding_avg(_cents(spark, sf_dir), "ts", "cents", "30 minutes", "10 minutes", ["user_id"])


TOP_BOTTOM_SQL = """
    WITH x AS (SELECT *, unnest(generate_series(epoch_us(ts) // 600000000 * 600000000,
                 epoch_us(ts) // 600000000 * 600000000 - 1200000000, -600000000)) AS w,
               CAST(round(value * 100) AS BIGINT) AS cents FROM events),
    l AS (SELECT w, user_id, arg_max(cents, event_id) AS v FROM x GROUP BY 1, 2)
    SELECT make_timestamp(w) AS window_start, make_timestamp(w + 1800000000) AS window_end,
      first(user_id ORDER BY v DESC, user_id) AS fastest, max(v) AS fastest_value,
      first(user_id ORDER BY v, user_id) AS slowest, min(v) AS slowest_value FROM l GROUP BY w"""


@query("sliding_top_bottom_all", TOP_BOTTOM_SQL)
def sliding_top_bottom_all(spark, sf_dir):
    return ops.sliding_top_bottom(_cents(spark, sf_dir), "ts", "user_id", "cents", "event_id", "30 minutes", "10 minutes")


@query("sliding_word_count", _sliding_sql("CAST(count(*) AS BIGINT) AS cnt", "event_type", 7200, 3600))
def sliding_word_count(spark, sf_dir):
    return ops.sliding_by_panes(
        events(spark, sf_dir, "event_type", "ts"), "ts", "2 hours", "1 hour", {"_n": row_count()}, {"cnt": F.sum("_n")}, ["event_type"]
    )


def count_aggs():
    return {"cnt": row_count(), "total": F.sum("cents"), "first_id": F.min("event_id")}


@query("count_window_keyed", f"""
    WITH x AS (SELECT *, {CENTS_SQL} AS cents, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events)
    SELECT user_id, CAST((n - 1) // 3 AS BIGINT) AS block, CAST(count(*) AS BIGINT) AS cnt, CAST(sum(cents) AS BIGINT) AS total,
           min(event_id) AS first_id FROM x GROUP BY 1, 2 HAVING count(*) = 3""")
def count_window_keyed(spark, sf_dir):
    return ops.count_window(_cents(spark, sf_dir), ["event_id"], 3, count_aggs(), ["user_id"])


@query("count_window_all", """
    WITH x AS (SELECT *, row_number() OVER (ORDER BY event_id) AS n FROM events)
    SELECT CAST((n - 1) // 3 AS BIGINT) AS block, CAST(count(*) AS BIGINT) AS total, arg_min(event_type, n) AS word
    FROM x GROUP BY 1 HAVING count(*) = 3""")
def count_window_all(spark, sf_dir):
    aggs = {"total": row_count(), "word": F.min_by("event_type", "event_id")}
    return ops.count_window(events(spark, sf_dir, "event_id", "event_type"), ["event_id"], 3, aggs)


@query("count_window_sliding", f"""
    WITH x AS (SELECT user_id, event_id, row_number() OVER w AS n,
        sum({CENTS_SQL}) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS total,
        count(*) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS cnt,
        min(event_id) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS first_id
      FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id))
    SELECT user_id, CAST(n // 2 AS BIGINT) AS block, CAST(cnt AS BIGINT) AS cnt, CAST(total AS BIGINT) AS total, first_id
    FROM x WHERE n % 2 = 0""")
def count_window_sliding(spark, sf_dir):
    return ops.count_window(_cents(spark, sf_dir), ["event_id"], 5, count_aggs(), ["user_id"], slide=2)


@query("count_window_sliding_all", """
    WITH x AS (SELECT event_id, row_number() OVER (ORDER BY event_id) AS n,
        count(*) OVER r AS cnt, min(event_id) OVER r AS first_id
      FROM events WINDOW r AS (ORDER BY event_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW))
    SELECT CAST(n // 4 AS BIGINT) AS block, CAST(cnt AS BIGINT) AS cnt, first_id FROM x WHERE n % 4 = 0""")
def count_window_sliding_all(spark, sf_dir):
    partial = {"_n": row_count(), "_first": F.min("event_id")}
    final = {"cnt": F.sum("_n"), "first_id": F.min("_first")}
    return ops.count_window_by_panes(events(spark, sf_dir, "event_id"), ["event_id"], 10, 4, partial, final)


def _cents_stream(spark, sf_dir, order):
    return event_stream(spark, sf_dir, order).withColumn("cents", F.round(F.col("value") * 100).cast("bigint"))


@query("count_window_keyed_stream", f"""
    WITH x AS (SELECT *, {CENTS_SQL} AS cents, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events)
    SELECT user_id, CAST((n - 1) // 3 AS BIGINT) AS block, CAST(count(*) AS BIGINT) AS cnt, CAST(sum(cents) AS BIGINT) AS total,
           min(event_id) AS first_id FROM x GROUP BY 1, 2 HAVING count(*) = 3""")
def count_window_keyed_stream(spark, sf_dir):
    return run_to_table(processors.count_window_stream(_cents_stream(spark, sf_dir, ["event_id"]), ["user_id"], "cents", "event_id", 3))


@query("count_window_sliding_stream", f"""
    WITH x AS (SELECT user_id, event_id, row_number() OVER w AS n,
        sum({CENTS_SQL}) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS total,
        count(*) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS cnt,
        min(event_id) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS first_id
      FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id))
    SELECT user_id, CAST(n // 2 AS BIGINT) AS block, CAST(cnt AS BIGINT) AS cnt, CAST(total AS BIGINT) AS total, first_id
    FROM x WHERE n % 2 = 0""")
def count_window_sliding_stream(spark, sf_dir):
    return run_to_table(processors.count_window_sliding_stream(_cents_stream(spark, sf_dir, ["event_id"]), ["user_id"], "cents", "event_id", 5, 2))


@query("sliding_avg_keyed_stream", _sliding_sql(
    "CAST(sum(cents) AS BIGINT) AS total, CAST(count(*) AS BIGINT) AS cnt", "user_id", 1800, 600))
def sliding_avg_keyed_stream(spark, sf_dir):
    """Panes, then windows of panes; a row three days later closes all windows and stays in one that is open."""
    last = load(spark, sf_dir, "events").agg((F.max("ts") + F.expr("INTERVAL 3 DAYS")).alias("ts"), F.lit(-1).cast("bigint").alias("user_id"))
    rows = event_stream(spark, sf_dir, ["ts", "event_id"], last).withColumn("cents", F.round(F.col("value") * 100).cast("bigint"))
    out = run_to_table(sliding_panes_stream(
        rows, "ts", "0 seconds", "30 minutes", "10 minutes", {"_s": F.sum("cents"), "_n": F.count("cents")}, {"total": F.sum("_s"), "cnt": F.sum("_n")}, ["user_id"]))
    return out.where("user_id >= 0").withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


def _session_sql(key: str, gap_minutes: int, members: bool = False) -> str:
    by = f"PARTITION BY {key}" if key else ""
    head = f"{key}, " if key else ""
    base = f"""
    WITH g AS (SELECT *, CASE WHEN ts - lag(ts) OVER ({by} ORDER BY ts, event_id) <= INTERVAL {gap_minutes} MINUTE THEN 0 ELSE 1 END AS fresh FROM events),
    s AS (SELECT *, sum(fresh) OVER ({by} ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS sid FROM g)"""
    if members:
        over = f"PARTITION BY {head}sid"
        return base + f" SELECT event_id, min(ts) OVER ({over}) AS session_start FROM s"
    return base + f"""
    SELECT {head}min(ts) AS window_start, max(ts) + INTERVAL {gap_minutes} MINUTE AS window_end, CAST(count(*) AS BIGINT) AS cnt,
           min(event_id) AS first_id FROM s GROUP BY {head}sid"""


def session_aggs():
    return {"cnt": row_count(), "first_id": F.min("event_id")}


@query("session_window_all", _session_sql("", 10))
def session_window_all(spark, sf_dir):
    return ops.session_window(events(spark, sf_dir, "ts", "event_id"), "ts", ["event_id"], 600, session_aggs())


@query("session_window_members", _session_sql("", 10, members=True))
def session_window_members(spark, sf_dir):
    return ops.session_ids(events(spark, sf_dir, "ts", "event_id"), "ts", ["event_id"], 600).select("event_id", "session_start")


@query("session_window_keyed", _session_sql("user_id", 720))
def session_window_keyed(spark, sf_dir):
    df = events(spark, sf_dir, "user_id", "ts", "event_id")
    return ops.session_window(df, "ts", ["event_id"], 720 * 60, session_aggs(), ["user_id"])


def _closing(spark, sf_dir, step):
    """A last row that closes all windows before it; its own window stays open and is not emitted."""
    return load(spark, sf_dir, "events").agg((F.max("ts") + F.expr(f"INTERVAL {step}")).alias("ts"), F.lit(-1).cast("bigint").alias("event_id"))


def _naive(df):
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


def session_parts():
    return {"cnt": (row_count(), "sum"), "first_id": (F.min("event_id"), "min")}


@query("session_window_all_stream", _session_sql("", 10))
def session_window_all_stream(spark, sf_dir):
    rows = event_stream(spark, sf_dir, ["ts", "event_id"], _closing(spark, sf_dir, "1 DAY")).select("ts", "event_id")
    return _naive(run_to_table(processors.merged_sessions_stream(rows, "ts", "0 seconds", 600, session_parts())))


@query("session_window_keyed_stream", _session_sql("user_id", 720))
def session_window_keyed_stream(spark, sf_dir):
    rows = event_stream(spark, sf_dir, ["ts", "event_id"], _closing(spark, sf_dir, "3 DAYS")).select("user_id", "ts", "event_id")
    return _naive(run_to_table(processors.merged_sessions_stream(rows, "ts", "0 seconds", 720 * 60, session_parts(), ["user_id"])))


@query("sliding_top_bottom_all_stream", TOP_BOTTOM_SQL)
def sliding_top_bottom_all_stream(spark, sf_dir):
    rows = event_stream(spark, sf_dir, ["ts", "event_id"], _closing(spark, sf_dir, "1 DAY")).withColumn("cents", F.round(F.col("value") * 100).cast("bigint"))
    return _naive(run_to_table(sliding_top_bottom_stream(rows, "ts", "0 seconds", "user_id", "cents", "event_id", "30 minutes", "10 minutes")))
