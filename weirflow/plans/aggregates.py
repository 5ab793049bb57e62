"""Keyed aggregations, running values, change logs, mergeable states and integer sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from weirflow.operators import aggregate as ops
from weirflow.plans.registry import INSERTS_SQL, arrival, events, inserts, query
from weirflow.session import load, scratch_path
from weirflow.streaming import processors
from weirflow.streaming.pipelines import run_to_keys, run_to_table, count_changes
from weirflow.sources.files import replay_in_order, stream_parquet

WORD_COUNT_SQL = """
    WITH t AS (SELECT text, rtrim(text, ' ') AS r FROM documents),
    w AS (SELECT unnest(string_split(r, ' ')) AS word FROM t WHERE NOT (r = '' AND text <> ''))
    SELECT word, CAST(count(*) AS BIGINT) AS cnt FROM w GROUP BY word"""


@query("word_count", WORD_COUNT_SQL)
def word_count(spark, sf_dir):
    return ops.word_count(load(spark, sf_dir, "documents"), "text")


RUNNING_COUNT_SQL = """
    SELECT user_id, event_id, CAST(count(*) OVER (PARTITION BY user_id ORDER BY event_id) AS BIGINT) AS cnt FROM events"""


@query("running_count_by_key", RUNNING_COUNT_SQL)
def running_count_by_key(spark, sf_dir):
    return ops.running_count_by_key(events(spark, sf_dir, "user_id", "event_id"), ["user_id"], ["event_id"])


def event_stream(spark, sf_dir, order=("event_id",), last=None):
    """The events as a stream in ``order``, several micro-batches, with a timestamp that accepts watermarks.

    Results that depend on the order of rows must not depend on how the table is split into files.  ``last`` holds rows
    that follow all others in that order.
    """
    df = events(spark, sf_dir).withColumn("arrival", arrival())
    df = df.unionByName(last, allowMissingColumns=True) if last is not None else df
    path = replay_in_order(df, order, scratch_path(spark, "replay"))
    return stream_parquet(spark, path, df.schema, 1).withColumn("ts", F.col("ts").cast("timestamp"))


@query("running_count_by_key_stream", RUNNING_COUNT_SQL)
def running_count_by_key_stream(spark, sf_dir):
    return run_to_table(processors.running_count_stream(event_stream(spark, sf_dir), ["user_id"], "event_id"))


@query("running_count_updates_stream", """
    SELECT event_type, CAST(count(*) AS BIGINT) AS cnt FROM events GROUP BY event_type""")
def running_count_updates_stream(spark, sf_dir):
    return run_to_keys(count_changes(event_stream(spark, sf_dir), ["event_type"]), ["event_type"])


@query("keyed_reduce", f"""
    WITH {INSERTS_SQL} SELECT event_type, CAST(sum(cents) AS BIGINT) AS total, max(k) AS top,
         arg_min(user_id, _seq) AS first_user FROM inserts GROUP BY event_type""")
def keyed_reduce(spark, sf_dir):
    return ops.keyed_reduce(
        inserts(spark, sf_dir), ["event_type"],
        {"total": F.sum("cents"), "top": F.max("k"), "first_user": F.min_by("user_id", "_seq")},
    )


@query("keyed_fold", f"""
    WITH {INSERTS_SQL} SELECT user_id, CAST(sum(cents) AS BIGINT) AS total FROM inserts GROUP BY user_id""")
def keyed_fold(spark, sf_dir):
    return ops.keyed_fold(inserts(spark, sf_dir), ["user_id"], "cents", lambda old, cur: old + cur, "bigint", "total")


@query("keyed_basic_aggs", f"""
    WITH {INSERTS_SQL} SELECT event_type, CAST(sum(cents) AS BIGINT) AS "sum", min(cents) AS "min", max(cents) AS "max",
      first(user_id ORDER BY cents, _seq) AS min_by_user_id, first(_seq ORDER BY cents, _seq) AS min_by__seq,
      first(user_id ORDER BY cents DESC, _seq) AS max_by_user_id, first(_seq ORDER BY cents DESC, _seq) AS max_by__seq
    FROM inserts GROUP BY event_type""")
def keyed_basic_aggs(spark, sf_dir):
    return ops.keyed_basic_aggs(inserts(spark, sf_dir), ["event_type"], "cents", ["user_id", "_seq"], "_seq")


@query("flow_per_monitor", "SELECT event_type, CAST(count(*) AS BIGINT) AS flow FROM events GROUP BY event_type")
def flow_per_monitor(spark, sf_dir):
    return ops.flow_per_monitor(events(spark, sf_dir, "event_type"), "event_type")


@query("flow_per_monitor_minute", """
    SELECT event_type, strftime(ts, '%Y%m%d%H%M') AS minute, CAST(count(*) AS BIGINT) AS flow FROM events GROUP BY 1, 2""")
def flow_per_monitor_minute(spark, sf_dir):
    return ops.flow_per_monitor_minute(events(spark, sf_dir, "event_type", "ts"), "event_type", "ts")


@query("table_group_agg", """
    SELECT l_returnflag, l_linestatus, CAST(count(*) AS BIGINT) AS cnt, CAST(sum(l_linenumber) AS BIGINT) AS lines
    FROM lineitem GROUP BY 1, 2""")
def table_group_agg(spark, sf_dir):
    return ops.table_group_agg(
        load(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"],
        {"cnt": F.count(F.lit(1)), "lines": F.sum("l_linenumber")},
    )


CHANGELOG_SQL = """
    WITH r AS (SELECT user_id, event_id, CAST(count(*) OVER (PARTITION BY user_id ORDER BY event_id) AS BIGINT) AS v FROM events)
    SELECT user_id, event_id, FALSE AS op, v - 1 AS value FROM r WHERE v > 1
    UNION ALL SELECT user_id, event_id, TRUE, v FROM r"""


@query("retract_changelog", CHANGELOG_SQL)
def retract_changelog(spark, sf_dir):
    return ops.retract_changelog(events(spark, sf_dir, "user_id", "event_id"), ["user_id"], ["event_id"])


@query("retract_changelog_stream", CHANGELOG_SQL)
def retract_changelog_stream(spark, sf_dir):
    return run_to_table(processors.changelog_stream(event_stream(spark, sf_dir), ["user_id"], "event_id"))


@query("udaf_accumulator", f"""
    WITH {INSERTS_SQL} SELECT user_id, CAST(sum(cents) AS BIGINT) AS acc_sum, CAST(count(cents) AS BIGINT) AS acc_cnt,
         CAST(sum(cents) AS DOUBLE) / count(cents) AS avg FROM inserts GROUP BY user_id""")
def udaf_accumulator(spark, sf_dir):
    return ops.udaf_average(inserts(spark, sf_dir), ["user_id"], "cents")


AVERAGE = ops.Accumulator(
    create=lambda: (0, 0),
    add=lambda acc, row: acc if row[0] is None else (acc[0] + int(row[0]), acc[1] + 1),
    merge=lambda a, b: (a[0] + b[0], a[1] + b[1]),
    result=lambda acc: (acc[0], acc[1], acc[0] / acc[1] if acc[1] else None),
)


@query("udaf_user", f"""
    WITH {INSERTS_SQL} SELECT user_id, CAST(sum(cents) AS BIGINT) AS acc_sum, CAST(count(cents) AS BIGINT) AS acc_cnt,
         CAST(sum(cents) AS DOUBLE) / count(cents) AS avg FROM inserts GROUP BY user_id""")
def udaf_user(spark, sf_dir):
    """The average again, as a user's accumulator."""
    return ops.udaf(inserts(spark, sf_dir), ["user_id"], ["cents"], AVERAGE, "acc_sum bigint, acc_cnt bigint, avg double")


@query("keyed_fold_ordered", """
    SELECT user_id, string_agg(event_type, ' > ' ORDER BY event_id) AS folded FROM events GROUP BY user_id""")
def keyed_fold_ordered(spark, sf_dir):
    """Not associative: every step puts the old value before the new one."""
    step = lambda old, cur: cur if old is None else f"{old} > {cur}"
    return ops.ordered_fold(events(spark, sf_dir, "user_id", "event_id", "event_type"), ["user_id"], ["event_id"], "event_type", step, None, "string")


STATES = {"total": ("sum", "cents"), "n": ("count", "cents"), "low": ("min", "cents"), "high": ("max", "cents"), "mean": ("avg", "k")}


@query("agg_state_merge", f"""
    WITH {INSERTS_SQL} SELECT user_id, CAST(sum(cents) AS BIGINT) AS total, CAST(count(cents) AS BIGINT) AS n,
         min(cents) AS low, max(cents) AS high, CAST(sum(k) AS DOUBLE) / count(k) AS mean FROM inserts GROUP BY user_id""")
def agg_state_merge(spark, sf_dir):
    stored = ops.agg_state_partial(inserts(spark, sf_dir), ["_batch", "user_id"], STATES)
    return ops.agg_state_merge(stored, ["user_id"], STATES)


@query("bitmap_distinct", """
    SELECT event_type, CAST(count(DISTINCT user_id) AS BIGINT) AS cardinality FROM events GROUP BY event_type""")
def bitmap_distinct(spark, sf_dir):
    bitmap = ops.bitmap_build(events(spark, sf_dir, "event_type", "user_id"), "user_id", ["event_type"])
    return ops.bitmap_cardinality(bitmap, ["event_type"])


@query("bitmap_or", """
    WITH u AS (SELECT event_id AS v FROM events UNION SELECT user_id FROM events
               UNION SELECT unnest(generate_series(1000000, 1001999)))
    SELECT CAST(count(*) AS BIGINT) AS cardinality FROM u""")
def bitmap_or(spark, sf_dir):
    df = events(spark, sf_dir, "event_type", "event_id", "user_id")
    first = ops.bitmap_build(ops.bitmap_add_range(df, "event_id", 1_000_000, 1_002_000), "event_id")
    second = ops.bitmap_build(df, "user_id")
    return ops.bitmap_cardinality(ops.bitmap_or(first, second))


@query("bitmap_contains", """
    SELECT e.event_id, e.event_id IN (SELECT user_id FROM events) AS present FROM events e""")
def bitmap_contains(spark, sf_dir):
    df = events(spark, sf_dir, "event_type", "event_id", "user_id")
    bitmap = ops.bitmap_build(df, "user_id")
    return ops.bitmap_contains(bitmap, df.select("event_id"), "event_id")


@query("bitmap_rank_select", """
    WITH d AS (SELECT DISTINCT event_type, user_id FROM events)
    SELECT event_type, user_id, CAST(row_number() OVER (PARTITION BY event_type ORDER BY user_id) AS BIGINT) AS rank FROM d""")
def bitmap_rank_select(spark, sf_dir):
    bitmap = ops.bitmap_build(events(spark, sf_dir, "event_type", "user_id"), "user_id", ["event_type"])
    return ops.bitmap_rank_select(bitmap, "user_id", ["event_type"])


@query("bitmap_rank_of", """
    WITH d AS (SELECT DISTINCT event_type, user_id FROM events), o AS (SELECT event_id, event_type, event_id % 2000 AS probe FROM events)
    SELECT event_id, CAST((SELECT count(*) FROM d WHERE d.event_type = o.event_type AND user_id <= probe) AS BIGINT) AS rank,
           (SELECT user_id FROM (SELECT event_type, user_id, row_number() OVER (PARTITION BY event_type ORDER BY user_id) AS r FROM d) s
            WHERE s.event_type = o.event_type AND r = probe + 1) AS selected FROM o""")
def bitmap_rank_of(spark, sf_dir):
    """Rank and element of given numbers in stored bitmaps."""
    df = events(spark, sf_dir)
    bitmap = ops.bitmap_build(df, "user_id", ["event_type"])
    probe = df.select("event_id", "event_type", (F.col("event_id") % 2000).alias("probe"))
    ranked = ops.bitmap_rank(bitmap, probe, "probe", ["event_type"])
    return ops.bitmap_select(bitmap, ranked, "probe", ["event_type"]).select("event_id", "rank", "selected")
