"""Merge semantics for batches of inserted rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from weirflow.operators import merge as ops
from weirflow.operators.aggregate import agg_state_partial
from weirflow.plans.registry import INSERTS_SQL, events, inserts, query

PART, KEY = ["event_type"], ["user_id"]
COLS = ["event_type", "user_id", "k", "cents", "_seq"]


def _rows(spark, sf_dir, *extra):
    return inserts(spark, sf_dir).select(*COLS, *extra)


def _last_sql(order: str, by: str) -> str:
    return f"""
    WITH {INSERTS_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY event_type, {by} ORDER BY {order}) AS rn FROM inserts)
    SELECT event_type, user_id, k, cents, _seq FROM r WHERE rn = 1"""


@query("replacing_latest", _last_sql("_seq DESC", "user_id"))
def replacing_latest(spark, sf_dir):
    return ops.replacing_latest(_rows(spark, sf_dir), PART, KEY, "_seq")


@query("replacing_by_version", _last_sql("k DESC, _seq DESC", "user_id"))
def replacing_by_version(spark, sf_dir):
    return ops.replacing_by_version(_rows(spark, sf_dir), PART, KEY, "k", "_seq")


@query("replacing_composite_key", _last_sql("cents DESC, _seq DESC", "user_id, k"))
def replacing_composite_key(spark, sf_dir):
    return ops.replacing_composite_key(_rows(spark, sf_dir), PART, ["user_id", "k"], "cents", "_seq")


@query("summing_all_numeric", f"""
    WITH {INSERTS_SQL} SELECT event_type, user_id, CAST(sum(k) AS BIGINT) AS k, CAST(sum(cents) AS BIGINT) AS cents,
      min(_seq) AS _seq, arg_min('n' || CAST(k AS VARCHAR), _seq) AS note FROM inserts GROUP BY 1, 2""")
def summing_all_numeric(spark, sf_dir):
    rows = _rows(spark, sf_dir).withColumn("note", F.concat(F.lit("n"), F.col("k").cast("string")))
    return ops.summing_all_numeric(rows, PART, KEY, "_seq")


@query("summing_columns", f"""
    WITH {INSERTS_SQL} SELECT event_type, user_id, arg_min(k, _seq) AS k, CAST(sum(cents) AS BIGINT) AS cents,
      min(_seq) AS _seq FROM inserts GROUP BY 1, 2""")
def summing_columns(spark, sf_dir):
    return ops.summing_columns(_rows(spark, sf_dir), PART, KEY, "_seq", ["cents"])


@query("aggregating_merge", f"""
    WITH {INSERTS_SQL}, s AS (SELECT event_type, user_id, _batch, sum(cents) AS total, sum(k) AS m_s, count(k) AS m_n,
                                    min(_seq) AS _seq, arg_min(k, _seq) AS first_k FROM inserts GROUP BY 1, 2, 3)
    SELECT event_type, user_id, CAST(sum(total) AS BIGINT) AS total, CAST(sum(m_s) AS DOUBLE) / sum(m_n) AS mean,
           arg_min(first_k, _seq) AS first_k FROM s GROUP BY 1, 2""")
def aggregating_merge(spark, sf_dir):
    rows = inserts(spark, sf_dir)
    kinds = {"total": ("sum", "cents"), "mean": ("avg", "k"), "_seq": ("min", "_seq")}
    stored = agg_state_partial(rows, ["_batch", *PART, *KEY], kinds)
    firsts = rows.groupBy("_batch", *PART, *KEY).agg(F.min_by("k", "_seq").alias("first_k"))
    stored = stored.join(firsts, ["_batch", *PART, *KEY]).drop("_batch")
    merged = ops.aggregating_merge(stored, PART, KEY, "_seq", {"total": "sum", "mean": "avg"})
    return merged.select(*PART, *KEY, "total", (F.col("mean_s").cast("double") / F.col("mean_n")).alias("mean"), "first_k")


@query("collapsing", f"""
    WITH {INSERTS_SQL}, g AS (SELECT event_type, user_id, count(*) FILTER (sign = 1) AS p, count(*) FILTER (sign = -1) AS n,
      arg_max(sign, _seq) AS last_sign, min(_seq) FILTER (sign = -1) AS fm, max(_seq) FILTER (sign = 1) AS lp FROM inserts GROUP BY 1, 2)
    SELECT i.event_type, i.user_id, i.k, i.cents, i._seq, i.sign FROM inserts i JOIN g USING (event_type, user_id)
    WHERE (n > p AND _seq = fm) OR (p > n AND _seq = lp) OR (p = n AND last_sign = 1 AND (_seq = fm OR _seq = lp))""")
def collapsing(spark, sf_dir):
    return ops.collapsing(_rows(spark, sf_dir, "sign"), PART, KEY, "sign", "_seq")


@query("versioned_collapsing", f"""
    WITH {INSERTS_SQL}, v AS (SELECT *, k % 3 AS ver FROM inserts),
    g AS (SELECT event_type, user_id, ver, sum(sign) AS net FROM v GROUP BY 1, 2, 3),
    r AS (SELECT v.*, net, row_number() OVER (PARTITION BY event_type, user_id, ver, sign ORDER BY _seq) AS up,
            row_number() OVER (PARTITION BY event_type, user_id, ver, sign ORDER BY _seq DESC) AS down
          FROM v JOIN g USING (event_type, user_id, ver))
    SELECT event_type, user_id, k, cents, _seq, sign, ver FROM r WHERE (net > 0 AND sign = 1 AND down <= net) OR (net < 0 AND sign = -1 AND up <= -net)""")
def versioned_collapsing(spark, sf_dir):
    rows = _rows(spark, sf_dir, "sign").withColumn("ver", F.col("k") % 3)
    return ops.versioned_collapsing(rows, PART, KEY, "sign", "ver", "_seq")


@query("union_tables_regex", """
    SELECT event_id, event_type FROM events WHERE event_type IN ('click', 'view')""")
def union_tables_regex(spark, sf_dir):
    df = events(spark, sf_dir, "event_id", "event_type")
    for t in ("click", "view", "error"):
        df.where(F.col("event_type") == t).createOrReplaceTempView(f"wf_log_{t}")
    return ops.union_tables_regex(spark, "wf_log_(click|view)")
