"""Partitioned-table maintenance; every query builds its own table under the scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from weirflow.operators import maintenance as ops
from weirflow.operators.merge import replacing_latest
from weirflow.plans.registry import INSERTS_SQL, events, inserts, query
from weirflow.session import load, scratch_path

COLS = ["user_id", "k", "cents", "_seq", "event_type"]


def _table(spark, df, partition="event_type", order=("user_id",)):
    name = f"wf_t_{uuid.uuid4().hex}"
    ops.create_partitioned(df, name, scratch_path(spark, "table"), partition, list(order))
    return name


def _rows(spark, sf_dir):
    return inserts(spark, sf_dir).select(*COLS)


ROWS = f"WITH {INSERTS_SQL} SELECT user_id, k, cents, _seq, event_type FROM inserts"


@query("partition_by_month", """
    SELECT o_orderkey, o_custkey, o_orderdate, strftime(o_orderdate, '%Y%m') AS yyyymm FROM orders""")
def partition_by_month(spark, sf_dir):
    df = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    name = _table(spark, ops.with_month(df, "o_orderdate"), "yyyymm", ["o_orderkey"])
    return spark.table(name).withColumn("yyyymm", F.col("yyyymm").cast("string"))


@query("partition_by_value", ROWS)
def partition_by_value(spark, sf_dir):
    return spark.table(_table(spark, _rows(spark, sf_dir))).select(*COLS)


@query("list_parts", """
    SELECT event_type AS "partition", TRUE AS active, CAST(count(*) AS BIGINT) AS "rows" FROM events GROUP BY 1""")
def list_parts(spark, sf_dir):
    parts = ops.list_parts(spark, _table(spark, _rows(spark, sf_dir)), "event_type")
    return parts.groupBy("partition", "active").agg(F.sum("rows").alias("rows"))


@query("compact", f"""
    WITH {INSERTS_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY event_type, user_id ORDER BY _seq DESC) AS rn FROM inserts)
    SELECT user_id, k, cents, _seq, event_type FROM r WHERE rn = 1 OR event_type <> 'click'""")
def compact(spark, sf_dir):
    rows = _rows(spark, sf_dir)
    name = _table(spark, rows.where("_seq % 2 = 0"))
    ops.insert(rows.where("_seq % 2 = 1"), name)
    ops.compact(spark, name, "event_type", ["user_id"], "click", lambda d: replacing_latest(d, ["event_type"], ["user_id"], "_seq"))
    ops.compact(spark, name, "event_type", ["user_id"])
    return spark.table(name).select(*COLS)


@query("detach_attach_partition", f"""
    SELECT 'detached' AS state, user_id, _seq, event_type FROM ({ROWS}) WHERE event_type <> 'view'
    UNION ALL SELECT 'attached', user_id, _seq, event_type FROM ({ROWS})""")
def detach_attach_partition(spark, sf_dir):
    name = _table(spark, _rows(spark, sf_dir))
    cols = ["user_id", "_seq", "event_type"]
    ops.detach_partition(spark, name, "event_type", "view")
    without = scratch_path(spark, "detached-copy")
    spark.table(name).select(F.lit("detached").alias("state"), *cols).write.parquet(without)
    ops.attach_partition(spark, name, "event_type", "view")
    return spark.read.parquet(without).unionByName(spark.table(name).select(F.lit("attached").alias("state"), *cols))


@query("drop_partition", f"{ROWS} WHERE event_type <> 'error'")
def drop_partition(spark, sf_dir):
    name = _table(spark, _rows(spark, sf_dir))
    ops.drop_partition(spark, name, "event_type", "error")
    return spark.table(name).select(*COLS)


@query("replace_partition_from", f"""
    WITH {INSERTS_SQL} SELECT user_id, CASE WHEN event_type = 'click' THEN k + 1000 ELSE k END AS k, cents, _seq, event_type FROM inserts""")
def replace_partition_from(spark, sf_dir):
    rows = _rows(spark, sf_dir)
    name = _table(spark, rows)
    other = _table(spark, rows.withColumn("k", F.col("k") + 1000))
    ops.replace_partition_from(spark, name, other, "event_type", "click", ["user_id"])
    return spark.table(name).select(*COLS)


@query("mutate_update", f"""
    WITH {INSERTS_SQL} SELECT user_id, CASE WHEN k < 10 AND event_type = 'purchase' THEN -1 ELSE k END AS k, cents, _seq, event_type FROM inserts""")
def mutate_update(spark, sf_dir):
    name = _table(spark, _rows(spark, sf_dir))
    where = (F.col("k") < 10) & (F.col("event_type") == "purchase")
    ops.mutate_update(spark, name, "event_type", ["user_id"], {"k": F.lit(-1).cast("bigint")}, where)
    return spark.table(name).select(*COLS)


@query("mutate_delete", f"{ROWS} WHERE NOT (k < 50 AND event_type = 'purchase') AND event_type <> 'signup'")
def mutate_delete(spark, sf_dir):
    name = _table(spark, _rows(spark, sf_dir))
    where = ((F.col("k") < 50) & (F.col("event_type") == "purchase")) | (F.col("event_type") == "signup")
    ops.mutate_delete(spark, name, "event_type", ["user_id"], where)
    return spark.table(name).select(*COLS)


@query("evolve_columns", f"""
    WITH {INSERTS_SQL} SELECT user_id, cents, _seq, event_type, 'none' AS loc, 'seconds' AS seq_comment FROM inserts""")
def evolve_columns(spark, sf_dir):
    name = _table(spark, _rows(spark, sf_dir))
    ops.add_column(spark, name, "loc", "string", "'none'")
    ops.add_column(spark, name, "spare", "string", "'x'")
    ops.drop_column(spark, name, "k", "event_type")
    ops.drop_column(spark, name, "spare", "event_type")
    ops.comment_column(spark, name, "_seq", "seconds")
    ops.rename_table(spark, name, f"{name}_new")
    comment = [c.description for c in spark.catalog.listColumns(f"{name}_new") if c.name == "_seq"][0]
    return spark.table(f"{name}_new").select("user_id", "cents", "_seq", "event_type", "loc", F.lit(comment).alias("seq_comment"))


@query("clear_column_in_partition", f"""
    WITH {INSERTS_SQL} SELECT user_id, CASE WHEN event_type = 'error' THEN NULL ELSE k END AS k, cents, _seq, event_type FROM inserts""")
def clear_column_in_partition(spark, sf_dir):
    name = _table(spark, _rows(spark, sf_dir))
    ops.clear_column_in_partition(spark, name, "event_type", "error", "k", ["user_id"])
    return spark.table(name).select(*COLS)


@query("ttl_expire", """
    SELECT event_id, CASE WHEN ts + INTERVAL 7 DAY > TIMESTAMP '2024-01-25 00:00:00' THEN event_type ELSE '' END AS event_type
    FROM events WHERE ts + INTERVAL 14 DAY > TIMESTAMP '2024-01-25 00:00:00'""")
def ttl_expire(spark, sf_dir):
    as_of = F.expr("TIMESTAMP_NTZ '2024-01-25 00:00:00'")
    out = ops.ttl_expire(
        events(spark, sf_dir, "event_id", "ts", "event_type"), "ts", as_of,
        row_ttl=F.expr("INTERVAL 14 DAYS"), column_ttl={"event_type": (F.expr("INTERVAL 7 DAYS"), "")},
    )
    return out.drop("ts")


@query("sample_by_hash", """
    SELECT event_id, user_id FROM events WHERE CAST('0x' || left(md5(CAST(user_id AS VARCHAR)), 8) AS BIGINT) % 10 < 3""")
def sample_by_hash(spark, sf_dir):
    return ops.sample_by_hash(events(spark, sf_dir, "event_id", "user_id"), "user_id", 10, 3)


@query("key_range_read", """
    SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey >= 1000 AND o_orderkey < 5000""")
def key_range_read(spark, sf_dir):
    path = scratch_path(spark, "sorted")
    ops.write_sorted(load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), path, "o_orderkey")
    return ops.key_range_read(spark, path, "o_orderkey", 1000, 5000)
