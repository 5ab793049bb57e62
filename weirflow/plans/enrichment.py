"""Lookups against dimensions."""

from __future__ import annotations

from pyspark.sql import functions as F

from weirflow.operators import enrich as ops
from weirflow.plans.aggregates import event_stream
from weirflow.plans.registry import events, query
from weirflow.session import load, scratch_path
from weirflow.streaming.pipelines import lookup_refreshing, run_to_table
from weirflow.streaming.processors import config_lookup_stream


def _asked(key):
    """Every seventh row asks for a nation that is not there, so that some lookups find nothing."""
    return F.when(F.col(key) % 7 == 0, -1).otherwise(F.col(key) % 25)


LOOKUP_SQL = """
    SELECT c.c_custkey, coalesce(n.n_name, 'not found') AS label
    FROM customer c LEFT JOIN nation n ON CASE WHEN c.c_custkey % 7 = 0 THEN -1 ELSE c.c_custkey % 25 END = n.n_nationkey"""


@query("lookup_static", LOOKUP_SQL)
def lookup_static(spark, sf_dir):
    facts = load(spark, sf_dir, "customer").select("c_custkey", _asked("c_custkey").alias("c_nationkey"))
    out = ops.lookup_static(facts, load(spark, sf_dir, "nation"), "c_nationkey", "n_nationkey", "n_name")
    return out.drop("c_nationkey")


@query("lookup_static_text", LOOKUP_SQL)
def lookup_static_text(spark, sf_dir):
    """The dimension as a shipped text file with zero-padded ids."""
    path = scratch_path(spark, "nations")
    line = F.concat(F.lpad(F.col("n_nationkey").cast("string"), 3, "0"), F.lit(" "), "n_name")
    load(spark, sf_dir, "nation").select(line.alias("value")).write.text(path)
    facts = load(spark, sf_dir, "customer").select("c_custkey", _asked("c_custkey").alias("c_nationkey"))
    return ops.lookup_static(facts, ops.read_dimension(spark, path), "c_nationkey", "id", "label").drop("c_nationkey")


@query("lookup_refreshing", """
    SELECT e.event_id, coalesce(n.n_name, 'not found') AS label
    FROM events e LEFT JOIN nation n ON CASE WHEN e.user_id % 7 = 0 THEN -1 ELSE e.user_id % 25 END = n.n_nationkey""")
def refreshing(spark, sf_dir):
    stream = event_stream(spark, sf_dir).select("event_id", _asked("user_id").alias("nation"))
    target = scratch_path(spark, "looked-up")
    lookup_refreshing(
        stream, lambda: load(spark, sf_dir, "nation"), "nation", "n_nationkey", "n_name", target, scratch_path(spark, "lookup-checkpoint")
    ).awaitTermination()
    return spark.read.option("basePath", target).parquet(f"{target}/batch=*").select("event_id", "label")


def _config(spark, sf_dir):
    """Sign-ups change the label of their user from then on."""
    return events(spark, sf_dir).where("event_type = 'signup'").select(
        F.col("user_id").alias("id"), F.col("event_id").alias("cfg_seq"), F.get_json_object("props", "$.k").alias("city"))


CONFIG_SQL = """
    e AS (SELECT event_id, user_id, CASE WHEN event_type = 'signup' THEN props->>'$.k' END AS city, event_type FROM events),
    r AS (SELECT *, max(CASE WHEN event_type = 'signup' THEN event_id END)
            OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS cfg FROM e)"""


@query("lookup_config_stream", f"""
    WITH {CONFIG_SQL} SELECT r.event_id, coalesce(c.city, 'not found city') AS label
    FROM r LEFT JOIN e c ON c.event_id = r.cfg WHERE r.event_type <> 'signup'""")
def lookup_config_stream(spark, sf_dir):
    asked = events(spark, sf_dir, "event_id", "user_id", "event_type").where("event_type <> 'signup'").drop("event_type")
    out = ops.lookup_config_stream(asked, _config(spark, sf_dir), "user_id", "event_id", "id", "cfg_seq", "city")
    return out.select("event_id", "label")


@query("lookup_config_in_stream", """
    SELECT event_id, label FROM (
      SELECT event_id, event_type, coalesce(nullif(last_value(CASE WHEN event_type = 'signup' THEN props->>'$.k' END IGNORE NULLS)
        OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING), ''), 'not found city') AS label FROM events)
    WHERE event_type <> 'signup'""")
def lookup_config_in_stream(spark, sf_dir):
    """Lookups and configuration in one stream, in event order."""
    rows = event_stream(spark, sf_dir, ["ts", "event_id"]).withColumns(
        {"cfg": F.col("event_type") == "signup", "city": F.get_json_object("props", "$.k")})
    return run_to_table(config_lookup_stream(rows, "user_id", "ts", "event_id", "cfg", "city", "1 day")).select("event_id", "label")


@query("lookup_connected", f"""
    WITH {CONFIG_SQL}
    SELECT 1 AS side, r.event_id AS seq, coalesce(c.city, 'not found') AS answer
    FROM r LEFT JOIN e c ON c.event_id = r.cfg WHERE r.event_type <> 'signup'
    UNION ALL SELECT 2, event_id, CAST(user_id AS VARCHAR) || ' ' || city || '{ops.LOADED}' FROM e WHERE event_type = 'signup'""")
def lookup_connected(spark, sf_dir):
    asked = events(spark, sf_dir, "event_id", "user_id", "event_type").where("event_type <> 'signup'").drop("event_type")
    return ops.lookup_connected(asked, _config(spark, sf_dir), "user_id", "event_id", "id", "cfg_seq", "city")
