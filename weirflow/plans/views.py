"""Plain and incremental views."""

from __future__ import annotations

from pyspark.sql import functions as F

from weirflow.operators import views as ops
from weirflow.plans.registry import INSERTS_SQL, inserts, query
from weirflow.session import load, scratch_path
from weirflow.sources.files import stream_parquet

AGGS = {"total": ("sum", "cents"), "n": ("count", "cents")}


@query("plain_view", """
    SELECT c_nationkey, CAST(count(c_acctbal) AS BIGINT) AS cnt FROM customer GROUP BY c_nationkey""")
def plain_view(spark, sf_dir):
    load(spark, sf_dir, "customer").createOrReplaceTempView("wf_view_source")
    return ops.plain_view(spark, "wf_view", "SELECT c_nationkey, count(c_acctbal) AS cnt FROM wf_view_source GROUP BY c_nationkey")


@query("incremental_mv_append", f"""
    WITH {INSERTS_SQL} SELECT _batch, user_id, CAST(sum(cents) AS BIGINT) AS total, CAST(count(cents) AS BIGINT) AS n FROM inserts GROUP BY 1, 2""")
def incremental_mv_append(spark, sf_dir):
    return ops.incremental_rows(inserts(spark, sf_dir), "_batch", ["user_id"], AGGS)


MERGED_SQL = f"""
    WITH {INSERTS_SQL} SELECT user_id, CAST(sum(cents) AS BIGINT) AS total, CAST(count(cents) AS BIGINT) AS n FROM inserts GROUP BY 1"""


@query("incremental_mv_merged", MERGED_SQL)
def incremental_mv_merged(spark, sf_dir):
    return ops.incremental_merged(inserts(spark, sf_dir), "_batch", ["user_id"], AGGS)


@query("incremental_mv_merged_stream", MERGED_SQL)
def incremental_mv_merged_stream(spark, sf_dir):
    """View attached to a stream of insert batches; compacted once at the end."""
    path = scratch_path(spark, "inserts")
    inserts(spark, sf_dir).write.parquet(path)
    view = ops.IncrementalView(spark, scratch_path(spark, "view"), ["user_id"], AGGS)
    stream = stream_parquet(spark, path, spark.read.parquet(path).schema, 4)
    view.attach(stream, scratch_path(spark, "view-checkpoint")).awaitTermination()
    return view.compact(scratch_path(spark, "view-compacted")).merged()


@query("mv_populate", f"""
    WITH {INSERTS_SQL} SELECT user_id, CAST(sum(cents) AS BIGINT) AS total, CAST(count(cents) AS BIGINT) AS n
    FROM inserts GROUP BY _seq % 2, user_id""")
def mv_populate(spark, sf_dir):
    rows = inserts(spark, sf_dir)
    view = ops.IncrementalView(spark, scratch_path(spark, "view"), ["user_id"], AGGS)
    view.populate(rows.where("_seq % 2 = 0"))
    view.insert(rows.where("_seq % 2 = 1"), 0)
    return ops.view_rows_without_batch(view)


@query("temp_table", "SELECT o_orderkey, o_custkey FROM orders")
def temp_table(spark, sf_dir):
    df = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return ops.temp_table(df, "wf_temp_orders").select(F.col("o_orderkey"), F.col("o_custkey"))
