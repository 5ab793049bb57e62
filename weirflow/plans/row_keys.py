"""Row-key tables: orders as call records keyed by customer and reversed time."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from weirflow.operators import rowkey as ops
from weirflow.operators.maintenance import write_sorted
from weirflow.plans.aggregates import event_stream
from weirflow.plans.registry import events, query
from weirflow.session import load, scratch_path
from weirflow.sinks.keyvalue import KeyValueTable
from weirflow.sources.files import stream_parquet

COLUMNS = ["order", "price", "status"]

# unique row key: customer, reversed milliseconds, order number
KEY_SQL = """CAST(o_custkey AS VARCHAR) || '-' || lpad(CAST(9223372036854775807 - epoch_us(o_orderdate) // 1000 AS VARCHAR), 19, '0')
             || '-' || CAST(o_orderkey AS VARCHAR)"""
CALLS_SQL = f"""calls AS (SELECT {KEY_SQL} AS rowkey, CAST(o_orderkey AS VARCHAR) AS "order",
    CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS VARCHAR) AS price, o_orderstatus AS status FROM orders)"""
CELLS_SQL = f"""{CALLS_SQL}, cells AS (
    SELECT rowkey, 'order' AS qualifier, "order" AS value FROM calls
    UNION ALL SELECT rowkey, 'price', price FROM calls UNION ALL SELECT rowkey, 'status', status FROM calls)"""


def calls(spark, sf_dir):
    o = load(spark, sf_dir, "orders")
    key = F.concat(ops.reverse_time_rowkey("o_custkey", F.col("o_orderdate")), F.lit("-"), F.col("o_orderkey").cast("string"))
    return o.select(
        key.alias("rowkey"), F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("ts"),
        F.col("o_orderkey").cast("string").alias("order"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").cast("string").alias("price"), F.col("o_orderstatus").alias("status"))


def cells(spark, sf_dir):
    return ops.to_cells(calls(spark, sf_dir), "rowkey", "ts", COLUMNS)


def stored_cells(spark, sf_dir):
    """The cells as a table on disk, laid out by row key, so that a key or range filter skips files and row groups."""
    path = scratch_path(spark, "cells-by-key")
    ops.table_copy(cells(spark, sf_dir), path)
    return spark.read.parquet(path)


def _slim(df):
    return df.select("rowkey", "qualifier", "value")


@query("cells_put", """
    WITH p AS (SELECT CAST(user_id AS VARCHAR) AS rowkey, epoch_us(ts) AS ts, 'type' AS qualifier, event_type AS value FROM events
      UNION ALL SELECT CAST(user_id AS VARCHAR), epoch_us(ts), 'body', props FROM events),
    r AS (SELECT *, row_number() OVER (PARTITION BY rowkey, qualifier ORDER BY ts DESC, value DESC) AS rn FROM p)
    SELECT rowkey, qualifier, ts, value FROM r WHERE rn = 1""")
def cells_put(spark, sf_dir):
    e = events(spark, sf_dir).withColumns({"type": F.col("event_type"), "body": F.col("props")})
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    put = lambda d: ops.to_cells(d, F.col("user_id").cast("string"), at, ["type", "body"])
    table = ops.cells_put(None, put(e.where("event_id % 2 = 0")))
    return ops.cells_put(table, put(e.where("event_id % 2 = 1"))).drop("family")


FIRST_KEY_SQL = "(SELECT min(rowkey) FROM calls)"


@query("row_get", f"WITH {CELLS_SQL} SELECT * FROM cells WHERE rowkey = {FIRST_KEY_SQL}")
def row_get(spark, sf_dir):
    table = stored_cells(spark, sf_dir)
    first = table.agg(F.min("rowkey")).first()[0]
    return _slim(ops.row_get(table, first))


@query("row_get_columns", f"WITH {CELLS_SQL} SELECT * FROM cells WHERE rowkey = {FIRST_KEY_SQL} AND qualifier IN ('price', 'status')")
def row_get_columns(spark, sf_dir):
    table = stored_cells(spark, sf_dir)
    first = table.agg(F.min("rowkey")).first()[0]
    return _slim(ops.row_get(table, first, ["price", "status"]))


@query("scan_prefix", f"WITH {CELLS_SQL} SELECT * FROM cells WHERE starts_with(rowkey, '7-') AND qualifier IN ('order', 'price')")
def scan_prefix(spark, sf_dir):
    return _slim(ops.scan_prefix(stored_cells(spark, sf_dir), "7-", ["order", "price"]))


@query("scan_range", f"WITH {CELLS_SQL} SELECT * FROM cells WHERE rowkey >= '10-' AND rowkey < '12-'")
def scan_range(spark, sf_dir):
    return _slim(ops.scan_range(stored_cells(spark, sf_dir), "10-", "12-"))


@query("scan_filter_list", f"""
    WITH {CALLS_SQL}, w AS (SELECT rowkey, "order", price, CASE WHEN status <> 'P' THEN status END AS status FROM calls)
    SELECT 'all' AS form, * FROM w WHERE starts_with(rowkey, '1') AND coalesce(status = 'F', TRUE)
    UNION ALL SELECT 'one', * FROM w WHERE starts_with(rowkey, '1') OR coalesce(status = 'F', FALSE)""")
def scan_filter_list(spark, sf_dir):
    table = cells(spark, sf_dir).where(~((F.col("qualifier") == "status") & (F.col("value") == "P")))
    rows = ops.wide(table, COLUMNS)
    prefix = ops.prefix_predicate("1")
    both = ops.scan_filter_list(rows, [prefix, ops.column_equals("status", "F")])
    one = ops.scan_filter_list(rows, [prefix, ops.column_equals("status", "F", filter_if_missing=True)], must_pass_all=False)
    return both.withColumn("form", F.lit("all")).unionByName(one.withColumn("form", F.lit("one")))


@query("row_delete", f"""
    WITH {CELLS_SQL} SELECT * FROM cells WHERE NOT starts_with(rowkey, '7-')
      AND NOT (rowkey = {FIRST_KEY_SQL} AND qualifier = 'price')""")
def row_delete(spark, sf_dir):
    first = calls(spark, sf_dir).agg(F.min("rowkey")).first()[0]
    left = ops.row_delete(cells(spark, sf_dir), prefix="7-", cell=(first, "cf", "price"))
    return _slim(left)


@query("cells_long_wide", f"""
    WITH {CALLS_SQL} SELECT rowkey, "order", price, status, "order" || '_' || price || '_' || status AS row_values FROM calls""")
def cells_long_wide(spark, sf_dir):
    return ops.values_joined(ops.wide(cells(spark, sf_dir), COLUMNS), COLUMNS)


@query("reverse_time_rowkey", """
    SELECT CAST(user_id AS VARCHAR) || '-' || lpad(CAST(9223372036854775807 - epoch_us(ts) // 1000 AS VARCHAR), 19, '0') AS rowkey,
           event_id FROM events WHERE ts > TIMESTAMP '2024-01-10 00:00:00' AND ts <= TIMESTAMP '2024-01-20 00:00:00' AND user_id = 7""")
def reverse_time_rowkey(spark, sf_dir):
    e = events(spark, sf_dir).select(ops.reverse_time_rowkey("user_id", F.col("ts")).alias("rowkey"), "event_id")
    path = scratch_path(spark, "events-by-key")
    write_sorted(e, path, "rowkey")
    start, stop = ops.reverse_time_bounds("7", 1704844800000, 1705708800000)  # 10 and 20 January 2024, UTC
    return ops.split_scan(spark, path, start, stop)


@query("pack_record", f"""WITH {CALLS_SQL} SELECT rowkey, "order", price, status FROM calls""")
def pack_record(spark, sf_dir):
    packed = ops.pack_record(calls(spark, sf_dir), ["rowkey"], COLUMNS)
    path = scratch_path(spark, "packed")
    packed.write.parquet(path)
    return ops.unpack_record(spark.read.parquet(path), COLUMNS)


@query("table_copy", f"WITH {CELLS_SQL} SELECT * FROM cells")
def table_copy(spark, sf_dir):
    target = scratch_path(spark, "copy")
    ops.table_copy(cells(spark, sf_dir), target)
    return _slim(spark.read.parquet(target))


@query("table_copy_stream", f"WITH {CELLS_SQL} SELECT * FROM cells")
def table_copy_stream(spark, sf_dir):
    source = scratch_path(spark, "cells")
    cells(spark, sf_dir).write.parquet(source)
    schema = spark.read.parquet(source).schema
    table = KeyValueTable(spark, scratch_path(spark, "copy"), ops.CELL_KEY)
    table.attach(stream_parquet(spark, source, schema, 8), scratch_path(spark, "copy-checkpoint"), "ts", "append", across=True).awaitTermination()
    return _slim(table.current())


@query("split_scan", f"WITH {CELLS_SQL} SELECT * FROM cells WHERE rowkey >= '3' AND rowkey < '5'")
def split_scan(spark, sf_dir):
    path = scratch_path(spark, "splits")
    ops.write_splits(cells(spark, sf_dir), path)
    return _slim(ops.split_scan(spark, path, "3", "5"))


@query("messages_to_rows", """
    SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS rowkey, arg_max(props, event_id) AS value FROM events GROUP BY 1""")
def messages_to_rows(spark, sf_dir):
    return ops.messages_to_rows(events(spark, sf_dir), "ts", "event_id", "props")


@query("messages_to_rows_stream", """
    SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS rowkey, arg_max(props, event_id) AS value FROM events GROUP BY 1""")
def messages_to_rows_stream(spark, sf_dir):
    key = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    stream = event_stream(spark, sf_dir).select(key.alias("rowkey"), F.col("props").alias("value"), F.col("event_id").alias("seq"))
    table = KeyValueTable(spark, scratch_path(spark, "by-second"), ["rowkey"])
    table.attach(stream, scratch_path(spark, "by-second-checkpoint"), "seq", "append", across=True).awaitTermination()
    return table.current().select("rowkey", "value")


@query("table_admin", f"""
    WITH {CELLS_SQL} SELECT 'filled' AS step, CAST(count(*) AS BIGINT) AS "rows", TRUE AS present FROM cells
    UNION ALL SELECT 'truncated', 0, TRUE UNION ALL SELECT 'dropped', 0, FALSE""")
def table_admin(spark, sf_dir):
    name = f"wf_cells_{uuid.uuid4().hex}"
    ops.create_table(spark, name, scratch_path(spark, "admin"))
    cells(spark, sf_dir).write.insertInto(name)
    filled = spark.table(name).count()
    ops.truncate_table(spark, name)
    empty, there = spark.table(name).count(), ops.table_exists(spark, name)
    ops.drop_table(spark, name)
    steps = [("filled", filled, True), ("truncated", empty, there), ("dropped", 0, ops.table_exists(spark, name))]
    return spark.createDataFrame(steps, "step string, rows bigint, present boolean")
