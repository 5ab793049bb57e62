"""Inputs on which results once went wrong, and streams over many files."""

import os
import subprocess
import sys
import uuid

import pytest
from conftest import ROOT, SF_DIR
from oracle import TABLES, compare, connect
from pyspark.sql import functions as F

from weirflow.operators import aggregate, enrich, maintenance, merge, reshape, rowkey, views, windows
from weirflow.operators.ordering import row_index
from weirflow.plans import QUERIES
from weirflow.session import load, scratch_path
from weirflow.sinks.keyvalue import KeyValueTable

STREAMS = sorted(k for k in QUERIES if k.endswith("_stream")) + ["checkpointed_query", "lookup_refreshing", "kv_upsert"]


@pytest.fixture(scope="module")
def scattered(spark, tmp_path_factory):
    """The tables with the events dealt over 200 files in random order."""
    folder = str(tmp_path_factory.mktemp("scattered"))
    for t in TABLES:
        if t != "events":
            os.symlink(f"{SF_DIR}/{t}.parquet", f"{folder}/{t}.parquet")
    load(spark, SF_DIR, "events").repartition(200, F.rand(3)).write.parquet(f"{folder}/events.parquet")
    return folder


@pytest.mark.parametrize("key", STREAMS)
def test_stream_over_200_files(spark, scattered, key):
    con = connect(SF_DIR)
    assert compare(spark, con, key, scattered) is None


@pytest.fixture
def table(spark):
    def make(rows, schema="id int, loc string", partition="loc"):
        name = f"wf_{uuid.uuid4().hex}"
        maintenance.create_partitioned(spark.createDataFrame(rows, schema), name, scratch_path(spark, "table"), partition, ["id"])
        return name

    return make


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_partition_column_cannot_be_updated(spark, table):
    name = table([(1, "a"), (2, "a"), (3, "b")])
    with pytest.raises(ValueError):
        maintenance.mutate_update(spark, name, "loc", ["id"], {"loc": F.lit("b")}, F.col("id") == 1)
    assert spark.table(name).count() == 3


def test_attach_keeps_rows_that_came_meanwhile(spark, table):
    name = table([(1, "a"), (2, "a"), (3, "b")])
    maintenance.detach_partition(spark, name, "loc", "a")
    maintenance.insert(spark.createDataFrame([(4, "a"), (5, "a")], "id int, loc string"), name)
    maintenance.attach_partition(spark, name, "loc", "a")
    assert rows(spark.table(name).select("id")) == [(1,), (2,), (3,), (4,), (5,)]


def test_null_partition(spark, table):
    name = table([(1, None), (2, None), (3, "b")])
    maintenance.mutate_delete(spark, name, "loc", ["id"], F.col("id") == 1)
    assert rows(spark.table(name)) == [(2, None), (3, "b")]
    maintenance.mutate_delete(spark, name, "loc", ["id"], F.col("id") == 2)
    assert rows(spark.table(name)) == [(3, "b")]


def test_dropped_column_takes_its_data_along(spark, table):
    name = table([(1, 10, "a"), (2, 20, "b")], "id int, k int, loc string")
    maintenance.comment_column(spark, name, "id", "it's the key")
    maintenance.add_column(spark, name, "kind", "string", "'none'")
    maintenance.drop_column(spark, name, "k", "loc")
    assert rows(spark.table(name).select("id", "kind", "loc")) == [(1, "none", "a"), (2, "none", "b")]
    assert [c.description for c in spark.catalog.listColumns(name) if c.name == "id"] == ["it's the key"]
    maintenance.add_column(spark, name, "k", "int")
    assert rows(spark.table(name).select("id", "k")) == [(1, None), (2, None)]


def test_loop_with_unknown_condition(spark):
    df = spark.createDataFrame([(1,), (None,), (5,)], "v int")
    out = reshape.iterate_until(df, {"v": F.col("v") - 2}, F.col("v") > 0)
    assert rows(out.select("v")) == [(-1,), (-1,), (None,)]


def test_null_order_values_come_first_when_split(spark):
    df = spark.createDataFrame([(1, i if i > 5 else None, i) for i in range(40)], "k int, o int, i int")
    plain = rows(row_index(df, ["k"], ["o", "i"], "n", 1000))
    assert rows(row_index(df, ["k"], ["o", "i"], "n", 10)) == plain


def test_panes_of_a_slide_that_does_not_divide(spark):
    df = spark.createDataFrame([(f"2024-01-01 00:00:{i:02d}", 1) for i in range(60)], "t string, v int").withColumn("t", F.col("t").cast("timestamp"))
    out = windows.sliding_by_panes(df, "t", "5 seconds", "2 seconds", {"s": F.sum("v")}, {"total": F.sum("s")})
    plain = df.groupBy(F.window("t", "5 seconds", "2 seconds").alias("w")).agg(F.sum("v").alias("total")).select("w.start", "w.end", "total")
    assert rows(out.select("window_start", "window_end", "total")) == rows(plain)


def test_tie_breaks_of_any_type(spark):
    df = spark.createDataFrame([("a", 5, "x"), ("b", 5, "y"), ("c", 1, "z"), ("d", None, "q")], "car string, v int, s string")
    df = df.withColumn("t", F.lit("2024-01-01 00:00:00").cast("timestamp")).withColumn("seq", F.monotonically_increasing_id())
    top = windows.sliding_top_bottom(df, "t", "car", "v", "seq", "10 seconds", "10 seconds").first()
    assert (top.fastest, top.slowest) == ("a", "c")
    out = aggregate.keyed_basic_aggs(df.withColumn("k", F.lit(1)), ["k"], "v", ["car"], "s").first()
    assert (out.min_by_car, out.max_by_car) == ("c", "a")


def test_change_log_with_null_and_double(spark):
    df = spark.createDataFrame([("a", 1, 0.1), ("a", 2, None), ("a", 3, 0.2)], "k string, s int, v double")
    out = aggregate.retract_changelog(df, ["k"], ["s"], F.col("v"))
    assert sorted((r.s, r.op, r.value) for r in out.collect()) == [(1, True, 0.1), (2, False, 0.1), (2, True, 0.1), (3, False, 0.1), (3, True, 0.1 + 0.2)]


def test_table_function_drops_trailing_empty_tokens(spark):
    spark.createDataFrame([("a b  ",), ("",), (" ",), (None,), (" c",)], "text string").createOrReplaceTempView("wf_split_lines")
    name = reshape.register_split_udtf(spark)
    got = rows(spark.sql(f"SELECT w.word FROM wf_split_lines, LATERAL {name}(text) w"))
    assert got == rows(reshape.flat_map_split(spark.table("wf_split_lines"), "text"))


def test_packed_record_gives_back_blanks_and_nulls(spark):
    values = [" a ", "", None, '"', "a,b", "=", "\\", "é\n x"]
    df = spark.createDataFrame([(i, v, values[-1 - i]) for i, v in enumerate(values)], "k int, a string, b string")
    assert rows(rowkey.unpack_record(rowkey.pack_record(df, ["k"], ["a", "b"]), ["a", "b"])) == rows(df)


def test_lookup_in_a_dimension_with_repeated_keys(spark):
    dim = spark.createDataFrame([(1, "old", 1), (1, "new", 2)], "id int, name string, s int")
    facts = spark.createDataFrame([(7, 1), (8, 2)], "f int, id int")
    assert rows(enrich.lookup_static(facts, dim, "id", "id", "name", dim_seq="s").select("f", "label")) == [(7, "new"), (8, "not found")]


def test_union_of_tables_in_another_database(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS wf_other")
    name = f"u_{uuid.uuid4().hex}"
    spark.range(3).write.mode("overwrite").saveAsTable(f"wf_other.{name}")
    assert merge.union_tables_regex(spark, name, "wf_other").count() == 3
    spark.sql("DROP DATABASE wf_other CASCADE")


def test_temporary_table_holds_its_rows(spark):
    path = scratch_path(spark, "source")
    spark.range(3).write.parquet(path)
    kept = views.temp_table(spark.read.parquet(path), "wf_kept")
    spark.range(5).write.mode("append").parquet(path)
    assert kept.count() == 3


def test_newest_value_wins_over_later_batch(spark):
    kv = KeyValueTable(spark, scratch_path(spark, "kv"), ["k"])
    kv.put(spark.createDataFrame([("a", "new", 10)], "k string, v string, ts int"), 0, "ts", across=True)
    kv.put(spark.createDataFrame([("a", "old", 1), ("b", "x", 1)], "k string, v string, ts int"), 1, "ts", across=True)
    assert rows(kv.current().select("k", "v")) == [("a", "new"), ("b", "x")]
    assert rows(kv.compact(scratch_path(spark, "kv")).current().select("k", "v")) == [("a", "new"), ("b", "x")]


def test_dropped_table_leaves_no_rows(spark):
    path, name = scratch_path(spark, "cells"), f"wf_{uuid.uuid4().hex}"
    rowkey.create_table(spark, name, path)
    spark.sql(f"INSERT INTO {name} VALUES ('r', 'f', 'q', 1, 'v')")
    rowkey.drop_table(spark, name)
    rowkey.create_table(spark, name, path)
    assert spark.table(name).count() == 0
    rowkey.drop_table(spark, name)


def test_workers_find_the_package_from_any_folder(tmp_path):
    code = f"""
import sys
sys.path.insert(0, {ROOT!r})
import __spark_entry__ as e
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
print("ROWS", e.queries()["running_count_by_key_stream"](spark, {SF_DIR!r}).count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "ROWS 1000" in done.stdout, done.stderr[-2000:]


def test_key_filters_reach_the_files(spark):
    for key in ("row_get", "scan_prefix", "scan_range", "reverse_time_rowkey"):
        plan = QUERIES[key](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
        assert "PushedFilters: [" in plan and "rowkey" in plan.split("PushedFilters: [")[1].split("]")[0], key


@pytest.mark.parametrize("broken", ["CREATE TABLE", "RECOVER PARTITIONS", "RENAME TO .*__old", "__new RENAME", "DROP TABLE", None])
def test_drop_column_broken_off(spark, table, monkeypatch, broken):
    """Whichever statement fails, the rows are the old or the new ones, and the next call finishes the rewrite."""
    import re

    name = table([(1, "a", "x"), (2, "a", None), (3, None, "z")], "id int, loc string, note string")
    maintenance.detach_partition(spark, name, "loc", "a")
    maintenance.insert(spark.createDataFrame([(5, "b", "y")], "id int, loc string, note string"), name)
    run = spark.sql

    def failing(text, *args, **kwargs):
        if broken and re.search(broken, text):
            raise RuntimeError("broken off")
        return run(text, *args, **kwargs)

    if broken:
        monkeypatch.setattr(spark, "sql", failing)
        with pytest.raises(RuntimeError):
            maintenance.drop_column(spark, name, "note", "loc", ["id"])
        monkeypatch.undo()
        there = [t for t in (name, name + maintenance.OLD) if spark.catalog.tableExists(t)]
        assert rows(spark.table(there[0]).select("id", "loc")) == [(3, None), (5, "b")]
        maintenance.finish_rewrite(spark, name)
        assert rows(spark.table(name).select("id", "loc")) == [(3, None), (5, "b")]
    if "note" in spark.table(name).columns:
        maintenance.drop_column(spark, name, "note", "loc", ["id"])
    assert spark.table(name).columns == ["id", "loc"] and rows(spark.table(name)) == [(3, None), (5, "b")]
    assert not any(spark.catalog.tableExists(name + mark) for mark in (maintenance.NEW, maintenance.OLD))
    maintenance.add_column(spark, name, "note", "string")
    maintenance.attach_partition(spark, name, "loc", "a")
    assert rows(spark.table(name).where("loc = 'a'").select("id")) == [(1,), (2,)]
