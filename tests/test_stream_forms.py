"""Stream forms of sessions, top and bottom, as-of lookups and re-fired windows: small cases worked out by hand."""

import os

from pyspark.sql import functions as F

from weirflow.operators import windows
from weirflow.session import scratch_path
from weirflow.sources.files import stream_parquet
from weirflow.streaming import pipelines, processors


def fed(spark, batches, schema):
    """One micro-batch per list of rows, with ``ts`` given in seconds."""
    path = scratch_path(spark, "fed")
    known = set()
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).withColumn("ts", F.timestamp_seconds("ts")).coalesce(1).write.mode("append").parquet(path)
        new = {n for n in os.listdir(path) if n.endswith(".parquet")} - known
        for name in new:
            os.utime(f"{path}/{name}", (1_000_000 + i, 1_000_000 + i))
        known |= new
    return stream_parquet(spark, path, spark.read.parquet(path).schema, 1)


def seconds(df, *columns):
    return sorted(tuple(r) for r in df.select(*[F.unix_seconds(c).alias(c) if c.startswith("window") else c for c in columns]).collect())


def parts():
    return {"n": (F.count(F.lit(1)), "sum"), "low": (F.min("v"), "min"), "high": (F.max("v"), "max")}


def test_sessions_without_a_key_over_batches(spark):
    # gap 10: a distance of exactly 10 still joins; the session goes on over micro-batches; a row without a time is in none
    batches = [[(0, 5), (10, 1), (20, None), (None, 9)], [(25, 2), (36, None)], [(37, None), (100, 7)], [(300, 0)]]
    out = pipelines.run_to_table(processors.merged_sessions_stream(fed(spark, batches, "ts bigint, v bigint"), "ts", "0 seconds", 10, parts()))
    got = {r["window_start"].timestamp(): (r["window_end"].timestamp(), r["n"], r["low"], r["high"]) for r in out.collect()}
    assert got == {0: (35, 4, 1, 5), 36: (47, 2, None, None), 100: (110, 1, 7, 7)}


def test_sessions_keep_large_numbers_and_null_keys(spark):
    big = 2**62 + 1
    batches = [[("a", 0, big), (None, 3, 1), ("a", 4, None)], [("a", 100, 5), (None, 8, 2)], [("z", 1000, 0)]]
    stream = fed(spark, batches, "k string, ts bigint, v bigint")
    out = pipelines.run_to_table(processors.merged_sessions_stream(stream, "ts", "1 minute", 10, parts(), ["k"]))
    assert {(r["k"], r["n"], r["low"], r["high"]) for r in out.collect()} == {("a", 2, big, big), (None, 2, 1, 2), ("a", 1, 5, 5)}


def test_lookups_in_event_order(spark):
    # a late lookup gets the value of its own time, not the newest; nothing before the first value; empty and null values
    schema = "id bigint, ts bigint, seq bigint, cfg boolean, city string"
    batches = [
        [(1, 10, 1, True, "A"), (1, 5, 2, False, None), (1, 12, 3, False, None), (2, 12, 4, False, None)],
        [(1, 20, 5, True, "B"), (1, 20, 6, False, None), (1, 15, 7, False, None)],
        [(1, 30, 8, True, ""), (1, 31, 9, False, None), (1, 40, 10, True, None), (1, 41, 11, None, None), (1, 29, 12, False, None)],
    ]
    out = pipelines.run_to_table(processors.config_lookup_stream(fed(spark, batches, schema), "id", "ts", "seq", "cfg", "city", "1 minute", "none"))
    assert {r["seq"]: r["label"] for r in out.collect()} == {2: "none", 3: "A", 4: "none", 6: "B", 7: "A", 9: "none", 11: "none", 12: "B"}


def test_lookup_state_ends(spark):
    """Versions below the watermark go, but for the newest: answers stay right over a long line of changes."""
    schema = "id bigint, ts bigint, seq bigint, cfg boolean, city string"
    batches = [[(1, 100 * i + 1, 2 * i, True, f"v{i}"), (1, 100 * i + 2, 2 * i + 1, False, None)] for i in range(6)]
    out = pipelines.run_to_table(processors.config_lookup_stream(fed(spark, batches, schema), "id", "ts", "seq", "cfg", "city", "0 seconds"))
    assert {r["seq"]: r["label"] for r in out.collect()} == {2 * i + 1: f"v{i}" for i in range(6)}


def test_top_and_bottom_take_the_last_value_of_a_key(spark, rows_of):
    batches = [[(0, 0, "a", 9), (1, 1, "a", 3), (2, 2, "b", 5)], [(3, 12, "c", None), (4, 13, "b", 5)], [(5, 500, "a", 0)]]
    schema = "seq bigint, ts bigint, car string, v bigint"
    out = pipelines.run_to_table(pipelines.sliding_top_bottom_stream(fed(spark, batches, schema), "ts", "0 seconds", "car", "v", "seq", "20 seconds", "10 seconds"))
    rows = spark.createDataFrame([r for b in batches for r in b], schema).withColumn("ts", F.timestamp_seconds("ts"))
    want = windows.sliding_top_bottom(rows, "ts", "car", "v", "seq", "20 seconds", "10 seconds").where("window_end < timestamp_seconds(500)")
    assert rows_of(out) == rows_of(want) and len(rows_of(out)) == 3


def test_windows_fire_again_for_late_rows(spark):
    # windows of 10, no delay, lateness 20: (0, 10) fires at 12 with two rows, again at the late 5, and at 30 it is over
    schema = "k string, seq bigint, ts bigint"
    batches = [[("a", 0, 1), ("a", 1, 9), ("a", 2, 12)], [("a", 3, 5), ("a", 4, 13)], [("a", 5, 6), ("a", 6, 30), ("a", 7, 2)]]
    made = pipelines.RefiringWindows(spark, scratch_path(spark, "refired"), "ts", ["k"], ["seq"], "10 seconds", 0, 20)
    made.attach(fed(spark, batches, schema), scratch_path(spark, "cp")).awaitTermination()
    got = seconds(made.firings(), "window_start", "cnt", "cls")
    assert got == [(0, 2, "on_time"), (0, 3, "refire"), (0, 4, "refire"), (10, 2, "on_time")]
    again = spark.read.parquet(f"{made.path}/rows/batch=1").drop("wm", "wm_after", "cls", "window_start", "window_end")
    made.handle(again.select("k", "seq", "ts"), 1)  # a repeated batch changes nothing
    assert seconds(made.firings(), "window_start", "cnt", "cls") == got
    # (0, 10) can't change any more, so its count is not carried on
    assert seconds(spark.read.parquet(f"{made.path}/counts/batch=2"), "window_start", "held") == [(10, 2), (30, 1)]


def test_window_with_late_rows_only_never_fires_on_time(spark):
    schema = "k string, seq bigint, ts bigint"
    batches = [[("a", 0, 15)], [("b", 1, 3)], [("a", 2, 16)], [("b", 3, 4), ("a", 4, 50)]]
    made = pipelines.RefiringWindows(spark, scratch_path(spark, "refired"), "ts", ["k"], ["seq"], "10 seconds", 0, 20)
    made.attach(fed(spark, batches, schema), scratch_path(spark, "cp")).awaitTermination()
    assert seconds(made.firings(), "k", "window_start", "cnt", "cls") == [("a", 10, 2, "on_time"), ("b", 0, 1, "refire"), ("b", 0, 2, "refire")]
