"""Streaming forms give what the batch forms give, over several micro-batches and restarts."""

import os
import random
import time

import pytest
from conftest import SF_DIR
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from replay import replay_in_order

from weirflow.operators import aggregate, eventtime, state
from weirflow.plans.registry import arrival
from weirflow.session import load, scratch_path
from weirflow.sinks.keyvalue import KeyValueTable, kv_upsert_client
from weirflow.sources import files, generator, messages, watched
from weirflow.streaming import pipelines, processors

ORDERED_SLICES = 3


@pytest.fixture(scope="module")
def events(spark):
    """Few keys, times in minutes, so that expiry and jumps happen."""
    df = load(spark, SF_DIR, "events").where("event_id < 400")
    return df.select(
        "event_id", (F.col("user_id") % 5).alias("user_id"), "event_type", F.round(F.col("value") * 10).cast("bigint").alias("v"),
        F.col("ts").cast("timestamp").alias("ts"), F.unix_micros(F.col("ts").cast("timestamp")).alias("us"))


@pytest.fixture(scope="module")
def stream_of(spark, events):
    path = replay_in_order(events, "event_id", ORDERED_SLICES)
    return lambda: files.stream_parquet(spark, path, events.schema, 1)


HOUR_US = 3_600_000_000

CASES = {
    "running_count": (
        lambda s: processors.running_count_stream(s, ["user_id"], "event_id"),
        lambda e: aggregate.running_count_by_key(e, ["user_id"], ["event_id"]).select("user_id", "event_id", "cnt")),
    "changelog": (
        lambda s: processors.changelog_stream(s, ["user_id"], "event_id"),
        lambda e: aggregate.retract_changelog(e, ["user_id"], ["event_id"])),
    "running_sum": (
        lambda s: processors.running_sum_stream(s, ["user_id"], "v", "event_id"),
        lambda e: state.running_sum_state(e, ["user_id"], "v", ["event_id"]).select("user_id", "event_id", "total")),
    "trajectory": (
        lambda s: processors.trajectory_stream(s, "user_id", "event_id", "event_type"),
        lambda e: state.trajectory_steps(e, "user_id", ["event_id"], ["event_type"])),
    "ttl_counter": (
        lambda s: processors.ttl_counter_stream(s, ["user_id"], "us", "event_id", 6 * HOUR_US),
        lambda e: state.state_ttl_counter(e, ["user_id"], "ts", ["event_id"], 6 * 3600).select("user_id", "event_id", "cnt")),
    "first_seen": (
        lambda s: processors.first_seen_stream(s, ["user_id"], "us", "event_id", 24 * HOUR_US).drop("us"),
        lambda e: state.dedup_first_seen_ttl(e, ["user_id"], "ts", ["event_id"], 24 * 3600).select("user_id", "event_id")),
    "dup_count": (
        lambda s: processors.dup_count_stream(s, ["user_id"], "us", "event_id", 6 * HOUR_US).where("first").select("user_id", "event_id"),
        lambda e: state.dedup_with_dup_count(e, ["user_id"], "ts", ["event_id"], 6 * 3600).select("user_id", "event_id")),
}


@pytest.mark.parametrize("name", list(CASES))
def test_stream_equals_batch(events, stream_of, rows_of, name):
    stream, batch = CASES[name]
    got = pipelines.run_to_table(stream(stream_of()))
    want = batch(events)
    assert rows_of(got, *want.columns) == rows_of(want)


def test_speed_jump_stream(events, stream_of, rows_of):
    got = pipelines.run_to_table(processors.speed_jump_stream(stream_of(), "user_id", "v", "event_id"))
    want = state.speed_jump_alert(events.withColumn("v", F.col("v").cast("double")), "user_id", "v", ["event_id"])
    assert rows_of(got, "event_id", "message") == rows_of(want, "event_id", "message")


@pytest.mark.parametrize("punctuated", [False, True])
def test_late_router_continues_over_batches(spark, events, rows_of, punctuated):
    df = events.withColumn("arrival", arrival())
    order = ["arrival", "event_id"]
    marker = F.col("event_type") == "signup" if punctuated else None
    path = replay_in_order(df, "arrival", ORDERED_SLICES)
    router = pipelines.LateRouter(spark, scratch_path(spark, "router"), "ts", order, "1 hour", 1800, 3600, marker)
    router.attach(files.stream_parquet(spark, path, df.schema, 1), scratch_path(spark, "cp")).awaitTermination()
    if punctuated:
        trace = eventtime.punctuated_watermark(df, "ts", order, marker, 1800)
    else:
        trace = eventtime.bounded_watermark(df, "ts", order, 1800)
    want = eventtime.classify(eventtime.assign_window(trace, "ts", "1 hour"), 3600)
    assert rows_of(router.rows(), "event_id", "cls", "wm") == rows_of(want, "event_id", "cls", "wm")
    assert want.where("cls <> 'on_time'").count() > 0


def test_event_time_timers(spark):
    rows = [("bmw", 200, 10_000), ("cc", 100, 10_000), ("bmw", 50, 60_000)]
    path = scratch_path(spark, "speeds")
    schema = "car string, speed int, ts timestamp"
    spark.createDataFrame(rows, "car string, speed int, ms bigint").select("car", "speed", F.timestamp_millis("ms").alias("ts")).write.parquet(path)
    stream = files.stream_parquet(spark, path, schema).withWatermark("ts", "0 seconds")
    out = pipelines.run_to_table(processors.overspeed_timer_stream(stream, "car", "speed", "ts"))
    assert [tuple(r) for r in out.collect()] == [("bmw", 12_000)]


def test_clock_ttl_counter(spark, events, stream_of, rows_of):
    """A query on the processing clock never runs out of batches, so it is stopped from outside."""
    want = rows_of(aggregate.running_count_by_key(events, ["user_id"], ["event_id"]), "event_id", "cnt")
    counts = processors.ttl_counter_clock_stream(stream_of(), ["user_id"], "event_id", 3_600_000)
    target = scratch_path(spark, "clock")
    query = pipelines.checkpointed_query(counts, target, scratch_path(spark, "cp"), trigger="0 seconds")
    try:
        done = lambda: query.exception() is not None or sum(p["numInputRows"] for p in query.recentProgress) >= len(want)
        _wait(done, 60)
    finally:
        query.stop()
    assert rows_of(spark.read.schema(counts.schema).parquet(target), "event_id", "cnt") == want


def test_update_mode_emits_a_window_again(spark):
    lines = [[(10_000, "hello")], [(11_000, "hello")], [(15_000, "x")], [(11_500, "hello")]]
    path = scratch_path(spark, "lines")
    for part in lines:
        spark.createDataFrame(part, "ms bigint, w string").select(F.timestamp_millis("ms").alias("ts"), "w").coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.05)
    counts = pipelines.allowed_lateness_stream(files.stream_parquet(spark, path, "ts timestamp, w string", 1), "ts", 3, 3, "3 seconds", ["w"])
    seen = scratch_path(spark, "seen")
    handler = lambda df, i: df.withColumn("b", F.lit(i)).write.mode("append").parquet(seen)
    pipelines.for_each_batch(counts, handler, scratch_path(spark, "cp"), "update").awaitTermination()
    hello = spark.read.parquet(seen).where("w = 'hello'").orderBy("b").collect()
    assert [r["cnt"] for r in hello] == [1, 2, 3]


def test_watermark_per_source(spark):
    """The slower of two sources holds the watermark back, so its window stays open."""
    def source(name, ms):
        path = scratch_path(spark, name)
        spark.createDataFrame([(m,) for m in ms], "ms bigint").select(F.timestamp_millis("ms").alias("ts")).write.parquet(path)
        return files.stream_parquet(spark, path, "ts timestamp")

    both = pipelines.per_source_watermark([source("fast", [1_000, 60_000]), source("slow", [2_000])], "ts", "0 seconds")
    counts = both.groupBy(F.window("ts", "5 seconds")).count()
    assert pipelines.run_to_table(counts).count() == 0


def test_dedup_within_watermark(spark, stream_of):
    out = pipelines.run_to_table(pipelines.dedup_within_watermark(stream_of(), "ts", ["user_id"], "10 days"))
    assert out.count() == 5


def test_config_and_lookups_in_one_stream(spark, rows_of):
    batches = [[(1, "a", None, False), (2, "a", "x", True)], [(3, "a", None, False), (4, "b", None, False), (5, "a", "y", True), (6, "a", "z", True)], [(7, "a", None, False)]]
    schema = "seq bigint, id string, city string, is_config boolean"
    path = scratch_path(spark, "mixed")
    for b in batches:
        spark.createDataFrame(b, schema).coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.05)
    lookup = pipelines.ConfigLookup(spark, scratch_path(spark, "lookup"), "id", "city", "seq")
    pipelines.for_each_batch(files.stream_parquet(spark, path, schema, 1), lookup.handle, scratch_path(spark, "cp")).awaitTermination()
    assert rows_of(lookup.answers(), "seq", "label") == [(1, "x"), (3, "z"), (4, "not found city"), (7, "z")]


def test_refreshed_dimension(spark, rows_of):
    path, target = scratch_path(spark, "asked"), scratch_path(spark, "answers")
    for i in range(2):
        spark.createDataFrame([(i, 1)], "seq int, id int").coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.05)
    labels = iter(["old", "new"])
    query = pipelines.lookup_refreshing(
        files.stream_parquet(spark, path, "seq int, id int", 1), lambda: spark.createDataFrame([(1, next(labels))], "k int, v string"),
        "id", "k", "v", target, scratch_path(spark, "cp"))
    query.awaitTermination()
    out = spark.read.option("basePath", target).parquet(f"{target}/batch=*")
    assert rows_of(out, "seq", "label") == [(0, "old"), (1, "new")]


def test_restart_after_a_failure_loses_and_repeats_nothing(spark, events, stream_of, rows_of):
    """A task fails once in the middle of the stream; the restarted query ends with the same counts."""
    flag = scratch_path(spark, "fail-once")
    spark.range(1).write.parquet(flag)
    local_flag = f"{flag}/tripped"

    @F.udf("bigint")
    def trip(v):
        import os

        if v == 300 and not os.path.exists(local_flag):
            open(local_flag, "w").close()
            raise RuntimeError("injected failure")
        return v

    stream = stream_of().withColumn("event_id", trip("event_id"))
    counts = processors.running_count_stream(stream, ["user_id"], "event_id")
    target, checkpoint = scratch_path(spark, "out"), scratch_path(spark, "cp")
    with pytest.raises(StreamingQueryException):
        pipelines.checkpointed_query(counts, target, checkpoint).awaitTermination()
    pipelines.checkpointed_query(counts, target, checkpoint).awaitTermination()
    want = aggregate.running_count_by_key(events, ["user_id"], ["event_id"])
    assert rows_of(spark.read.schema(counts.schema).parquet(target), "event_id", "cnt") == rows_of(want, "event_id", "cnt")


def test_totals_survive_a_replayed_batch(spark, rows_of):
    totals = pipelines.RunningTotals(spark, scratch_path(spark, "totals"), ["u"], {"qty": F.col("q")})
    first = spark.createDataFrame([("a", 1), ("a", 2)], "u string, q bigint")
    totals.handle(first, 0)
    totals.handle(first, 0)
    totals.handle(first, 1)
    assert rows_of(totals.totals()) == [("a", 6)]


def test_key_value_table(spark, rows_of):
    table = KeyValueTable(spark, scratch_path(spark, "kv"), ["field"])
    put = lambda rows, b: table.put(spark.createDataFrame(rows, "field string, value string, seq int"), b, "seq")
    put([("hello", "1", 0), ("hello", "2", 1), ("word", "1", 2)], 0)
    put([("hello", "3", 0)], 1)
    put([("hello", "3", 0)], 1)
    assert rows_of(table.current(), "field", "value") == [("hello", "3"), ("word", "1")]
    assert rows_of(table.compact(scratch_path(spark, "kv")).current(), "field", "value") == [("hello", "3"), ("word", "1")]


def test_client_opened_once_per_partition(spark):
    out = scratch_path(spark, "client")
    spark.range(1).write.parquet(out)

    def open_client():
        import uuid

        return open(f"{out}/{uuid.uuid4().hex}.txt", "w")

    kv_upsert_client(spark.range(20).repartition(4), open_client, lambda c, row: c.write(f"{row['id']}\n"), lambda c: c.close())
    files_read = spark.read.text(f"{out}/*.txt").withColumn("f", F.input_file_name())
    assert files_read.count() == 20 and files_read.select("f").distinct().count() == 4


def _take(lines, out, place):
    """What one start of the query adds to ``out``."""
    spark = lines.sparkSession
    before = len(spark.read.schema(lines.schema).parquet(out).collect()) if os.path.exists(out) else 0
    lines.writeStream.format("parquet").option("path", out).option("checkpointLocation", place).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(lines.schema).parquet(out), before


def test_follow_file_over_restarts(spark, tmp_path):
    """Nothing before the path exists, all of it after each change, nothing again without one."""
    path, out, place = f"{tmp_path}/f", f"{tmp_path}/out", f"{tmp_path}/cp"
    lines = files.stream_follow_file(spark, path)
    want = 0
    for text, again in ((None, 0), ("1 a\n", 1), (None, 0), ("2 b\n3 c", 3), (None, 0)):
        if text:
            os.makedirs(path, exist_ok=True)
            with open(f"{path}/{len(os.listdir(path))}.txt", "w") as f:
                f.write(text)
        found, before = _take(lines, out, place)
        want += again
        assert found.count() == want and before == want - again
    assert sorted(r[0] for r in found.collect()) == ["1 a", "1 a", "2 b", "3 c"]


def test_follow_file_while_running(spark, tmp_path):
    path = scratch_path(spark, "followed")
    seen = []
    keep = lambda df, _: seen.append(sorted(r[0] for r in df.collect()))
    place = str(tmp_path / "cp")
    query = files.stream_follow_file(spark, path).writeStream.foreachBatch(keep).option("checkpointLocation", place).trigger(processingTime="200 milliseconds").start()
    try:
        spark.createDataFrame([("1 a",)], "v string").write.text(path)
        _wait(lambda: seen and seen[-1] == ["1 a"])
        spark.createDataFrame([("2 b",)], "v string").write.mode("append").text(path)
        _wait(lambda: seen[-1] == ["1 a", "2 b"])
    finally:
        query.stop()


def test_ranges_of_a_file_give_every_line_once(tmp_path, monkeypatch):
    rng = random.Random(1)
    lines = ["x" * rng.choice([0, 1, 5, 40]) + str(k) for k in range(200)]
    path = tmp_path / "a.txt"
    for end in ("", "\n"):
        path.write_text("\n".join(lines) + end)
        reader = watched._FollowReader(str(path))
        for size in (1, 7, 64, 10_000):
            monkeypatch.setattr(watched, "RANGE_BYTES", size)
            monkeypatch.setattr(watched, "READ_BYTES", 13)
            parts = reader.partitions(reader.initialOffset(), reader.latestOffset())
            got = [x for part in parts for batch in reader.read(part) for x in batch.column("value").to_pylist()]
            assert got == lines, (end, size)


def _wait(done, seconds=30):
    end = time.time() + seconds
    while not done():
        assert time.time() < end, "timed out"
        time.sleep(0.1)


def test_generator(spark, rows_of):
    batch = generator.generator_source(spark, parallelism=3, rows_per_split=5, streaming=False)
    assert batch.count() == 15 and batch.select("split").distinct().count() == 3
    stream = generator.generator_source(spark, parallelism=2, rows_per_batch=2, rows_per_split=4)
    target = scratch_path(spark, "generated")
    query = stream.writeStream.format("parquet").option("path", target).option("checkpointLocation", scratch_path(spark, "cp")).trigger(processingTime="200 milliseconds").start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    want = generator.generator_source(spark, parallelism=2, rows_per_split=4, streaming=False)
    assert rows_of(spark.read.schema(want.schema).parquet(target)) == rows_of(want)


def test_latest_is_the_first_start(spark, tmp_path):
    """What was there at the first start is skipped, also by a start that finds nothing; what comes while the query is down is not."""
    path, out, place = f"{tmp_path}/m", f"{tmp_path}/out", f"{tmp_path}/cp"
    row = spark.createDataFrame([("t", 0, 1, "a", b"k", b"v")], "topic string, partition int, offset bigint, tag string, key binary, value binary")
    row = row.withColumn("timestamp", F.current_timestamp())
    latest = messages.replay_source(spark, path, start="latest")
    for offset in (1, 2, 3):
        row.withColumn("offset", F.lit(offset).cast("bigint")).write.mode("append").parquet(path)
        found, _ = _take(latest, out, place)
    found, before = _take(latest, out, place)
    assert sorted(r["offset"] for r in found.collect()) == [2, 3] and before == 2
    got = found.where("offset = 2").first()
    want = spark.read.parquet(path).where("offset = 2").first()
    assert (got.timestamp, bytes(got.key)) == (want.timestamp, bytes(want.key))
