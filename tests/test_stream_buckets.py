"""Streams of many keys: keys share the calls of a stateful processor, each keeps its own state."""

from pyspark.sql import functions as F
from test_stream_forms import fed

from weirflow.session import scratch_path
from weirflow.streaming import processors


def drained(stream):
    """The rows, and the most rows of state that the processor wrote in a micro-batch."""
    path = scratch_path(stream.sparkSession, "drained")
    query = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", f"{path}-kept").trigger(availableNow=True).start()
    query.awaitTermination()
    wrote = [o["numRowsUpdated"] for p in query.recentProgress for o in p["stateOperators"] if o["operatorName"].startswith("transformWithState")]
    return stream.sparkSession.read.schema(stream.schema).parquet(path), max(wrote)


def test_sessions_of_many_keys_share_calls(spark, monkeypatch):
    monkeypatch.setattr(processors, "BUCKETS", 2, raising=False)
    # keys end their sessions at different times; every third goes on over the batches
    batches = [[(k, k, k) for k in range(60)], [(k, k + 10, 100 + k) for k in range(0, 60, 3)], [(k, 500, 7) for k in range(0, 60, 2)] + [(None, 501, 2)], [(99, 5000, 0)]]
    aggs = {"n": (F.count(F.lit(1)), "sum"), "low": (F.min("v"), "min")}
    out, n = drained(processors.merged_sessions_stream(fed(spark, batches, "k bigint, ts bigint, v bigint"), "ts", "2 minutes", 10, aggs, ["k"]))
    got = sorted((-1 if r["k"] is None else r["k"], r["window_start"].timestamp(), r["window_end"].timestamp(), r["n"], r["low"]) for r in out.collect())
    first = [(k, k, k + 20 if k % 3 == 0 else k + 10, 1 + (k % 3 == 0), k) for k in range(60)]
    assert got == sorted([*first, *((k, 500, 510, 1, 7) for k in range(0, 60, 2)), (-1, 501, 511, 1, 2)])
    assert 0 < n < 30


def test_lookups_of_many_keys_share_calls(spark, monkeypatch):
    monkeypatch.setattr(processors, "BUCKETS", 2, raising=False)
    ids = [None, *range(60)]
    batches = [[(k, 10, 1, True, f"a{k}") for k in ids], [(k, t, t, False, None) for k in ids for t in (9, 11, 20)], [(k, 15, 15, True, f"b{k}") for k in ids[::2]] + [(k, 20, 21, False, None) for k in ids]]
    stream = fed(spark, batches, "id bigint, ts bigint, seq bigint, cfg boolean, city string")
    out, n = drained(processors.config_lookup_stream(stream, "id", "ts", "seq", "cfg", "city", "1 minute", "none"))
    late = {k: f"b{k}" for k in ids[::2]}
    want = {(k, s): v for k in ids for s, v in ((9, "none"), (11, f"a{k}"), (20, f"a{k}"), (21, late.get(k, f"a{k}")))}
    assert {(r["id"], r["seq"]): r["label"] for r in out.collect()} == want
    assert 0 < n < 30
