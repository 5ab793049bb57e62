"""Block scans against brute force, with one key holding most rows."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from weirflow.operators import ordering as o

SCHEMA = "k string, seq bigint, v bigint"


def brute(rows):
    out, state = {}, {}
    for k, seq, v in sorted(rows, key=lambda r: r[1]):
        s = state.setdefault(k, {"n": 0, "sum": 0, "max": None, "prev": None, "any": False, "last": None})
        before_max, prev = s["max"], s["prev"]
        s["n"] += 1
        s["sum"] += v or 0
        if v is not None:
            s["max"] = v if s["max"] is None else max(s["max"], v)
            s["last"] = v
        out[seq] = (s["n"], s["sum"], s["max"], before_max, prev, s["last"])
        s["prev"] = v
    return out


def scanned(spark, rows, keys, limit):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    f = o.ordered(df, keys, ["seq"], limit).scan(
        n=o.running_count(), total=o.running_sum(F.coalesce("v", F.lit(0))), top=o.running_max("v"),
        before=o.running_max("v", inclusive=False), prev=o.previous("v"), last=o.latest("v"),
    )
    return {r["seq"]: tuple(r)[3:] for r in f.frame.collect()}


@pytest.mark.parametrize("limit", [3, 40, 10_000])
@pytest.mark.parametrize("keyed", [True, False])
def test_scan_matches_brute_force(spark, limit, keyed):
    rng = random.Random(7)
    rows = [("hot" if rng.random() < 0.4 else f"k{rng.randrange(20)}", i * 3, rng.choice([None, *range(50)])) for i in range(300)]
    want = brute(rows if keyed else [("all", s, v) for _, s, v in rows])
    assert scanned(spark, rows, ["k"] if keyed else [], limit) == want


def test_null_key_is_a_group_of_its_own(spark):
    rows = [(None, i, i) for i in range(50)] + [("a", 100 + i, i) for i in range(5)]
    assert scanned(spark, rows, ["k"], 4) == brute(rows)


def test_empty_input(spark):
    assert scanned(spark, [], ["k"], 4) == {}
    assert scanned(spark, [], [], 4) == {}


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from("aab"), st.integers(0, 9)), max_size=40), st.integers(1, 6))
def test_scan_property(spark, pairs, limit):
    rows = [(k, i, v) for i, (k, v) in enumerate(pairs)]
    assert scanned(spark, rows, ["k"], limit) == brute(rows)


def test_hot_key_is_cut_into_bounded_blocks(spark):
    df = spark.range(10_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), F.col("id").alias("seq"))
    frame = o.ordered(df, ["k"], ["seq"], 500)
    sizes = frame._df.groupBy("k", o._BLOCK).count()
    assert sizes.agg(F.max("count")).first()[0] <= 600
    # keys below the limit are not cut
    assert frame._df.where(f"k <> 'hot' AND {o._BLOCK} <> 0").isEmpty()


@pytest.mark.parametrize("keys", [[], ["k"]])
def test_ties_of_the_first_column_are_cut(spark, keys):
    """10,000 rows with few first values: blocks of at most twice the limit, and the same running values."""
    df = spark.range(10_000).select(F.lit("hot").alias("k"), F.when(F.col("id") % 4 == 0, F.lit(None)).otherwise(F.col("id") % 2).alias("seq"), F.concat(F.lit("n"), F.col("id")).alias("name"), "id")
    frame = o.ordered(df, keys, ["seq", "name"], 100)
    sizes = [r["count"] for r in frame._df.groupBy(o._BLOCK).count().collect()]
    assert max(sizes) <= 200 and sum(sizes) == 10_000
    got = {r.id: (r.n, r.s, r.p) for r in frame.scan(n=o.running_count(), s=o.running_sum("id"), p=o.previous("id")).frame.collect()}
    order = sorted(range(10_000), key=lambda i: (-1 if i % 4 == 0 else i % 2, f"n{i}"))
    total, want = 0, {}
    for n, i in enumerate(order):
        total += i
        want[i] = (n + 1, total, order[n - 1] if n else None)
    assert got == want
