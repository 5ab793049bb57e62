"""Tables that Spark takes for small, as after an explode, are not broadcast by way of the driver."""

import random
from contextlib import contextmanager

from fixtures import by_id, frame, words_of

from weirflow.llm import nearcopies, simhash


@contextmanager
def broadcasts_below(spark, size):
    """Spark still judges what to broadcast by its limit of 10 MB; a table that turns out greater than ``size`` fails the query."""
    spark.conf.set("spark.sql.maxBroadcastTableSize", size)
    try:
        yield
    finally:
        spark.conf.unset("spark.sql.maxBroadcastTableSize")


def edges_of(spark, values):
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    rows = simhash.links(spark.createDataFrame(signed, "fp bigint").repartition(3)).collect()
    return {frozenset(x % (1 << 64) for x in r) for r in rows}


def test_balls_of_a_crowded_variant(spark, monkeypatch):
    rng = random.Random(3)
    values = [rng.getrandbits(32) for _ in range(300)]  # one upper half
    near = [v ^ 0b101 ^ (1 << 31) for v in values[:5]]
    monkeypatch.setattr(simhash, "CROWD", 16)
    with broadcasts_below(spark, "4m"):
        found = edges_of(spark, [*values, *near])
    assert {v for v, n in zip(values, near) if frozenset((v, n)) in found} == set(values[:5])


def test_variants_of_fingerprints(spark):
    rng = random.Random(4)
    values = [rng.getrandbits(64) for _ in range(4000)]
    with broadcasts_below(spark, "2m"):
        found = edges_of(spark, [*values, values[7] ^ 0b11 ^ (3 << 40), values[9] ^ 1])
    assert found == {frozenset((values[7], values[7] ^ 0b11 ^ (3 << 40))), frozenset((values[9], values[9] ^ 1))}


def test_paths_of_near_copies(spark):
    rng = random.Random(5)
    texts = [" ".join(words_of(rng, 8, "abcdefgh", 6)) for _ in range(16000)]
    base = words_of(rng, 60, "abcdefgh", 6)
    with broadcasts_below(spark, "2m"):
        out = by_id(nearcopies.representatives(frame(spark, [*texts, " ".join(base), " ".join([*base, "one"]), texts[3]])), "text")
    assert sorted(out) == list(range(16001))
