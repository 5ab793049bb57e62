"""Near copies: SimHash fingerprints by ball hashing, verified on whole shingle sets, and chosen paths for what lies beyond the ball.

A document is the set of its five-word shingles; equal sets are one record, and near copies are records of a similarity of 0.8 or more. The
fingerprints of the sets go through ``simhash``: each emits the variants in a ball, variants that meet give pairs at most RADIUS bits
apart, and every pair is decided on the whole sets. A similarity of 0.8 is some 10 of 64 bits, and a ball that wide would hold millions
of variants. So pairs further apart are looked for among records whose minwise shingles meet (``chosenpath``, five trees, a link is
missed with 1e-6); records that the ball has brought together are not compared again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirflow.llm import simhash
from weirflow.llm.chosenpath import Settings, distinct_sets, keyed, links, row_key, set_rows, whole_sets
from weirflow.llm.common import by_shuffle, marked, stored

SIMILAR = Settings(percent=80, trees=5)
KEY = ["_wf_id", "_wf_h"]


def ball_pairs(records: DataFrame) -> DataFrame:
    """a, b: records of equal fingerprints, each with the first of them, and the first ones of fingerprints that ball hashing links."""
    fps = stored(records.groupBy("fp").agg(F.min("rec").alias("hub")), "fp")
    equal = records.select("fp", "rec").join(by_shuffle(fps), "fp").where("rec <> hub").select(F.col("hub").alias("a"), F.col("rec").alias("b"))
    near = simhash.links(fps.select("fp")).toDF("p", "q")
    of = lambda name: fps.select(F.col("fp").alias(name), F.col("hub").alias(f"{name}_hub"))
    return stored(equal.union(near.join(by_shuffle(of("p")), "p").join(by_shuffle(of("q")), "q").select("p_hub", "q_hub")), "ball")


def representatives(docs: DataFrame, settings: Settings = SIMILAR) -> DataFrame:
    """One row of each component of near copies, with all columns: the smallest doc_id (null last), then the smallest text hash.

    Documents with equal shingle sets are linked, those without words (null, empty or blank) too. Equal rows become one; an empty table
    stays empty. Only rows that go, and those given several times, are shuffled with their texts.
    """
    texts = keyed(docs)
    rows = set_rows(texts, settings, fingerprints=True)
    records = distinct_sets(rows)
    worded = records.where("n > 0")
    roots = links(worded, whole_sets(records, texts), settings, ball_pairs(worded))
    placed = records.select("rec", "row").join(by_shuffle(roots.select(F.col("node").alias("rec"), "root")), "rec", "left").withColumn("root", F.coalesce("root", "rec"))
    kept = stored(placed.groupBy("root").agg(F.min("row").alias("row")).select("row.*"), "kept")
    times = rows.groupBy(*KEY).agg(F.count(F.lit(1)).alias("times")).join(by_shuffle(kept.withColumn("stays", F.lit(True))), KEY, "left")
    changed = stored(times.where("stays IS NULL OR times > 1").select(*KEY, F.coalesce("stays", F.lit(False)).alias("stays")), "changed")
    sifted = marked(docs.select("*", *row_key()), changed, KEY, "_wf_changed")
    decided = sifted.where("_wf_changed").join(by_shuffle(changed), KEY, "left").where("coalesce(stays, true)").dropDuplicates(KEY)
    return sifted.where("NOT _wf_changed").select(*docs.columns).union(decided.select(*docs.columns))
