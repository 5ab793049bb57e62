"""Near-duplicates by the Jaccard similarity of word shingles, as an exact set similarity join.

A document is the set of its WIDTH-word shingles. Two sets of similarity 0.8 or more share a shingle among the first
n - ceil(0.8 n) + 1 of each, in any order that all documents use. Here shingles that a count-min sketch finds only once come first, then
the rest by hash: what occurs once can't be shared and is never shipped, so a document with more than a fifth of such shingles takes no
part. Sets that share a shingle of their beginnings are candidates; parity bits reject those that differ too much, and the others are
decided on the whole sets.

Only components are asked for. So every set is first compared with one or two of those it meets, and full pairs are formed only between
sets that are still in different components, in blocks where a shingle is crowded. No pair is left out.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirflow.llm.common import stored, text_slices, within
from weirflow.llm.components import components
from weirflow.llm.countmin import Shape, Sieve, Sketch, sketch
from weirflow.llm.hashing import mix, shingles
from weirflow.llm.setlinks import BITS, WORDS, may_be_near, parities, verified

WIDTH = 5
PERCENT = 80
SMALL_BYTES = 2 << 20
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


@dataclass(frozen=True)
class Settings:
    """block: most sets of a shingle that are paired up in one group of rows."""

    block: int = 256
    shape: Shape = Shape()


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """Sorted hashes of the different shingles of each text, A-Z lower-cased; a text of fewer words is one shingle, one without words none."""
    return shingles([t.translate(_LOWER) for t in texts], WIDTH)


def _sig(values: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(values.tobytes(), 42) if len(values) else 0


def _keys(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    values = np.concatenate([np.zeros(0, dtype=np.uint64), *shingle_sets(texts)])
    return values, mix(values ^ np.uint64(0x9E3779B97F4A7C15))


def _signed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, texts in text_slices(batches, limit=SMALL_BYTES):
        sigs = np.array([_sig(v) for v in shingle_sets([t.encode("utf-8", "replace") for t in texts])], dtype=np.uint64)
        yield pa.RecordBatch.from_arrays([part.column("_wf_id"), part.column("_wf_h"), pa.array(sigs.view(np.int64))], names=["_wf_id", "_wf_h", "sig"])


def _beginnings(batches: Iterable[pa.RecordBatch], parts: Sketch, s: Settings) -> Iterator[pa.RecordBatch]:
    """Sets that may have a near copy, with the shingles of their beginning that may be shared."""
    sieve = Sieve(parts, s.shape)
    kind = pa.list_(pa.int64())
    for _, texts in text_slices(batches, limit=SMALL_BYTES):
        sets = [v for v in shingle_sets([t.encode("utf-8", "replace") for t in texts]) if len(v)]
        if not sets:  # texts without words only
            continue
        sizes = np.array([len(v) for v in sets], dtype=np.int64)
        values = np.concatenate([np.zeros(0, dtype=np.uint64), *sets])
        shared = np.zeros(len(values), dtype=bool)
        shared[sieve.repeated(values, mix(values ^ np.uint64(0x9E3779B97F4A7C15)))] = True
        bits = parities(values, sizes)
        rows: dict[int, tuple] = {}
        for k, (v, may) in enumerate(zip(sets, np.split(shared, np.cumsum(sizes)[:-1]), strict=True)):
            first = len(v) - (4 * len(v) + 4) // 5 + 1 - int(len(v) - may.sum())
            if first > 0:
                rows[_sig(v)] = k, v[may][:first].view(np.int64)
        at = [k for k, _ in rows.values()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.array(list(rows), dtype=np.uint64).view(np.int64)), pa.array(sizes[at], pa.int32()), pa.array([r[1] for r in rows.values()], kind),
             pa.array([sets[k].view(np.int64) for k in at], kind), *(pa.array(np.ascontiguousarray(bits[at, k])) for k in range(WORDS))],
            names=["rec", "n", "start", "all", *BITS],
        )


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those pairs a, b that are near; only their sets are shuffled."""
    pairs = stored(pairs, "likely")
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("rec")).distinct()
    few = within(sets.select("rec", "all"), wanted, ["rec"]).dropDuplicates(["rec"])
    return verified(pairs, few, PERCENT)


def links(sets: DataFrame, s: Settings) -> DataFrame:
    """node, root of all sets with a near copy. Equal sets may be given several times."""
    carried = ["rec", "n", *BITS]
    met = sets.select("start", *carried).dropDuplicates(["rec"]).select(F.explode("start").alias("v"), *carried)
    counts = met.groupBy("v").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    met = stored(met.join(counts, "v"), "met")
    edges = sets.sparkSession.createDataFrame([], "a bigint, b bigint")
    row = F.struct(*carried)
    for pick in (F.min, F.max):
        # the set of a shingle with the least or greatest hash, and of those that a set meets again one
        hubs = met.groupBy("v").agg(pick(row).alias("hub"))
        ahead = met.alias("p").join(hubs, "v").where(f"rec <> hub.rec AND {may_be_near('p', 'hub', PERCENT)}")
        stars = ahead.groupBy(F.col("rec").alias("a")).agg(pick("hub.rec").alias("b"))
        edges = stored(edges.union(_verified(stars, sets)), "near")
    roots = components(edges)
    placed = met.join(roots.select(F.col("node").alias("rec"), "root"), "rec", "left").withColumn("root", F.coalesce("root", "rec"))
    open_ = placed.groupBy("v").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).where("r0 <> r1").select("v")
    rest = stored(placed.join(open_, "v"), "open").withColumn("blocks", F.ceil(F.col("m") / s.block).cast("int"))
    rest = rest.withColumn("own", F.pmod(F.xxhash64("rec"), F.col("blocks")).cast("int"))
    # a row goes to every pair of blocks that has its own one
    others = rest.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    dealt = others.select("*", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    p, q = dealt.alias("p"), dealt.alias("q")
    once = "(p.own <> q.own OR p.i = p.j)"
    pairs = p.join(q, ["v", "i", "j"]).where(f"p.rec < q.rec AND p.root <> q.root AND {once} AND {may_be_near('p', 'q', PERCENT)}")
    pairs = pairs.select(F.col("p.rec").alias("a"), F.col("q.rec").alias("b")).distinct()
    return components(edges.union(_verified(pairs, sets)))


def representatives(docs: DataFrame, settings: Settings | None = None) -> DataFrame:
    """One row of each component of near copies, with all columns: the smallest doc_id (null last), then the smallest text hash.

    Documents with equal shingle sets are linked, those without words (null, empty or blank) too, and any two with a similarity of 0.8
    or more. Equal rows become one; an empty table stays empty.
    """
    s = settings or Settings()
    last = (1 << 63) - 1
    named = docs.withColumn("_wf_id", F.coalesce(F.col("doc_id").cast("bigint"), F.lit(last))).withColumn("_wf_h", F.xxhash64("text"))
    signed = stored(named.select("_wf_id", "_wf_h", "text").mapInArrow(_signed, "_wf_id bigint, _wf_h bigint, sig bigint"), "sets")
    first = stored(signed.groupBy("sig").agg(F.min(F.struct("_wf_id", "_wf_h")).alias("row")), "first")
    parts = sketch(docs, _keys, s.shape, 2 * SMALL_BYTES)
    shipped = docs.sparkSession.sparkContext.broadcast(parts)
    schema = "rec bigint, n int, start array<bigint>, all array<bigint>, " + ", ".join(f"{w} bigint" for w in BITS)
    sets = docs.select("text").mapInArrow(lambda b: _beginnings(b, shipped.value, s), schema)
    roots = links(stored(sets, "beginnings"), s)
    placed = first.join(roots, F.col("sig") == F.col("node"), "left").withColumn("root", F.coalesce("root", "sig"))
    kept = placed.groupBy("root").agg(F.min("row").alias("row")).select(F.col("row._wf_id").alias("_wf_id"), F.col("row._wf_h").alias("_wf_h"))
    return named.join(kept, ["_wf_id", "_wf_h"]).dropDuplicates(["_wf_id", "_wf_h"]).select(*docs.columns)
