"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints at most RADIUS bits apart have a common variant when each emits all variants within half of the radius. Emitting the
whole ball of 64 bits (2,081 variants at radius 4) costs more than the texts, so a fingerprint first emits the balls of its two
halves: one half differs in at most RADIUS / 2 bits, so the variants of that half within RADIUS / 4 meet (66 variants in all). Colliding
pairs are deduplicated and verified on all bits. A variant with more than CROWD different fingerprints is never paired up: its
fingerprints emit the whole ball instead, where any two that share a variant are within RADIUS bits without a check, so each only
links to the smallest fingerprint of the variant.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirflow.llm.common import by_shuffle, stored, text_slices, wider
from weirflow.llm.components import components

SHINGLE = 4
RADIUS = 4
SEED = 42
CROWD = 256
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: str) -> int:
    """64 bits over the 4-word shingles of the text with A-Z lower-cased, repeats included; 0 without words."""
    words = text.encode("utf-8", "replace").translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= SHINGLE:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        ends = np.cumsum(sizes + 1) - 1
        starts = ends - sizes
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts[: 1 - SHINGLE].tolist(), ends[SHINGLE - 1 :].tolist(), strict=True)]
    n = len(hashes)
    ones = np.zeros(64, dtype=np.int64)
    for a in range(0, n, 8192):
        rows = np.array(hashes[a : a + 8192], dtype=">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(rows, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame) -> DataFrame:
    """All columns of ``docs`` and fp, the fingerprint of the whole text as a signed 64-bit integer; a null text has 0."""
    rest = [c for c in docs.columns if c != "fp"]
    docs = docs.select(*rest)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches):
            found = np.array([fingerprint(t) for t in texts], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in rest), pa.array(found)], names=[*rest, "fp"])

    return docs.mapInArrow(run, wider(docs, fp="bigint"))


def flips(bits: int, most: int) -> list[int]:
    """Masks, as signed 64-bit integers, with at most ``most`` of the lowest ``bits`` bits set."""
    masks = [sum(1 << b for b in at) for k in range(most + 1) for at in combinations(range(bits), k)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _variants(frame: DataFrame, value: str | Column, masks: list[int]) -> DataFrame:
    """One row for every mask, with the variant ``v`` of ``value``."""
    table = F.transform(F.lit(masks), lambda m: m.bitwiseXOR(F.col(value) if isinstance(value, str) else value))
    return frame.withColumn("v", F.explode(table))


def _ball(frame: DataFrame) -> DataFrame:
    """fp, v: the whole ball of half the radius around each fingerprint, built in numpy."""
    masks = np.array(flips(64, RADIUS // 2), dtype=np.int64)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                fp = batch.column("fp").slice(a, 256).to_numpy()
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(fp, len(masks))), pa.array((fp[:, None] ^ masks[None, :]).ravel())], names=["fp", "v"])

    return frame.select("fp").mapInArrow(run, "fp bigint, v bigint")


def links(fps: DataFrame) -> DataFrame:
    """Edges a, b between different fingerprints ``fp`` that give the same components as all pairs within RADIUS bits."""
    # the table is small and grows 66 times from here: more tasks than it has files
    fps = fps.repartition(int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions")), "fp")
    half = F.array(F.struct(F.lit(0).alias("side"), F.shiftrightunsigned("fp", 32).alias("part")), F.struct(F.lit(1).alias("side"), F.col("fp").bitwiseAND(0xFFFFFFFF).alias("part")))
    sides = fps.select("fp", F.explode(half).alias("s")).select("fp", "s.side", "s.part")
    near = _variants(sides, "part", flips(32, RADIUS // 4))
    sizes = near.groupBy("side", "v").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = stored(near.join(by_shuffle(sizes), ["side", "v"]).select("side", "v", "fp", "n"), "variants")
    few = shared.where(F.col("n") <= CROWD)
    groups = few.groupBy("side", "v").agg(F.array_sort(F.collect_list("fp")).alias("all")).select("side", "v", "all", F.posexplode("all").alias("i", "a"))
    # a pair meets at up to 33 variants: it counts at the smaller of its two midpoints, or at the half itself if that is equal
    half_of = "IF(side = 0, shiftrightunsigned({0}, 32), {0} & 4294967295L)".format
    here = f"({half_of('a')} ^ {half_of('b')} ^ v) >= v AND ({half_of('a')} <> {half_of('b')} OR v = {half_of('a')})"
    close = groups.select("a", F.explode(F.expr(f"filter(slice(all, i + 2, size(all)), b -> bit_count(a ^ b) <= {RADIUS} AND {here})")).alias("b")).distinct()
    many = shared.where(F.col("n") > CROWD).select("fp").distinct()
    ball = _ball(many)
    least = ball.groupBy("v").agg(F.min("fp").alias("b"), F.count(F.lit(1)).alias("n")).where("n > 1")
    stars = ball.join(by_shuffle(least), "v").select(F.col("fp").alias("a"), "b").where("a <> b").distinct()
    return close.union(stars)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """All columns of ``docs`` but the text, fingerprint (16 hex digits) and component_id, the smallest doc_id reachable over links.

    Equal fingerprints are always linked, those of texts without words too (null, empty or blank: fingerprint zero). Repeated rows are
    linked to each other. A null doc_id is skipped by the minimum; a component of null ids only has a null component_id. Columns named
    fp, fingerprint or component_id are replaced; an empty table stays empty.
    """
    rest = [c for c in docs.columns if c not in ("text", "fp", "fingerprint", "component_id")]
    marked = stored(fingerprints(docs.select(*rest, "text")).drop("text"), "fingerprints")
    fps = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "fp")
    roots = components(links(fps.select("fp")))
    placed = fps.join(by_shuffle(roots), F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    lowest = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    named = placed.join(lowest, "root").select("fp", "component_id")
    return marked.join(by_shuffle(named), "fp").select(*rest, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def representatives(docs: DataFrame) -> DataFrame:
    """One row of each component, with all columns: the smallest doc_id (null last), then the smallest text hash; equal rows become one."""
    last = (1 << 63) - 1
    named = docs.withColumn("_wf_id", F.coalesce(F.col("doc_id").cast("bigint"), F.lit(last))).withColumn("_wf_h", F.xxhash64("text"))
    found = near_duplicates(named.select(F.col("_wf_id").alias("doc_id"), "_wf_h", "text"))
    first = found.groupBy("component_id").agg(F.min(F.struct("doc_id", "_wf_h")).alias("row")).select(F.col("row.doc_id").alias("_wf_id"), F.col("row._wf_h").alias("_wf_h"))
    return named.join(first, ["_wf_id", "_wf_h"]).dropDuplicates(["_wf_id", "_wf_h"]).select(*docs.columns)
