"""Near-duplicates by the Jaccard similarity of word shingles: a set similarity join along chosen paths.

A document is the set of its WIDTH-word shingles; equal sets are one record. In each of several independent trees every record goes to
BRANCHES children of the root, each named after one of its minwise shingles (the least under a hash function of its own), so two records
share a child with the probability of their similarity. Nodes of few records are compared exhaustively. Greater nodes branch again, by
minwise shingles under functions that the node chooses; what is still great after LEVELS levels is compared in blocks.

Recall: two records of similarity s that part at the first level are missed with probability (1 - s)^(trees * BRANCHES), for s = 0.85
that is 2.6e-7; on ever deeper paths a tree loses them with 0.031 at most (the least solution of q = (1 - s + s q)^BRANCHES), all trees
with 1e-6. For s = 0.8 that is 0.0625 a tree, so five trees are needed for 1e-6. Every link is confirmed on the whole sets.

Only components are asked for. So the records of every node are first compared with one of them, and nodes whose records all are in
one component are done. Within a task links join components too, so that a crowd of copies sends on a tree of links, not all its pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirflow.llm.common import by_shuffle, stored, text_slices, within
from weirflow.llm.components import components
from weirflow.llm.hashing import mix, shingles
from weirflow.llm.setlinks import BITS, WORDS, compared, may_be_near, parities, verified

WIDTH = 5
BRANCHES, LEVELS, POOL = 2, 4, 8
CHUNK_BYTES = 2 << 20
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_RECORD = "_wf_id bigint, _wf_h bigint, n int, s1 bigint, s2 bigint, least array<bigint>, " + ", ".join(f"{b} bigint" for b in BITS)
_LAST = (1 << 63) - 1


@dataclass(frozen=True)
class Settings:
    """percent: least similarity of a link, of 100; node: records of a small node, which are compared exhaustively; group_shingles: of a block of whole sets.

    trees: independent trees; fewer miss more links.
    """

    percent: int = 85
    node: int = 4096
    group_shingles: int = 2 << 20
    trees: int = 4

    @property
    def coordinates(self) -> int:
        return self.trees * BRANCHES + POOL * (LEVELS - 1)


def shingle_sets(texts: list[str]) -> list[np.ndarray]:
    """Sorted hashes of the different shingles of each text, A-Z lower-cased; with fewer words the whole text is one, without words none."""
    return shingles([t.encode("utf-8", "replace").translate(_LOWER) for t in texts], WIDTH)


def majority(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Fingerprints of the sets that begin at ``starts``: a bit is 1 if it is set in over half of a set's shingles."""
    sizes = np.diff(np.append(starts, len(values))).astype(np.uint64)
    out = np.zeros(len(starts), dtype=np.uint64)
    for k in map(np.uint64, range(64)):
        ones = np.add.reduceat((values >> k) & np.uint64(1), starts)
        out |= (2 * ones > sizes).astype(np.uint64) << k
    return out.view(np.int64)


def _records(batches: Iterable[pa.RecordBatch], s: Settings, fingerprints: bool) -> Iterator[pa.RecordBatch]:
    """Size, 128 bits of name, minwise shingles and parity bits of each set, and its fingerprint if asked for."""
    odd = mix(np.arange(1, s.coordinates + 1, dtype=np.uint64)) | np.uint64(1)
    for part, texts in text_slices(batches, limit=CHUNK_BYTES):
        sets = shingle_sets(texts)
        sizes = np.array([len(v) for v in sets], dtype=np.int64)
        full = np.flatnonzero(sizes)
        starts = (np.cumsum(sizes) - sizes)[full]
        values = np.concatenate([np.zeros(0, dtype=np.uint64), *sets])
        names = np.zeros((2, len(sets)), dtype=np.uint64)
        least = np.zeros((len(sets), s.coordinates), dtype=np.uint64)
        bits = np.zeros((len(sets), WORDS), dtype=np.int64)
        fp = np.zeros(len(sets), dtype=np.int64)
        if len(full):
            for k in range(2):
                names[k, full] = mix(np.add.reduceat(mix(values + np.uint64(k + 1) * odd[0]), starts))
            for c in range(s.coordinates):
                least[full, c] = np.minimum.reduceat(values * odd[c], starts)
            bits[full] = parities(values, sizes[full])
            if fingerprints:
                fp[full] = majority(values, starts)
        offsets = pa.array(np.arange(len(sets) + 1, dtype=np.int32) * s.coordinates)
        yield pa.RecordBatch.from_arrays(
            [part.column("_wf_id"), part.column("_wf_h"), pa.array(sizes.astype(np.int32)), *(pa.array(x.view(np.int64)) for x in names),
             pa.ListArray.from_arrays(offsets, pa.array(least.reshape(-1).view(np.int64))), *(pa.array(np.ascontiguousarray(bits[:, k])) for k in range(WORDS)), *([pa.array(fp)] if fingerprints else [])],
            names=["_wf_id", "_wf_h", "n", "s1", "s2", "least", *BITS, *(["fp"] if fingerprints else [])],
        )


def _sets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, texts in text_slices(batches, limit=CHUNK_BYTES):
        yield pa.RecordBatch.from_arrays(
            [part.column("rec"), pa.array([v.view(np.int64) for v in shingle_sets(texts)], pa.list_(pa.int64()))], names=["rec", "all"]
        )


def _children(level: int, trees: int) -> str:
    """Nodes of a record below ``node`` at ``level``: each is named after the node, the function chosen and the minwise shingle."""
    if level == 1:
        return f"transform(sequence(0, {trees * BRANCHES - 1}), c -> xxhash64(c, least[c]))"
    first = trees * BRANCHES + POOL * (level - 2)
    one = f"CAST({first} + pmod(xxhash64(node, 1), {POOL}) AS INT)"
    two = f"CAST({first} + pmod(xxhash64(node, 1) + 1 + pmod(xxhash64(node, 2), {POOL - 1}), {POOL}) AS INT)"
    return f"transform(array({one}, {two}), c -> xxhash64(node, c, least[c]))"


def links(records: DataFrame, sets: Callable[[DataFrame], DataFrame], s: Settings, pairs: DataFrame | None = None) -> DataFrame:
    """node, root of all records that are linked. ``sets`` gives the whole sets of the records in its argument.

    ``pairs`` (a, b) of records found by other means are decided first, along with every record against the first of each of its nodes.
    """
    spark = records.sparkSession
    carried = ["rec", "n", *BITS]
    paths = records.select("rec", F.explode(F.expr(_children(1, s.trees))).alias("node"))
    shared = paths.groupBy("node").agg(F.count(F.lit(1)).alias("m"), F.min("rec").alias("hub")).where("m > 1")
    met = stored(paths.join(by_shuffle(shared), "node"), "met")
    stars = met.where("rec <> hub").select(F.col("hub").alias("a"), F.col("rec").alias("b"))
    stars = (stars if pairs is None else stars.union(pairs.select(F.least("a", "b"), F.greatest("a", "b")))).distinct()
    p, q = records.select(F.col("rec").alias("a"), *carried).alias("p"), records.select(F.col("rec").alias("b"), *carried).alias("q")
    likely = stored(stars.join(by_shuffle(p), "a").join(by_shuffle(q), "b").where(may_be_near("p", "q", s.percent)).select("a", "b"), "likely")
    whole = sets(likely.select(F.explode(F.array("a", "b")).alias("rec")).distinct())
    edges = stored(verified(likely, whole, s.percent), "near")
    roots = components(edges).select(F.col("node").alias("rec"), "root")
    members = met.select("node", "rec")
    found = spark.createDataFrame([], "a bigint, b bigint")
    for level in range(1, LEVELS + 1):
        placed = members.join(by_shuffle(roots), "rec", "left").withColumn("root", F.coalesce("root", "rec"))
        nodes = placed.groupBy("node").agg(F.count(F.lit(1)).alias("m"), F.min("root").alias("r0"), F.max("root").alias("r1"))
        mixed = nodes.where("r0 <> r1").select("node", "m")
        here = stored(placed.join(mixed, "node"), "mixed")
        few = here if level == LEVELS else here.where(F.col("m") <= s.node)
        found = found.union(stored(compared(few.join(records.select(*carried), "rec"), records, sets, s.percent, s.node, s.group_shingles), "links"))
        if level == LEVELS:
            break
        great = here.where(F.col("m") > s.node)
        if great.isEmpty():
            break
        members = great.join(records.select("rec", "least"), "rec").select("rec", F.explode(F.expr(_children(level + 1, s.trees))).alias("node"))
    return components(edges.union(found))


def row_key() -> list[Column]:
    """_wf_id, _wf_h: key of a row; a null doc_id comes last."""
    return [F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_LAST)).alias("_wf_id"), F.xxhash64("text").alias("_wf_h")]


def keyed(docs: DataFrame) -> DataFrame:
    return docs.select(*row_key(), "text")


def set_rows(texts: DataFrame, s: Settings, fingerprints: bool = False) -> DataFrame:
    """One row for every row of ``texts`` (as ``keyed`` gives them) with what its set is compared by; fp is its fingerprint."""
    return stored(texts.mapInArrow(lambda b: _records(b, s, fingerprints), _RECORD + ", fp bigint" * fingerprints), "records")


def distinct_sets(rows: DataFrame) -> DataFrame:
    """Records: the different sets among ``rows``, with the key ``row`` of the first of their rows and a name ``rec``."""
    others = [c for c in rows.columns if c not in ("_wf_id", "_wf_h", "s1", "s2")]
    first = rows.groupBy("s1", "s2").agg(F.min(F.struct("_wf_id", "_wf_h")).alias("row"), *[F.any_value(c).alias(c) for c in others])
    return stored(first.withColumn("rec", F.monotonically_increasing_id()), "first")


def whole_sets(records: DataFrame, texts: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """Gives rec, all (the whole set) of the records in its argument, from the texts of their first rows."""

    def sets(wanted: DataFrame) -> DataFrame:
        owners = stored(records.select("rec", "row.*").join(by_shuffle(wanted), "rec"), "owners")
        found = within(texts, owners, ["_wf_id", "_wf_h"]).join(by_shuffle(owners), ["_wf_id", "_wf_h"]).dropDuplicates(["_wf_id", "_wf_h"])
        return stored(found.select("rec", "text").mapInArrow(_sets, "rec bigint, all array<bigint>"), "sets")

    return sets


def near_duplicates(docs: DataFrame, settings: Settings | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs`` (doc_id, text; other columns are not used).

    Linked are documents whose sets have 100 * intersection >= percent * union; component_id is the smallest doc_id that links reach, kept
    says whether it is the row's own. Null, empty and blank texts have the empty set and are linked with nothing. A null doc_id comes after
    all others; component_id is null where a component has no other, and its rows are kept. Repeated rows are linked like other copies.
    An empty table stays empty.
    """
    s = settings or Settings()
    texts = keyed(docs)
    rows = set_rows(texts, s)
    records = distinct_sets(rows.where("n > 0"))
    roots = links(records, whole_sets(records, texts), s)
    placed = records.join(roots.select(F.col("node").alias("rec"), "root"), "rec", "left").withColumn("root", F.coalesce("root", "rec"))
    lowest = placed.groupBy("root").agg(F.min("row._wf_id").alias("low"))
    named = placed.join(lowest, "root").select("s1", "s2", "low")
    out = rows.select("_wf_id", "n", "s1", "s2").join(named, ["s1", "s2"], "left").withColumn("low", F.when(F.col("n") > 0, F.col("low")).otherwise(F.col("_wf_id")))
    real = lambda c: F.when(F.col(c) != _LAST, F.col(c))
    return out.select(real("_wf_id").alias("doc_id"), F.col("n").cast("bigint").alias("n_shingles"), real("low").alias("component_id"), (F.col("_wf_id") == F.col("low")).alias("kept"))
