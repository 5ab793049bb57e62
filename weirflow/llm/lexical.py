"""Ranked lexical search with MaxScore over single terms and term pairs.

The index is cut by documents into shards of some megabytes of text, each with the postings of all its terms. For the pairs of the most
frequent terms of the corpus, which every other query has and whose postings are the longest, each shard also keeps the intersection of the
two lists and the greatest joint impact in it.

A query keeps its best documents over the shards of a task, and with them a threshold. In a shard its terms are taken by falling
greatest impact until what is left can't reach the threshold: only documents with a term taken so far are candidates. The bound of what is
left is not the sum of the greatest impacts: for two terms of a stored pair it is the greatest joint impact, or the greater of the two
where no document has both. Candidates are then completed term by term or pair by pair, and dropped once their score and the bound of the
rest fall below the threshold; a candidate outside of a pair's intersection has one of the two terms at most. Ties are kept, so the
result is exact.

Terms are 64 bits of hash; scores are integers of 64 bits.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weirflow.llm.common import free_memory, stored, text_slices, wider
from weirflow.llm.hashing import mix, words_of

_TO_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_BREAKS = np.zeros(256, dtype=bool)
_BREAKS[[*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True


@dataclass(frozen=True)
class Settings:
    """k: documents of a query; shard_bytes: text of a shard; pair_terms: frequent terms whose pairs are stored; block_terms: of queries searched at once."""

    k: int = 10
    shard_bytes: int = 16 << 20
    pair_terms: int = 32
    block_terms: int = 200_000


def terms_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Text and hash of every term, a run of ASCII letters, digits and characters outside ASCII, A-Z lower-cased; in order of the texts."""
    found = words_of([t.translate(_TO_LOWER) for t in texts], breaks=_BREAKS)
    return found.text, mix(found.h1 ^ (found.h2 * np.uint64(3)))


def _packed(*arrays: np.ndarray) -> bytes:
    """Arrays with bytes of equal weight together, compressed."""
    head = np.array([len(a) for a in arrays], dtype="<u8").tobytes()
    return zstandard.compress(head + b"".join(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T.tobytes() for a in arrays), 1)


def _unpacked(blob: bytes, *dtypes: str) -> list[np.ndarray]:
    data = memoryview(zstandard.decompress(blob))
    sizes = np.frombuffer(data[: 8 * len(dtypes)], dtype="<u8").tolist()
    at, out = 8 * len(dtypes), []
    for n, dtype in zip(sizes, dtypes, strict=True):
        width = np.dtype(dtype).itemsize * n
        planes = np.frombuffer(data[at : at + width], dtype=np.uint8).reshape(np.dtype(dtype).itemsize, n)
        out.append(np.ascontiguousarray(planes.T).view(dtype).reshape(-1))
        at += width
    return out


@dataclass
class Postings:
    """Terms of a shard in order of their hash, and for each the documents (numbers within the shard, rising) and occurrences."""

    terms: np.ndarray
    edges: np.ndarray
    docs: np.ndarray
    tf: np.ndarray

    @classmethod
    def of(cls, text: np.ndarray, term: np.ndarray) -> Postings:
        order = np.argsort(term, kind="stable")
        text, term = text[order], term[order]
        new_term = np.ones(len(term), dtype=bool)
        new_term[1:] = term[1:] != term[:-1]
        new = new_term.copy()
        new[1:] |= text[1:] != text[:-1]
        first = np.flatnonzero(new)
        starts = np.flatnonzero(new_term[first])
        return cls(term[first[starts]], np.append(starts, len(first)).astype("<u4"), text[first].astype("<u4"), np.diff(np.append(first, len(term))).astype("<u4"))

    def packed(self) -> bytes:
        return _packed(np.diff(self.terms, prepend=np.uint64(0)), np.diff(self.edges, prepend=np.uint32(0)), self.docs, self.tf)

    @classmethod
    def read(cls, blob: bytes) -> Postings:
        terms, edges, docs, tf = _unpacked(blob, "<u8", "<u4", "<u4", "<u4")
        return cls(np.cumsum(terms, dtype=np.uint64), np.cumsum(edges, dtype=np.uint32), docs, tf)

    def places(self, terms: np.ndarray) -> np.ndarray:
        """Number of each of ``terms`` here, -1 where the shard does not have it."""
        at = np.searchsorted(self.terms, terms)
        at[at == len(self.terms)] = 0
        return np.where(self.terms[at] == terms, at, -1) if len(self.terms) else np.full(len(terms), -1)

    def list(self, place: int) -> tuple[np.ndarray, np.ndarray]:
        a, b = int(self.edges[place]), int(self.edges[place + 1])
        return self.docs[a:b], self.tf[a:b]


@dataclass(frozen=True)
class Stats:
    """Documents with a term, and terms of all documents with repeats."""

    docs: int
    words: int

    def weight(self, df: int) -> int:
        return math.floor(1000 * math.log((2 * self.docs + 2) / (2 * df + 1)))

    def lengths(self, n: np.ndarray) -> np.ndarray:
        """The length part m of each document of ``n`` terms; whole numbers, Python's own where 64 bits could overflow."""
        if int(n.max(initial=0)) * 90 * self.docs < 1 << 63:
            return 10 + (90 * n.astype(np.int64) * self.docs) // max(1, self.words)
        return np.array([10 + 90 * int(x) * self.docs // max(1, self.words) for x in n], dtype=np.int64)


def _impacts(weight: int, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    tf = tf.astype(np.int64)
    return weight * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))


@dataclass
class Index:
    """Stored shards and figures of a corpus. frequent: the terms of stored pairs; their count is a setting."""

    spark: SparkSession
    shards: DataFrame
    stats: Stats
    frequent: np.ndarray


def _shards(batches: Iterable[pa.RecordBatch], s: Settings) -> Iterator[pa.RecordBatch]:
    for part, texts in text_slices(batches, limit=s.shard_bytes):
        text, term = terms_of([t.encode("utf-8", "replace") for t in texts])
        n = np.bincount(text, minlength=len(texts)).astype("<u4")
        ids = part.column("_wf_id")
        null = np.array(ids.is_null())
        rows = _packed(n, null.astype("<u1"))
        numbers = np.array(ids.fill_null(0), dtype="<i8")
        yield pa.RecordBatch.from_arrays(
            [pa.array([len(texts)], pa.int32()), pa.array([int((n > 0).sum())], pa.int64()), pa.array([int(n.sum())], pa.int64()),
             pa.array([_packed(numbers)], pa.binary()), pa.array([rows], pa.binary()), pa.array([Postings.of(text, term).packed()], pa.binary())],
            names=["docs", "filled", "words", "ids", "rows", "body"],
        )


def _counts(batches: Iterable[pa.RecordBatch], wanted: np.ndarray | None, most: int) -> Iterator[pa.RecordBatch]:
    """Documents of each wanted term, or of the most frequent terms of each shard, added up over the shards of a task."""
    total: dict[int, int] = {}
    for batch in batches:
        for blob in batch.column("body"):
            p = Postings.read(blob.as_py())
            df = np.diff(p.edges).astype(np.int64)
            if wanted is None:
                at = np.argsort(-df, kind="stable")[:most]
            else:
                at = p.places(wanted)
                at = at[at >= 0]
            for t, n in zip(p.terms[at].tolist(), df[at].tolist(), strict=True):
                total[t] = total.get(t, 0) + n
    yield pa.RecordBatch.from_arrays([pa.array(np.array(list(total), dtype=np.uint64).view(np.int64)), pa.array(list(total.values()), pa.int64())], names=["term", "df"])


def _df(shards: DataFrame, wanted: np.ndarray | None = None, most: int = 0) -> DataFrame:
    rows = shards.select("body").mapInArrow(lambda b: _counts(b, wanted, most), "term bigint, df bigint")
    return rows.groupBy("term").agg(F.sum("df").alias("df"))


def _paired(batches: Iterable[pa.RecordBatch], frequent: np.ndarray, weights: list[int], stats: Stats) -> Iterator[pa.RecordBatch]:
    """Shards with the intersections of the frequent terms' lists: pair, its greatest joint impact, and the documents that have both."""
    for batch in batches:
        out = []
        for rows, body in zip(batch.column("rows"), batch.column("body"), strict=True):
            p = Postings.read(body.as_py())
            n, _ = _unpacked(rows.as_py(), "<u4", "<u1")
            m = stats.lengths(n)
            lists = [(p.list(x) if x >= 0 else None) for x in p.places(frequent).tolist()]
            dense = np.zeros((len(lists), len(n)), dtype=np.int64)
            for k, found in enumerate(lists):
                if found is not None:
                    dense[k, found[0]] = np.maximum(1, _impacts(weights[k], found[1], m[found[0]]))
            name, best, sizes, docs = [], [], [], [np.zeros(0, dtype=np.uint32)]
            for i in range(len(lists)):
                for j in range(i):
                    both = np.flatnonzero((dense[i] > 0) & (dense[j] > 0)) if lists[i] is not None and lists[j] is not None else ()
                    name.append(i * len(lists) + j)
                    best.append(int((dense[i][both] + dense[j][both]).max()) if len(both) else 0)
                    sizes.append(len(both))
                    if len(both):
                        docs.append(np.diff(both, prepend=0).astype(np.uint32))
            out.append(_packed(np.array(name, "<u4"), np.array(best, "<i8"), np.array(sizes, "<u4"), np.concatenate(docs).astype("<u4")))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], names=[*batch.schema.names, "pairs"])


def build(docs: DataFrame, settings: Settings | None = None) -> Index:
    """Index of every whole ``text`` of ``docs`` under its doc_id (an integer; null ids and repeated rows are documents of their own).

    Null and empty texts, and those without terms, have no postings and do not count in the number of documents. Other columns are not used.
    """
    s = settings or Settings()
    named = docs.select(F.col("doc_id").cast("bigint").alias("_wf_id"), "text")
    schema = "docs int, filled bigint, words bigint, ids binary, rows binary, body binary"
    plain = stored(named.mapInArrow(lambda b: _shards(b, s), schema).withColumn("shard", F.monotonically_increasing_id()), "postings")
    sums = plain.agg(F.coalesce(F.sum("filled"), F.lit(0)).alias("n"), F.coalesce(F.sum("words"), F.lit(0)).alias("l")).first()
    stats = Stats(int(sums.n), int(sums.l))
    # which terms are paired is a matter of speed only, so a shard names just its own most frequent ones
    top = _df(plain, most=4 * s.pair_terms).orderBy(F.desc("df"), "term").limit(s.pair_terms).select("term").collect()
    frequent = np.array(sorted(np.array([r.term for r in top], dtype=np.int64).view(np.uint64).tolist()), dtype=np.uint64)
    exact = {r.term: r.df for r in _df(plain, wanted=frequent).collect()}
    weights = [stats.weight(exact[t]) for t in frequent.view(np.int64).tolist()]
    out = plain.mapInArrow(lambda b: _paired(b, frequent, weights, stats), wider(plain, pairs="binary"))
    return Index(docs.sparkSession, stored(out, "index"), stats, frequent)


@dataclass
class _Best:
    """Best rows of one query so far: negative scores and ids with nulls last, in order; floor is the score that a document must reach."""

    k: int
    rows: list[tuple[int, bool, int]] = field(default_factory=list)

    @property
    def floor(self) -> int:
        return -self.rows[-1][0] if len(self.rows) == self.k else 1

    def add(self, rows: list[tuple[int, bool, int]]) -> None:
        self.rows = sorted(self.rows + rows)[: self.k]


class Shard:
    """One shard ready to be searched; impacts of a term and intersections of a pair are worked out once for all queries."""

    def __init__(self, ids: bytes, rows: bytes, body: bytes, pairs: bytes, index_terms: np.ndarray, stats: Stats, df: dict[int, int]):
        self.ids = _unpacked(ids, "<i8")[0]
        self.n, self.null = _unpacked(rows, "<u4", "<u1")
        self.m = stats.lengths(self.n)
        self.postings = Postings.read(body)
        self.stats, self.df = stats, df
        self.lists: dict[int, tuple[np.ndarray, np.ndarray, int]] = {}
        name, best, sizes, docs = _unpacked(pairs, "<u4", "<i8", "<u4", "<u4")
        ends = np.cumsum(sizes.astype(np.int64))
        terms = index_terms.tolist()
        self.frequent = set(terms)
        self.pairs = {}
        for x, (key, joint) in enumerate(zip(name.tolist(), best.tolist(), strict=True)):
            i, j = divmod(key, max(1, len(terms)))
            self.pairs[terms[i], terms[j]] = self.pairs[terms[j], terms[i]] = (joint, int(ends[x] - sizes[x]), int(ends[x]))
        self.pair_docs = docs

    def lookup(self, terms: np.ndarray) -> None:
        """Impacts of those of ``terms`` that the shard has."""
        for t, place in zip(terms.tolist(), self.postings.places(terms).tolist(), strict=True):
            if place >= 0:
                docs, tf = self.postings.list(place)
                impact = _impacts(self.stats.weight(self.df[t]), tf, self.m[docs])
                self.lists[t] = docs, impact, int(impact.max())

    def has_both(self, a: int, b: int) -> np.ndarray:
        """Documents that have both terms of a stored pair."""
        _, x, y = self.pairs[a, b]
        out = np.zeros(len(self.n), dtype=bool)
        out[np.cumsum(self.pair_docs[x:y], dtype=np.int64)] = True
        return out

    def units(self, terms: list[int]) -> list[tuple[int, tuple[int, ...]]]:
        """Terms, or pairs whose joint bound is below the sum of their bounds, with these bounds, least first; every term is in one."""
        left = [t for t in terms if t in self.lists]
        top = {t: self.lists[t][2] for t in left}
        gains = []
        frequent = [t for t in left if t in self.frequent]
        for i, a in enumerate(frequent):
            for b in frequent[:i]:
                joint = max(self.pairs[a, b][0], top[a], top[b])
                gains.append((joint - top[a] - top[b], joint, a, b))
        out, used = [], set()
        for gain, joint, a, b in sorted(gains):
            if gain < 0 and a not in used and b not in used:
                out.append((joint, (a, b)))
                used |= {a, b}
        return sorted(out + [(top[t], (t,)) for t in left if t not in used])

    def search(self, terms: list[int], best: _Best) -> None:
        units = self.units(terms)
        bounds = np.cumsum([0, *(u[0] for u in units)]).tolist()
        if not units or bounds[-1] < best.floor:
            return
        score = np.zeros(len(self.n), dtype=np.int64)
        floor, at = best.floor, len(units)
        while at and bounds[at] >= floor:  # essential: documents without any of these can't reach the threshold
            at -= 1
            for t in units[at][1]:
                docs, impact, _ = self.lists[t]
                score[docs] += impact
            floor = max(floor, self._least(score, best))
        found = np.flatnonzero(score)
        found = found[score[found] + bounds[at] >= floor]
        while at and len(found):
            at -= 1
            joint, unit = units[at]
            if len(unit) == 2:  # outside of the intersection one term at most adds to the score
                single = max(self.lists[t][2] for t in unit)
                found = found[score[found] + bounds[at] + np.where(self.has_both(*unit)[found], joint, single) >= floor]
            for t in unit:
                docs, impact, _ = self.lists[t]
                place = np.searchsorted(docs, found)
                place[place == len(docs)] = 0
                hit = docs[place] == found
                score[found[hit]] += impact[place[hit]]
            if len(found) > best.k:
                floor = max(floor, int(np.partition(score[found], -best.k)[-best.k]))
            found = found[score[found] + bounds[at] >= floor]
        found = found[score[found] > 0]
        best.add([(-int(score[d]), bool(self.null[d]), int(self.ids[d])) for d in found.tolist()])

    @staticmethod
    def _least(score: np.ndarray, best: _Best) -> int:
        """k documents of this shard reach at least this score."""
        return int(np.partition(score, -best.k)[-best.k]) if len(score) >= best.k else 0


def _searched(batches: Iterable[pa.RecordBatch], asked: dict[int, list[int]], index: tuple[np.ndarray, Stats, dict[int, int]], k: int) -> Iterator[pa.RecordBatch]:
    """The best documents of each query over the shards of a task."""
    best = {q: _Best(k) for q in asked}
    wanted = np.array(sorted({t for terms in asked.values() for t in terms}), dtype=np.uint64)
    try:
        for batch in batches:
            for row in range(batch.num_rows):
                shard = Shard(*(batch.column(c)[row].as_py() for c in ("ids", "rows", "body", "pairs")), *index)
                shard.lookup(wanted)
                for q, terms in asked.items():
                    shard.search(terms, best[q])
        flat = [(q, *r) for q, b in best.items() for r in b.rows]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in flat], pa.int64()), pa.array([None if r[2] else r[3] for r in flat], pa.int64()), pa.array([-r[1] for r in flat], pa.int64())],
            names=["_wf_q", "doc_id", "score"],
        )
    finally:
        free_memory()


def _asked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Different terms of each query."""
    for part, texts in text_slices(batches):
        text, term = terms_of([t.encode("utf-8", "replace") for t in texts])
        split = np.split(term, np.cumsum(np.bincount(text, minlength=len(texts)))[:-1])
        yield pa.RecordBatch.from_arrays(
            [part.column("_wf_q"), pa.array([np.unique(x).view(np.int64) for x in split], pa.list_(pa.int64()))], names=["_wf_q", "terms"]
        )


def search(index: Index, queries: DataFrame, item_id: str = "item_id", text: str = "text", settings: Settings | None = None) -> DataFrame:
    """item_id, rank, doc_id, score: the k documents of the index with the highest score above 0 for every row of ``queries``.

    Equal scores go by rising doc_id, null last. Every row of ``queries`` is a query of its own, whatever its id, so repeated rows get their
    ranks each; rows without terms get none. Queries are searched in blocks, each of bounded size in expectation, against all shards.
    """
    s = settings or Settings()
    rows = stored(queries.select(F.col(item_id).alias("item_id"), F.col(text).alias("text")).withColumn("_wf_q", F.monotonically_increasing_id()), "queries")
    asked = stored(rows.select("_wf_q", "text").mapInArrow(_asked, "_wf_q bigint, terms array<bigint>").where("size(terms) > 0"), "terms")
    size = asked.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0)).alias("n")).first().n
    blocks = -(-size // s.block_terms)
    found = index.spark.createDataFrame([], "_wf_q bigint, doc_id bigint, score bigint")
    for block in range(blocks):
        here = asked.where(F.pmod(F.xxhash64("_wf_q"), F.lit(blocks)) == block).collect()
        found = found.union(_block(index, {r._wf_q: np.array(r.terms, dtype=np.int64).view(np.uint64).tolist() for r in here}, s))
    rank = F.row_number().over(Window.partitionBy("_wf_q").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    ranked = found.withColumn("rank", rank).where(F.col("rank") <= s.k)
    return ranked.join(rows.select("_wf_q", "item_id"), "_wf_q").select("item_id", "rank", "doc_id", "score")


def _block(index: Index, asked: dict[int, list[int]], s: Settings) -> DataFrame:
    wanted = np.array(sorted({t for terms in asked.values() for t in terms}), dtype=np.uint64)
    df = {int(t): n for t, n in ((np.int64(r.term).view(np.uint64), r.df) for r in _df(index.shards, wanted=wanted).collect())}
    shipped = index.spark.sparkContext.broadcast((asked, (index.frequent, index.stats, df)))
    out = index.shards.select("ids", "rows", "body", "pairs").mapInArrow(lambda b: _searched(b, *shipped.value, s.k), "_wf_q bigint, doc_id bigint, score bigint")
    return stored(out, "found")
