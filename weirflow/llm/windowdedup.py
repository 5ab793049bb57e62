"""Substring de-duplication over word windows with a prefilter of anchors.

The anchor of a window is the least hash of the shorter runs of words in it, so equal windows have equal anchors at equal places, and
neighbours mostly share theirs. First pass: anchors that occur at two places or more are found exactly and set bits of a filter
(``repeats``). Second pass: only windows whose anchor passes the filter are grouped exactly, by 96 bits of hash, to find the smallest
document that has them.
A task settles what it can among its own texts first, so a window sends one row per chunk of text however often it occurs.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirflow.llm.common import by_shuffle, byte_slices, marked, stored, text_slices, wider
from weirflow.llm.countmin import Shape
from weirflow.llm.hashing import Words, mix, rolled, words_of
from weirflow.llm.repeats import CHUNK_BYTES, Filter, Repeated, found_twice


@dataclass(frozen=True)
class Settings:
    """width: words of a window; shape: of the filter. With a filter too small for the data results stay the same, at more shuffle."""

    width: int = 20
    shape: Shape = Shape()


PIECE_BYTES = 1 << 18


RUN_BASE = 0x9E3779B97F4A7C15


def _pieces(texts: list[bytes]) -> Iterator[tuple[int, Words]]:
    """Words of about PIECE_BYTES of whole texts at a time, and the first of these texts: the arrays made from them are much greater than the result."""
    first = size = 0
    for i, text in enumerate(texts):
        size += len(text) + 1
        if size >= PIECE_BYTES or i + 1 == len(texts):
            yield first, words_of(texts[first : i + 1])
            first, size = i + 1, 0


def _anchors(found: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The anchor of every window, in the order of ``Words.windows``, and whether it lies at another place than that of the window before."""
    run = max(1, width // 2)
    hashes = mix(rolled(found.h1, run, RUN_BASE))
    least, done, span = hashes, 1, width - run + 1
    while done < span and len(least):
        step = min(done, span - done)
        least, done = np.minimum(least[:-step], least[step:]), done + step
    at = np.flatnonzero(found.text[: len(least)] == found.text[width - 1 :]) if len(least) else np.zeros(0, dtype=np.int64)
    owner, anchor = found.text[at], least[at]
    moved = np.ones(len(at), dtype=bool)
    # an anchor that is the first run of a window is not in the next one: an equal hash there is another place
    moved[1:] = (anchor[1:] != anchor[:-1]) | (hashes[at[:-1]] == anchor[:-1]) | (owner[1:] != owner[:-1])
    return anchor, moved


_NONE = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)


def _joined(parts: Iterable[tuple[np.ndarray, ...]]) -> list[np.ndarray]:
    return [np.concatenate(c) for c in zip(_NONE, *parts, strict=True)]


def _keys(width: int):
    def keys(texts: list[bytes]) -> np.ndarray:
        anchors = (_anchors(found, width) for _, found in _pieces(texts))
        return np.concatenate([np.zeros(0, np.uint64), *(a[moved] for a, moved in anchors)])

    return keys


def _passing(texts: list[bytes], width: int, sieve: Filter) -> list[np.ndarray]:
    """Text, first word and two hashes of the windows whose anchors may be repeated."""

    def parts() -> Iterator[tuple[np.ndarray, ...]]:
        for first, found in _pieces(texts):
            anchor, moved = _anchors(found, width)
            keep = sieve.repeated(anchor[moved])[np.cumsum(moved) - 1]
            owner, at, k1, k2 = (c[keep] for c in found.windows(width))
            yield owner + np.int32(first), at, k1, k2

    return _joined(parts())


def _planes(values: np.ndarray) -> bytes:
    """Bytes of equal weight together, which compresses better."""
    return values.view(np.uint8).reshape(len(values), -1).T.tobytes()


def _unplanes(data: memoryview, dtype: str, n: int) -> tuple[np.ndarray, memoryview]:
    size = np.dtype(dtype).itemsize * n
    return np.ascontiguousarray(np.frombuffer(data[:size], dtype=np.uint8).reshape(-1, n).T).view(dtype)[:, 0], data[size:]


def _pack(k1: np.ndarray, k2: np.ndarray, owner: np.ndarray, at: np.ndarray, ids: np.ndarray, hashes: np.ndarray) -> bytes:
    """Windows sorted by ``k1`` and the rows that own them, in one compressed block; 96 bits of each key are kept."""
    who, row = np.unique(owner, return_inverse=True)
    head = np.array([len(k1), len(who)], dtype="<u8").tobytes()
    body = [np.diff(k1, prepend=np.uint64(0)), k2.astype(np.uint32), row.astype(np.uint32), at.astype(np.uint32)]
    table = [np.diff(ids[who], prepend=np.int64(0)), hashes[who]]
    return zstandard.compress(head + b"".join(map(_planes, body + table)), 1)


def _unpack(blob: bytes) -> tuple[np.ndarray, ...]:
    data = memoryview(zstandard.decompress(blob))
    n, rows = np.frombuffer(data[:16], dtype="<u8").tolist()
    data = data[16:]
    out = []
    for dtype, count in (("<u8", n), ("<u4", n), ("<u4", n), ("<u4", n), ("<i8", rows), ("<i8", rows)):
        values, data = _unplanes(data, dtype, count)
        out.append(values)
    k1, k2, row, at, ids, hashes = out
    return np.cumsum(k1, dtype=np.uint64), k2, np.cumsum(ids, dtype=np.int64)[row], hashes[row], at


def _pack_late(ids: np.ndarray, hashes: np.ndarray, at: np.ndarray, buckets: int) -> pa.RecordBatch:
    """Windows to remove, dealt by the row that owns them: one block per bucket of rows."""
    target = (hashes % buckets).astype(np.int32)
    order = np.lexsort((at, hashes, ids, target))
    ids, hashes, at, target = ids[order], hashes[order], at[order].astype(np.int32), target[order]
    cuts = np.flatnonzero(np.diff(target, prepend=-1))
    blocks = []
    for x in np.split(np.arange(len(ids)), cuts[1:]) if len(ids) else []:
        head = np.array([len(x)], dtype="<u8").tobytes()
        blocks.append(zstandard.compress(head + _planes(np.diff(ids[x], prepend=np.int64(0))) + _planes(hashes[x]) + _planes(at[x]), 1))
    return pa.RecordBatch.from_arrays([pa.array(target[cuts]), pa.array([True] * len(cuts), pa.bool_()), pa.array(blocks, pa.binary())], names=_SENT)


def _unpack_late(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    data = memoryview(zstandard.decompress(blob))
    n = int(np.frombuffer(data[:8], dtype="<u8")[0])
    ids, data = _unplanes(data[8:], "<i8", n)
    hashes, data = _unplanes(data, "<i8", n)
    return np.cumsum(ids, dtype=np.int64), hashes, _unplanes(data, "<i4", n)[0]


_SENT = ["bucket", "late", "block"]
_SENT_SCHEMA = "bucket int, late boolean, block binary"


def _candidates(batches: Iterable[pa.RecordBatch], repeated: Repeated, s: Settings, buckets: int) -> Iterator[pa.RecordBatch]:
    """Blocks of windows to group exactly, by bucket of their key, and windows that this chunk settles by itself."""
    sieve = Filter(repeated)
    for part, texts in byte_slices(batches, limit=CHUNK_BYTES):
        owner, at, k1, k2 = _passing(texts, s.width, sieve)
        if not len(owner):
            continue
        ids, hashes = part.column("id").to_numpy(), part.column("h").to_numpy()
        # by key, then id, then row and place: the first row of a key is the only one that another chunk may still remove
        order = np.lexsort((at, owner, ids[owner], k2, k1))
        owner, at, k1, k2 = owner[order], at[order], k1[order], k2[order]
        new_key = np.ones(len(order), dtype=bool)
        new_key[1:] = (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])
        least = ids[owner][np.flatnonzero(new_key)][np.cumsum(new_key) - 1]
        new_row = new_key.copy()
        new_row[1:] |= owner[1:] != owner[:-1]
        gone = (ids[owner] > least) | ~new_row
        keep = np.flatnonzero(~gone)
        bucket = (k1[keep] % np.uint64(buckets)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        keep, bucket = keep[order], bucket[order]
        edges = np.searchsorted(bucket, np.arange(buckets + 1))
        sent = [(k, keep[a:b]) for k, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)) if b > a]
        blocks = [_pack(k1[x], k2[x], owner[x], at[x], ids, hashes) for _, x in sent]
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in sent], pa.int32()), pa.array([False] * len(sent), pa.bool_()), pa.array(blocks, pa.binary())], names=_SENT)
        yield _pack_late(ids[owner[gone]], hashes[owner[gone]], at[gone], buckets)


def _by_bucket(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, list[bytes]]]:
    """Blocks of one bucket after the other; rows come sorted by bucket, and one bucket at a time is held."""
    current, blocks = None, []
    for batch in batches:
        for bucket, block in zip(batch.column("bucket").to_pylist(), batch.column("block").to_pylist(), strict=True):
            if bucket != current and blocks:
                yield current, blocks
                blocks = []
            current = bucket
            blocks.append(block)
    if blocks:
        yield current, blocks


def _grouped(batches: Iterable[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Windows that a smaller id has too, as blocks by the row that owns them."""
    for _, blocks in _by_bucket(batches):
        k1, k2, ids, hashes, at = (np.concatenate(c) for c in zip(*map(_unpack, blocks), strict=True))
        order = np.lexsort((ids, k2, k1))
        k1, k2, ids, hashes, at = k1[order], k2[order], ids[order], hashes[order], at[order]
        new = np.ones(len(k1), dtype=bool)
        new[1:] = (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])
        gone = ids > ids[np.flatnonzero(new)][np.cumsum(new) - 1]
        yield _pack_late(ids[gone], hashes[gone], at[gone], buckets)


def _per_row(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for every row of the input that loses windows."""
    for _, blocks in _by_bucket(batches):
        ids, hashes, at = (np.concatenate(c) for c in zip(*map(_unpack_late, blocks), strict=True))
        order = np.lexsort((at, hashes, ids))
        ids, hashes, at = ids[order], hashes[order], at[order].astype("<i4")
        new = np.ones(len(ids), dtype=bool)
        new[1:] = (ids[1:] != ids[:-1]) | (hashes[1:] != hashes[:-1])
        cuts = np.flatnonzero(new)
        ats = [x.tobytes() for x in np.split(at, cuts[1:])] if len(cuts) else []
        yield pa.RecordBatch.from_arrays([pa.array(ids[cuts]), pa.array(hashes[cuts]), pa.array(ats, pa.binary())], names=["id", "h", "ats"])


_FIRST_ID = -(1 << 63)


def repeated_windows(docs: DataFrame, s: Settings) -> DataFrame:
    """id, h (key of a row) and ``ats``, packed first words of its windows that start earlier elsewhere."""
    spark = docs.sparkSession
    shipped = spark.sparkContext.broadcast(found_twice(docs, _keys(s.width), s.shape))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_FIRST_ID)).alias("id"), F.xxhash64("text").alias("h"), "text")
    sent = keyed.mapInArrow(lambda b: _candidates(b, shipped.value, s, buckets), _SENT_SCHEMA)
    # windows that a chunk has settled take the same way as the blocks, in buckets of their own
    apart = sent.withColumn("bucket", F.when(F.col("late"), -1 - F.col("bucket")).otherwise(F.col("bucket")))
    found = apart.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(lambda b: _windows_or_late(b, buckets), _SENT_SCHEMA)
    return found.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_per_row, "id bigint, h bigint, ats binary")


def _windows_or_late(batches: Iterable[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    def windows() -> Iterator[pa.RecordBatch]:
        for batch in batches:
            late = batch.filter(batch.column("late"))
            if late.num_rows:
                passed.append(late.set_column(0, "bucket", pc.subtract(pc.negate(late.column("bucket")), pa.scalar(1, pa.int32()))))
            yield batch.filter(pc.invert(batch.column("late")))

    passed: list[pa.RecordBatch] = []
    for out in _grouped(windows(), buckets):
        yield from passed
        passed.clear()
        yield out
    yield from passed


def _removed(n: int, ats: bytes, width: int) -> np.ndarray:
    """Which of ``n`` words a removed window covers."""
    change = np.zeros(n + 1, dtype=np.int64)
    starts = np.unique(np.frombuffer(ats, dtype="<i4")).astype(np.int64)
    change[starts] += 1
    change[starts + width] -= 1
    return np.cumsum(change[:-1]) > 0


def deduplicate(docs: DataFrame, settings: Settings | None = None) -> DataFrame:
    """All columns of ``docs`` and n_words, n_removed, kept: the words not covered by a window that starts earlier, joined by blanks.

    Earlier: in a row with a smaller doc_id, or before in the same row; windows are judged on the input. Rows under one doc_id do not
    remove each other's windows; a null doc_id comes before all others. A null text has no words and kept is empty; texts shorter than a
    window keep all words. Columns of these names in ``docs`` are replaced; an empty table stays empty. Only rows that lose words, and a
    few others, are shuffled with their texts.
    """
    s = settings or Settings()
    added = ("n_words", "n_removed", "kept")
    rest = [c for c in docs.columns if c not in added]
    docs = docs.select(*rest)
    late = stored(repeated_windows(docs.select("doc_id", "text"), s), "windows")
    key = [F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_FIRST_ID)).alias("_wf_id"), F.xxhash64("text").alias("_wf_h")]
    found = late.select(F.col("id").alias("_wf_id"), F.col("h").alias("_wf_h"), F.col("ats").alias("_wf_ats"))
    sifted = marked(docs.select("*", *key), found, ["_wf_id", "_wf_h"], "_wf_cut")
    whole = sifted.where("NOT _wf_cut").select(*rest, F.lit(None).cast("binary").alias("_wf_ats"))
    joined = whole.union(sifted.where("_wf_cut").join(by_shuffle(found), ["_wf_id", "_wf_h"], "left").select(*rest, "_wf_ats"))

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches):
            totals, removed, kept = [], [], []
            for text, ats in zip(texts, part.column("_wf_ats").to_pylist(), strict=True):
                words = text.encode("utf-8", "replace").split()
                if ats:
                    gone = _removed(len(words), ats, s.width)
                    words = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
                    removed.append(int(gone.sum()))
                else:
                    removed.append(0)
                totals.append(len(words) + removed[-1])
                kept.append(b" ".join(words).decode("utf-8"))
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in rest), pa.array(totals, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())], names=[*rest, *added]
            )

    return joined.mapInArrow(cut, wider(docs, n_words="bigint", n_removed="bigint", kept="string"))
