"""Which of very many keys occur twice or more, as a filter of fixed size.

Every task sends the different keys of its texts, cut to KEY_BITS bits of their hash, as sorted blocks; equal ones meet in a slice of the
key space, and those found twice set bits of the filter. So the filter, unlike the counters of ``countmin``, is filled by repeated keys
only: unique ones beside them pass by chance, and the chance does not rise with their own number. None that is repeated is ever missed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from weirflow.llm.common import byte_slices
from weirflow.llm.countmin import Shape
from weirflow.llm.hashing import mix

KEY_BITS = 40
CHUNK_BYTES = 4 << 20
SPARE = 32
_KEY_BYTES = KEY_BITS // 8
Keys = Callable[[list[bytes]], np.ndarray]


def _pack(values: np.ndarray) -> bytes:
    """Sorted keys as steps, bytes of equal weight together."""
    steps = np.diff(values, prepend=np.uint64(0)).astype("<u8")
    return zstandard.compress(steps.view(np.uint8).reshape(-1, 8)[:, :_KEY_BYTES].T.tobytes(), 1)


def _unpack(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(blob), dtype=np.uint8).reshape(_KEY_BYTES, -1)
    steps = np.zeros((planes.shape[1], 8), dtype=np.uint8)
    steps[:, :_KEY_BYTES] = planes.T
    return np.cumsum(steps.view("<u8")[:, 0], dtype=np.uint64)


def _cut(keys: np.ndarray) -> np.ndarray:
    return mix(keys) >> np.uint64(64 - KEY_BITS)


@dataclass(frozen=True)
class Repeated:
    """Compressed slices (number, bits) of the filter; ``size`` bits a slice, ``rows`` bits a key."""

    parts: list[tuple[int, bytes]]
    slices: int
    size: int
    rows: int

    def places(self, cut: np.ndarray, row: int) -> np.ndarray:
        return mix(cut + np.uint64((row + 1) << KEY_BITS)) & np.uint64(self.size - 1)


class Filter:
    """Answers which keys may occur twice or more."""

    def __init__(self, found: Repeated):
        self.found = found
        self.bits = np.zeros(found.slices * found.size // 8, dtype=np.uint8)
        for part, blob in found.parts:
            self.bits[part * found.size // 8 : (part + 1) * found.size // 8] = np.frombuffer(zstandard.decompress(blob), dtype=np.uint8)

    def repeated(self, keys: np.ndarray) -> np.ndarray:
        """Whether each key may be repeated; true for all that are."""
        f, cut, passed = self.found, _cut(keys), np.ones(len(keys), dtype=bool)
        base = (cut >> np.uint64(_low_bits(f.slices))) * np.uint64(f.size)
        for row in range(f.rows):
            at = base + f.places(cut, row)
            passed &= (self.bits[at >> np.uint64(3)] >> (np.uint8(7) - (at & np.uint64(7)).astype(np.uint8))) & 1 > 0
        return passed


def _low_bits(slices: int) -> int:
    return KEY_BITS - (slices.bit_length() - 1)


def _sent(batches: Iterable[pa.RecordBatch], keys: Keys, slices: int) -> Iterator[pa.RecordBatch]:
    """The different keys of each chunk of texts by slice, and those of them that the chunk has twice."""
    bounds = np.arange(slices + 1, dtype=np.uint64) << np.uint64(_low_bits(slices))
    for _, texts in byte_slices(batches, limit=CHUNK_BYTES):
        found, counts = np.unique(_cut(keys(texts)), return_counts=True)
        edges = np.searchsorted(found, bounds).tolist()
        parts = [(k, found[a:b], counts[a:b]) for k, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)) if b > a]
        yield pa.RecordBatch.from_arrays(
            [pa.array([k for k, _, _ in parts], pa.int32()), pa.array([_pack(c) for _, c, _ in parts], pa.binary()), pa.array([_pack(c[n > 1]) for _, c, n in parts], pa.binary())],
            names=["slice", "once", "twice"],
        )


def _twice(batches: Iterable[pa.RecordBatch], empty: Repeated) -> Iterator[pa.RecordBatch]:
    """Bits of the keys of each slice that two chunks have, or one chunk twice; rows come sorted by slice, and one slice at a time is held."""
    rows = (row for batch in batches for row in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True))
    for part, blocks in groupby(rows, itemgetter(0)):
        once, twice = zip(*((_unpack(a), _unpack(b)) for _, a, b in blocks), strict=True)
        values = np.sort(np.concatenate(once))
        again = np.concatenate([values[1:][values[1:] == values[:-1]], *twice])
        bits = np.zeros(empty.size, dtype=bool)
        for row in range(empty.rows):
            bits[empty.places(again, row)] = True
        blob = zstandard.compress(np.packbits(bits).tobytes(), 1)
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([int(bits.sum())]), pa.array([blob], pa.binary())], names=["slice", "n", "bits"])


def _folded(blob: bytes, size: int) -> bytes:
    """Bits of a slice cut to ``size``: places are the lowest bits of a hash, so the parts of a greater slice lie on each other."""
    bits = np.frombuffer(zstandard.decompress(blob), dtype=np.uint8)
    return zstandard.compress(np.bitwise_or.reduce(bits.reshape(-1, size // 8), axis=0).tobytes(), 1)


def found_twice(docs: DataFrame, keys: Keys, shape: Shape) -> Repeated:
    """Filter of the ``keys`` that every whole ``text`` together gives twice or more; rows * cells / 8 bytes come to the driver at most.

    It is folded as long as SPARE bits are left for each one that is set, so that few repeated keys take little memory of the tasks.
    """
    slices, size = shape.slices, shape.rows * shape.cells // shape.slices
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    while slices < tasks and size > 8:
        slices, size = 2 * slices, size // 2
    empty = Repeated([], slices, size, shape.rows)
    sent = docs.select("text").mapInArrow(lambda b: _sent(b, keys, slices), "slice int, once binary, twice binary")
    merged = sent.repartition("slice").sortWithinPartitions("slice").mapInArrow(lambda b: _twice(b, empty), "slice int, n bigint, bits binary")
    parts = [(r.slice, r.n, bytes(r.bits)) for r in merged.collect()]
    least = max(8, SPARE * sum(n for _, n, _ in parts) // slices)
    while size // 2 >= least:
        size //= 2
    return Repeated([(part, _folded(blob, size)) for part, _, blob in parts], slices, size, shape.rows)
