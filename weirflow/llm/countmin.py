"""Count-min sketch of 128-bit keys with counters that stop at two, built per task and merged slice by slice."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from weirflow.llm.common import text_slices
from weirflow.llm.hashing import mix

CHUNK_BYTES = 8 << 20
Keys = Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]


@dataclass(frozen=True)
class Shape:
    """cells, rows, slices: powers of two. The size, rows * cells / 8 bytes once merged, does not grow with the data.

    With far more keys than cells, more keys look repeated; none that is repeated is ever missed.
    """

    cells: int = 1 << 28
    rows: int = 2
    slices: int = 128


def _cell(k1: np.ndarray, k2: np.ndarray, row: int, cells: int) -> np.ndarray:
    return (mix(k1 + np.uint64(row + 1) * k2) & np.uint64(cells - 1)).astype(np.uint32)


def _pack(sorted_cells: np.ndarray) -> bytes:
    steps = np.diff(sorted_cells, prepend=np.uint32(0)).astype("<u4")
    return zstandard.compress(steps.view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def _unpack(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(blob), dtype=np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u4")[:, 0], dtype=np.uint32)


def _counted(batches: Iterable[pa.RecordBatch], keys: Keys, s: Shape, chunk: int) -> Iterator[pa.RecordBatch]:
    """Cells of this task's keys by row and slice: those counted, and those counted twice."""
    width = s.cells // s.slices
    for _, texts in text_slices(batches, limit=chunk):
        k1, k2 = keys([t.encode("utf-8", "replace") for t in texts])
        if not len(k1):
            continue
        for row in range(s.rows):
            cells, counts = np.unique(_cell(k1, k2, row, s.cells), return_counts=True)
            edges = np.searchsorted(cells, np.arange(s.slices + 1, dtype=np.int64) * width)
            parts = [(k, cells[a:b] - np.uint32(k * width), counts[a:b]) for k, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)) if b > a]
            yield pa.RecordBatch.from_arrays(
                [pa.array([row] * len(parts), pa.int32()), pa.array([k for k, _, _ in parts], pa.int32()),
                 pa.array([_pack(c) for _, c, _ in parts], pa.binary()), pa.array([_pack(c[n > 1]) for _, c, n in parts], pa.binary())],
                names=["row", "slice", "once", "twice"],
            )


def _added(batches: Iterable[pa.RecordBatch], s: Shape) -> Iterator[pa.RecordBatch]:
    """Sum of the slices that came to this task: a bit per cell, set if the cell counted at least twice."""
    size = s.cells // s.slices
    once: dict[tuple[int, int], np.ndarray] = {}
    twice: dict[tuple[int, int], np.ndarray] = {}
    for batch in batches:
        for row, part, a, b in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            key = row, part
            if key not in once:
                once[key], twice[key] = np.zeros(size, dtype=bool), np.zeros(size, dtype=bool)
            cells = _unpack(a)
            twice[key][cells[once[key][cells]]] = True
            once[key][cells] = True
            twice[key][_unpack(b)] = True
    for (row, part), bits in twice.items():
        blob = zstandard.compress(np.packbits(bits).tobytes(), 1)
        yield pa.RecordBatch.from_arrays([pa.array([row], pa.int32()), pa.array([part], pa.int32()), pa.array([blob], pa.binary())], names=["row", "slice", "bits"])


Sketch = list[tuple[int, int, bytes]]


def sketch(docs: DataFrame, keys: Keys, shape: Shape, chunk: int = CHUNK_BYTES) -> Sketch:
    """Compressed bit slices of the merged sketch of ``keys`` over every whole ``text``; at most rows * cells / 8 bytes come to the driver."""
    parts = docs.select("text").mapInArrow(lambda b: _counted(b, keys, shape, chunk), "row int, slice int, once binary, twice binary")
    merged = parts.repartition("row", "slice").mapInArrow(lambda b: _added(b, shape), "row int, slice int, bits binary")
    return [(r.row, r.slice, bytes(r.bits)) for r in merged.collect()]


class Sieve:
    """Answers which keys may occur twice or more."""

    def __init__(self, parts: Sketch, shape: Shape):
        self.shape = shape
        size = shape.cells // shape.slices // 8
        self.bits = [np.zeros(shape.cells // 8, dtype=np.uint8) for _ in range(shape.rows)]
        for row, part, blob in parts:
            self.bits[row][part * size : (part + 1) * size] = np.frombuffer(zstandard.decompress(blob), dtype=np.uint8)

    def repeated(self, k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
        """Places of the keys that may be repeated; includes all that are."""
        found = np.arange(len(k1))
        for row in range(self.shape.rows):
            cell = _cell(k1[found], k2[found], row, self.shape.cells)
            found = found[(self.bits[row][cell >> np.uint32(3)] >> (np.uint8(7) - (cell & np.uint32(7)).astype(np.uint8))) & 1 > 0]
        return found
