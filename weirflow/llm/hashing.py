"""Vectorised hashes of words and of runs of words or bytes."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_A, _B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit values; a bijection."""
    x = (x ^ (x >> np.uint64(30))) * _A
    x = (x ^ (x >> np.uint64(27))) * _B
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def rolled(values: np.ndarray, width: int, base: int) -> np.ndarray:
    """Polynomial hash of every ``width`` neighbouring values, by doubling."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    power, size, have, out, done = values.astype(np.uint64), 1, width, None, 0
    while have:
        if have & 1:
            if out is None:
                out, done = power, size
            else:
                m = len(values) - done - size + 1
                out = out[:m] * np.uint64(pow(base, size, 1 << 64)) + power[done : done + m]
                done += size
        have >>= 1
        if have:
            m = len(power) - size
            power = power[:m] * np.uint64(pow(base, size, 1 << 64)) + power[size : size + m]
            size *= 2
    return out[:n]


_BYTES = [mix(np.arange(256, dtype=np.uint64) + np.uint64(1 + 1000 * k)) for k in (1, 2)]
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


@dataclass
class Words:
    """Words (runs of bytes other than ASCII white space, or than the given breaks) of several texts: their text and two hashes each."""

    text: np.ndarray
    counts: np.ndarray
    h1: np.ndarray
    h2: np.ndarray

    def windows(self, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Text, first word within the text and two hashes of every ``width`` consecutive words of one text."""
        first = np.cumsum(self.counts) - self.counts
        k1, k2 = (mix(rolled(h, width, b)) for h, b in zip((self.h1, self.h2), _BASES, strict=True))
        at = np.flatnonzero(self.text[: len(k1)] == self.text[width - 1 :]) if len(k1) else np.zeros(0, dtype=np.int64)
        owner = self.text[at]
        return owner, at - first[owner], k1[at], k2[at]


def _blocks(buffer: np.ndarray, blank: np.ndarray, size: int):
    """Ranges of about ``size`` bytes that end after a blank, so that no word is cut."""
    start = 0
    while start < len(buffer):
        end = min(start + size, len(buffer))
        while end < len(buffer) and not blank[end - 1]:
            step = np.flatnonzero(blank[end : end + size])
            end = min(end + (int(step[0]) + 1 if len(step) else size), len(buffer))
        yield start, end
        start = end


def words_of(texts: list[bytes], block: int = 1 << 17, breaks: np.ndarray = _BLANK) -> Words:
    """Words of ``texts`` with their hashes, worked out block by block so that memory stays a small multiple of the texts.

    ``breaks`` marks the bytes between words, the line feed among them.
    """
    buffer = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    blank = breaks[buffer]
    tables = [np.where(breaks, np.uint64(0), t) for t in _BYTES]
    hashes: list[list[np.ndarray]] = [[], []]
    places = []
    for a, b in _blocks(buffer, blank, block):
        gap = blank[a:b]
        starts = np.flatnonzero(np.concatenate([[True], gap[:-1]]) & ~gap)
        if not len(starts):
            continue
        body = buffer[a + starts[0] : b]
        sizes = np.diff(np.append(starts, b - a))
        place = np.arange(len(body), dtype=np.int64) - np.repeat(starts - starts[0], sizes)
        for out, table, base in zip(hashes, tables, _BASES, strict=True):
            out.append(mix(np.add.reduceat(table[body] * _powers(base, int(sizes.max()))[place], starts - starts[0])))
        places.append(starts + a)
    starts = np.concatenate([np.zeros(0, dtype=np.int64), *places])
    ends = np.cumsum(np.fromiter(map(len, texts), dtype=np.int64, count=len(texts)) + 1)
    text = np.searchsorted(ends, starts, side="right").astype(np.int32)
    counts = np.bincount(text, minlength=len(texts)).astype(np.int64)
    none = np.zeros(0, dtype=np.uint64)
    return Words(text, counts, np.concatenate([none, *hashes[0]]), np.concatenate([none, *hashes[1]]))


def shingles(texts: list[bytes], width: int) -> list[np.ndarray]:
    """Sorted hashes of the different runs of ``width`` words of each text; a text of fewer words is one run, one without words has none."""
    found = words_of(texts)
    owner, _, k1, k2 = found.windows(width)
    values = mix(k1 ^ (k2 * np.uint64(2 * width + 1)))
    ends = np.cumsum(np.bincount(owner, minlength=len(texts))) if len(texts) else []
    out = [np.unique(v) for v in np.split(values, ends[:-1])] if len(texts) else []
    short = np.flatnonzero((found.counts > 0) & (found.counts < width))
    first = np.cumsum(found.counts) - found.counts
    for i in short.tolist():
        n = int(found.counts[i])
        h1, h2 = (mix(rolled(h[first[i] : first[i] + n], n, b)) for h, b in zip((found.h1, found.h2), _BASES, strict=True))
        out[i] = mix(h1 ^ (h2 * np.uint64(2 * n + 1)))
    return out
