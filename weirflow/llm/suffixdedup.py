"""Removal of byte strings that occur more than once, with suffix arrays.

Every window of ``span`` bytes is owned by its anchor, the GRAM-byte string with the smallest hash inside it. Windows with equal bytes
have equal anchors at the same place, so only windows of one anchor can be equal; windows that follow each other under one anchor form
a segment, their common stretch of text.

1. A count-min sketch of anchors lets only segments through whose anchor may occur twice. A task joins equal segments of its own first.
2. Segments are dealt by anchor. Each shard of a few megabytes gets a suffix array by Larsson-Sadakane refinement (sort by eight bytes,
   then double the sorted length inside groups that are still equal) and common prefixes by Kasai's rule, segments side by side.
   Neighbours that share ``span`` bytes or more form a class; a class with two windows is repeated.
3. An anchor with more text than one shard is dealt over several; those shards also emit each class once, and the classes of
   different shards are merged by binary search.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirflow.llm.common import stored, text_slices, wider
from weirflow.llm.countmin import CHUNK_BYTES, Shape, Sieve, Sketch, sketch
from weirflow.llm.hashing import mix, rolled

GRAM = 32
_PLACE_BITS = 20
_PIECE = 1 << (_PLACE_BITS - 1)
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_BYTES = mix(np.arange(256, dtype=np.uint64) + np.uint64(1))


@dataclass(frozen=True)
class Settings:
    """span: bytes of a window, at least GRAM; shard_bytes: most segment bytes in a suffix array, and of one anchor before it is dealt out."""

    span: int = 200
    shard_bytes: int = 2 << 20
    shape: Shape = Shape()


@dataclass
class Segments:
    """owner: text; start: first window in the text; windows: how many; anchor, check: two hashes of the anchor."""

    owner: np.ndarray
    start: np.ndarray
    windows: np.ndarray
    anchor: np.ndarray
    check: np.ndarray


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    size, out = 1, values
    while size * 2 <= width:
        out = np.minimum(out[:-size], out[size:])
        size *= 2
    return np.minimum(out[: len(values) - width + 1], out[width - size :]) if width > size else out


def segments_of(texts: list[bytes], span: int) -> Segments:
    """Segments of all texts. Texts above 2^19 bytes are taken in overlapping pieces, which own different windows."""
    parts: list[tuple[np.ndarray, ...]] = []
    group: list[tuple[int, int, bytes]] = []

    def flush() -> None:
        buffer = np.frombuffer(b"".join(p for _, _, p in group), dtype=np.uint8)
        if len(buffer) >= span:
            parts.append(_anchored(buffer, group, span))
        group.clear()

    held = 0
    for k, text in enumerate(texts):
        for a in range(0, max(1, len(text) - span + 1), _PIECE):
            piece = text[a : a + _PIECE + span - 1]
            if len(piece) >= span:
                group.append((k, a, piece))
                held += len(piece)
            if held > 1 << 20:
                flush()
                held = 0
    if group:
        flush()
    columns = zip(*parts, strict=True) if parts else [[]] * 5
    kinds = (np.int64, np.int64, np.int64, np.uint64, np.uint64)
    return Segments(*(np.concatenate([np.zeros(0, dtype=t), *c]) for c, t in zip(columns, kinds, strict=True)))


def _anchored(buffer: np.ndarray, group: list[tuple[int, int, bytes]], span: int) -> tuple[np.ndarray, ...]:
    sizes = np.array([len(p) for _, _, p in group], dtype=np.int64)
    begin = np.cumsum(sizes) - sizes
    values = _BYTES[buffer]
    grams = mix(rolled(values, GRAM, _BASES[0]))
    low = np.uint64((1 << _PLACE_BITS) - 1)
    place = (np.arange(len(grams), dtype=np.int64) - np.repeat(begin, sizes)[: len(grams)]).astype(np.uint64)
    # the hash's high bits order the grams, the place in the piece breaks ties to the left
    least = _sliding_least((grams & ~low) | place, span - GRAM + 1)
    piece = np.repeat(np.arange(len(group)), sizes)[: len(least)]
    begins = np.arange(len(least)) - begin[piece]
    valid = begins + span <= sizes[piece]
    at = np.flatnonzero(valid)
    anchor_at = begin[piece[at]] + (least[at] & low).astype(np.int64)
    new = np.ones(len(at), dtype=bool)
    new[1:] = (anchor_at[1:] != anchor_at[:-1]) | (at[1:] != at[:-1] + 1)
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(at)))
    rows, head = piece[at[first]], anchor_at[first]
    owner = np.array([k for k, _, _ in group], dtype=np.int64)[rows]
    base = np.array([a for _, a, _ in group], dtype=np.int64)[rows]
    return owner, base + begins[at[first]], count, grams[head], mix(rolled(values, GRAM, _BASES[1]))[head]


def _keys(span: int):
    def keys(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        found = segments_of(texts, span)
        return found.anchor, found.check

    return keys


def _candidates(batches: Iterable[pa.RecordBatch], parts: Sketch, s: Settings) -> Iterator[pa.RecordBatch]:
    """Segments with an anchor that may be repeated, equal ones of a chunk once with weight 2; ``segment`` is null for a settled one."""
    sieve = Sieve(parts, s.shape)
    names = ["anchor", "segment", "id", "h", "start", "windows", "weight"]
    for part, texts in text_slices(batches, limit=CHUNK_BYTES):
        raw = [t.encode("utf-8", "replace") for t in texts]
        found = segments_of(raw, s.span)
        keep = sieve.repeated(found.anchor, found.check)
        owners, starts, counts, anchors = (x[keep].tolist() for x in (found.owner, found.start, found.windows, found.anchor.view(np.int64)))
        first: dict[tuple[int, bytes], int] = {}
        kept: list[bytes | None] = []
        weights = [1] * len(owners)
        for i, (k, a, n, anchor) in enumerate(zip(owners, starts, counts, anchors, strict=True)):
            text = raw[k][a : a + n + s.span - 1]
            j = first.setdefault((anchor, text), i)
            kept.append(text if j == i else None)
            if j != i:
                weights[j] = 2
        ids, hashes = part.column("id").to_numpy(), part.column("h").to_numpy()
        yield pa.RecordBatch.from_arrays(
            [pa.array(anchors, pa.int64()), pa.array(kept, pa.binary()), pa.array(ids[owners] if owners else [], pa.int64()),
             pa.array(hashes[owners] if owners else [], pa.int64()), pa.array(starts, pa.int32()), pa.array(counts, pa.int32()), pa.array(weights, pa.int32())],
            names=names,
        )


def suffix_array(text: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of all suffixes of ``text`` by their first ``depth`` bytes or more, and groups equal in their first half of that.

    Also the first eight bytes of every suffix as one number. Larsson-Sadakane: a suffix's rank is the first place of its group;
    only groups with more than one suffix are sorted again, by the rank of what follows the bytes already sorted.
    """
    n = len(text)
    padded = np.concatenate([text, np.zeros(8, dtype=np.uint8)]).astype(np.uint64)
    eight = np.zeros(n, dtype=np.uint64)
    for k in range(8):
        eight = (eight << np.uint64(8)) | padded[k : k + n]
    order = np.argsort(eight, kind="stable")
    ordered = eight[order]
    new = np.ones(n, dtype=bool)
    new[1:] = ordered[1:] != ordered[:-1]
    place = np.arange(n, dtype=np.int64)
    rank = np.empty(n + 1, dtype=np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, place, 0))
    rank[n] = -1
    half, size = rank[:n].copy(), 8
    open_ = np.flatnonzero(~new | np.append(~new[1:], False))
    while size < depth and len(open_):
        half = rank[:n].copy()
        suffix = order[open_]
        key = rank[suffix] * (n + 1) + rank[np.minimum(suffix + size, n)] + 1
        by = np.argsort(key, kind="stable")
        key, suffix = key[by], suffix[by]
        order[open_] = suffix
        new = np.ones(len(open_), dtype=bool)
        new[1:] = key[1:] != key[:-1]
        rank[suffix] = open_[np.maximum.accumulate(np.where(new, np.arange(len(open_)), 0))]
        open_ = open_[~new | np.append(~new[1:], False)]
        size *= 2
    return order, half, eight


def common_prefixes(text: np.ndarray, order: np.ndarray, group: np.ndarray, eight: np.ndarray, starts: np.ndarray, sizes: np.ndarray, most: int) -> np.ndarray:
    """Bytes, up to ``most``, that each suffix shares with the one before it in ``order``; 0 where their ``group`` differs.

    Kasai: a suffix shares at least one byte less than its predecessor in the text did. That holds where those two differ within the
    sorted depth, which is ``most`` or more; beyond it ties are in text order, and the bound counts only for the very next pair of
    suffixes. The segments at ``starts`` advance together, one byte a step, and compare eight bytes at once.
    """
    n = len(text)
    before = np.full(n, -1, dtype=np.int64)
    before[order[1:]] = np.where(group[order[1:]] == group[order[:-1]], order[:-1], -1)
    out = np.zeros(n, dtype=np.int64)
    carry = np.zeros(len(starts), dtype=np.int64)
    lanes = np.arange(len(starts))
    for step in range(int(sizes.max()) if len(sizes) else 0):
        lanes = lanes[sizes[lanes] > step]
        at = starts[lanes] + step
        other = before[at]
        known = (other >= 0) & ((carry[lanes] < most) | (other == before[at - 1] + 1))
        length = np.where(known, np.maximum(carry[lanes] - 1, 0), 0)
        going = np.flatnonzero((other >= 0) & (length < most))
        while len(going):
            a, b = at[going] + length[going], other[going] + length[going]
            inside = np.maximum(a, b) < n
            x = np.where(inside, eight[np.minimum(a, n - 1)] ^ eight[np.minimum(b, n - 1)], np.uint64(1 << 63))
            # leading bytes of the difference that are zero; all eight if there is none
            equal = sum((x < np.uint64(1 << (8 * k))).astype(np.int64) for k in range(8))
            length[going] += equal
            going = going[(equal == 8) & (length[going] < most)]
        out[at] = np.minimum(length, most)
        carry[lanes] = length
    return out


def _class_weights(segments: list[bytes], windows: np.ndarray, weights: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For every window of different ``segments``: its segment, its place in it, its class (any number), the weight of the class."""
    text = np.frombuffer(b"".join(segments), dtype=np.uint8)
    sizes = np.fromiter(map(len, segments), dtype=np.int64, count=len(segments))
    starts = np.cumsum(sizes) - sizes
    order, group, eight = suffix_array(text, span)
    shared = common_prefixes(text, order, group, eight, starts, sizes, span)
    classes = np.empty(len(text), dtype=np.int64)
    classes[order] = np.cumsum(shared[order] < span)
    owner = np.repeat(np.arange(len(segments)), windows)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
    mine = classes[starts[owner] + place]
    total = np.bincount(mine, weights=weights[owner], minlength=int(classes.max()) + 1 if len(classes) else 1)
    return owner, place, mine, total[mine]


def _runs(places: np.ndarray) -> list[tuple[int, int]]:
    """Runs of consecutive numbers in a sorted array, as first and last."""
    cuts = np.flatnonzero(np.diff(places) > 1)
    return list(zip(places[np.append(0, cuts + 1)].tolist(), places[np.append(cuts, len(places) - 1)].tolist(), strict=True))


class _Shard:
    """Segments of whole anchors, or of one part of a dealt out anchor, up to some bytes."""

    def __init__(self, span: int):
        self.span = span
        self.rows: dict[tuple[int, int, bytes], list[tuple[int, int, int]]] = {}
        self.counts: dict[tuple[int, int, bytes], tuple[int, int]] = {}
        self.size = 0

    def add(self, anchor: int, part: int, segment: bytes, row: tuple[int, int, int], windows: int, weight: int) -> None:
        key = anchor, part, segment
        if key not in self.rows:
            self.rows[key], self.counts[key] = [], (windows, 0)
            self.size += len(segment)
        self.rows[key].append(row)
        self.counts[key] = windows, self.counts[key][1] + weight

    def result(self) -> tuple[list[tuple[int, int, int, int]], list[tuple]]:
        """Spans (id, h, first byte, end) and, for dealt out anchors, classes (k1, k2, part, id, h, first byte) to merge."""
        spans, classes = [], []
        by_anchor: dict[tuple[int, int], list] = {}
        for key in self.rows:
            by_anchor.setdefault(key[:2], []).append(key)
        mixed = []
        for (_, part), keys in by_anchor.items():
            if len(keys) > 1 or part >= 0:
                mixed += keys
            elif self.counts[keys[0]][1] > 1:  # one segment only: its windows are repeated with it
                spans += [(i, h, a, a + self.counts[keys[0]][0] + self.span - 1) for i, h, a in self.rows[keys[0]]]
        if not mixed:
            return spans, classes
        windows = np.array([self.counts[k][0] for k in mixed], dtype=np.int64)
        weights = np.array([self.counts[k][1] for k in mixed], dtype=np.float64)
        owner, place, label, total = _class_weights([k[2] for k in mixed], windows, weights, self.span)
        edges = np.cumsum(windows) - windows
        hit = total > 1
        for k, key in enumerate(mixed):
            repeated = np.flatnonzero(hit[edges[k] : edges[k] + windows[k]])
            for a, b in _runs(repeated) if len(repeated) else []:
                spans += [(i, h, s + a, s + b + self.span) for i, h, s in self.rows[key]]
        if any(k[1] >= 0 for k in mixed):
            classes = self._classes(mixed, owner, place, label)
        return spans, classes

    def _classes(self, mixed: list, owner: np.ndarray, place: np.ndarray, label: np.ndarray) -> list[tuple]:
        text = np.frombuffer(b"".join(k[2] for k in mixed), dtype=np.uint8)
        keys = [mix(rolled(_BYTES[text], self.span, b)).view(np.int64) for b in _BASES]
        sizes = np.array([len(k[2]) for k in mixed], dtype=np.int64)
        starts = np.cumsum(sizes) - sizes
        _, first = np.unique(label, return_index=True)
        out = []
        for w in first.tolist():
            key = mixed[owner[w]]
            if key[1] >= 0:
                at = starts[owner[w]] + place[w]
                i, h, s = self.rows[key][0]
                out.append((int(keys[0][at]), int(keys[1][at]), key[1], i, h, s + int(place[w])))
        return out


_SHARD_SCHEMA = "k1 bigint, k2 bigint, part int, id bigint, h bigint, first int, last int"


def _shards(batches: Iterable[pa.RecordBatch], s: Settings) -> Iterator[pa.RecordBatch]:
    """Runs the shards of a task. Rows come sorted by anchor and part; a shard ends between two of them once it is large enough."""
    names = ["k1", "k2", "part", "id", "h", "first", "last"]

    def emit(shard: _Shard) -> pa.RecordBatch:
        spans, classes = shard.result()
        rows = [(None, None, None, *x) for x in spans] + [(*x, None) for x in classes]
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32())
        columns = zip(*rows, strict=True) if rows else [[]] * 7
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds, strict=True)], names=names)

    shard, last = _Shard(s.span), None
    for batch in batches:
        for anchor, part, segment, i, h, a, n, w in zip(*(batch.column(c).to_pylist() for c in ("anchor", "part", "segment", "id", "h", "start", "windows", "weight")), strict=True):
            if (anchor, part) != last and shard.size >= s.shard_bytes:
                yield emit(shard)
                shard = _Shard(s.span)
            last = anchor, part
            shard.add(anchor, part, segment, (i, h, a), n, w)
    if shard.rows:
        yield emit(shard)


@dataclass
class _Run:
    """Classes sorted by two keys, their rows (id, h, first) and which were found in another shard."""

    k1: np.ndarray
    k2: np.ndarray
    rows: np.ndarray
    hit: np.ndarray


def _merged_runs(a: _Run, b: _Run) -> _Run:
    """Both runs in order, by binary search of one's keys in the other's; keys that both have are hits."""
    low, high = np.searchsorted(a.k1, b.k1, side="left"), np.searchsorted(a.k1, b.k1, side="right")
    at, going = low.copy(), np.flatnonzero(low < high)
    while len(going):
        same = going[a.k2[at[going]] == b.k2[going]]
        b.hit[same] = True
        a.hit[at[same]] = True
        at[going] += 1
        going = going[at[going] < high[going]]
    return _Run(*(np.insert(x, low, y, axis=0) for x, y in ((a.k1, b.k1), (a.k2, b.k2), (a.rows, b.rows), (a.hit, b.hit))))


def _merge(batches: Iterable[pa.RecordBatch], span: int) -> Iterator[pa.RecordBatch]:
    """Spans of the classes that two or more shards have. Runs are merged two by two, so each row moves about log2(shards) times."""
    held: dict[int, list[pa.RecordBatch]] = {}
    for batch in batches:
        parts = batch.column("part").to_numpy()
        for p in np.unique(parts).tolist():
            held.setdefault(p, []).append(batch.filter(pa.array(parts == p)))
    runs = []
    for part in sorted(held):
        k1, k2, *rows = (np.concatenate([b.column(c).to_numpy() for b in held[part]]) for c in ("k1", "k2", "id", "h", "first"))
        order = np.lexsort((k2, k1))
        runs.append(_Run(k1[order], k2[order], np.column_stack(rows)[order], np.zeros(len(order), dtype=bool)))
    while len(runs) > 1:
        runs = [_merged_runs(*runs[i : i + 2]) if i + 1 < len(runs) else runs[i] for i in range(0, len(runs), 2)]
    for run in runs:
        i, h, first = run.rows[run.hit].T
        yield pa.RecordBatch.from_arrays(
            [pa.array(i), pa.array(h), pa.array(first.astype(np.int32)), pa.array((first + span).astype(np.int32))], names=["id", "h", "first", "last"]
        )


_FIRST_ID = -(1 << 63)
MOST_BROADCAST = 100_000


def repeated_spans(docs: DataFrame, s: Settings) -> DataFrame:
    """id, h (key of a row), first, last: byte ranges covered by repeated windows; they may overlap and repeat."""
    parts = sketch(docs, _keys(s.span), s.shape)
    shipped = docs.sparkSession.sparkContext.broadcast(parts)
    keyed = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_FIRST_ID)).alias("id"), F.xxhash64("text").alias("h"), "text")
    schema = "anchor bigint, segment binary, id bigint, h bigint, start int, windows int, weight int"
    rows = stored(keyed.mapInArrow(lambda b: _candidates(b, shipped.value, s), schema), "segments")
    own = rows.where("segment IS NULL OR weight > 1").select("id", "h", F.col("start").alias("first"), F.expr(f"start + windows + {s.span - 1}").alias("last"))
    sent = rows.where("segment IS NOT NULL")
    heavy = sent.groupBy("anchor").agg(F.sum(F.length("segment")).alias("bytes")).where(F.col("bytes") > s.shard_bytes)
    heavy = stored(heavy.select("anchor", F.ceil(F.col("bytes") / s.shard_bytes).alias("parts")), "heavy")
    heavy = F.broadcast(heavy) if heavy.count() <= MOST_BROADCAST else heavy
    # a segment goes to one part by its own bytes, so that equal segments meet
    part = F.coalesce(F.pmod(F.xxhash64("segment"), F.col("parts")), F.lit(-1)).cast("int").alias("part")
    routed = sent.join(heavy, "anchor", "left").select("anchor", part, "segment", "id", "h", "start", "windows", "weight")
    sharded = routed.repartition("anchor", "part").sortWithinPartitions("anchor", "part").mapInArrow(lambda b: _shards(b, s), _SHARD_SCHEMA)
    found = stored(sharded, "shards")
    spans = found.where("k1 IS NULL").select("id", "h", "first", "last")
    classes = found.where("k1 IS NOT NULL").select("k1", "k2", "part", "id", "h", "first").repartition("k1")
    merged = classes.mapInArrow(lambda b: _merge(b, s.span), "id bigint, h bigint, first int, last int")
    return own.union(spans).union(merged)


def _cut(text: bytes, spans: list) -> tuple[bytes, int, int]:
    """What is left, bytes removed and maximal runs removed."""
    left, removed, runs, end, begin = [], 0, 0, 0, None
    for first, last in sorted(spans):
        if begin is None or first > end:
            if begin is not None:
                removed += end - begin
            left.append(text[end:first])
            begin, runs = first, runs + 1
            end = last
        end = max(end, last)
    if begin is not None:
        removed += end - begin
    left.append(text[end:])
    return b"".join(left), removed, runs


def deduplicate(docs: DataFrame, settings: Settings | None = None) -> DataFrame:
    """All columns of ``docs`` and n_bytes, n_removed, n_spans, kept (binary): the UTF-8 text without bytes of repeated windows.

    A window of ``span`` bytes is repeated if the same bytes start anywhere else in any row, overlaps included; windows are judged on
    the input and never cross rows. A null text is empty; a text shorter than a window keeps all bytes; repeated rows lose every window
    to each other. Columns of these names in ``docs`` are replaced; an empty table stays empty.
    """
    s = settings or Settings()
    added = ("n_bytes", "n_removed", "n_spans", "kept")
    rest = [c for c in docs.columns if c not in added]
    docs = docs.select(*rest)
    spans = repeated_spans(docs.select("doc_id", "text"), s)
    # a text of n bytes has at most n spans, so a list per row stays within a multiple of its text
    spans = spans.groupBy("id", "h").agg(F.array_sort(F.collect_set(F.struct("first", "last"))).alias("_wf_spans"))
    key = [F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_FIRST_ID)).alias("_wf_id"), F.xxhash64("text").alias("_wf_h")]
    found = spans.select(F.col("id").alias("_wf_id"), F.col("h").alias("_wf_h"), "_wf_spans")
    joined = docs.select("*", *key).join(found, ["_wf_id", "_wf_h"], "left").select(*rest, "_wf_spans")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches):
            raw = [t.encode("utf-8", "replace") for t in texts]
            lists = [[(x["first"], x["last"]) for x in v or ()] for v in part.column("_wf_spans").to_pylist()]
            cut = [_cut(t, v) for t, v in zip(raw, lists, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in rest), pa.array(list(map(len, raw)), pa.int64()), pa.array([c[1] for c in cut], pa.int64()),
                 pa.array([c[2] for c in cut], pa.int64()), pa.array([c[0] for c in cut], pa.binary())], names=[*rest, *added],
            )

    return joined.mapInArrow(run, wider(docs, n_bytes="bigint", n_removed="bigint", n_spans="bigint", kept="binary"))
