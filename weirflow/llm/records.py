"""Token ids as length-delimited binary records with a separate offset index.

A data file is a row of records:

    length   unsigned 64 bits, little-endian, bytes of the payload
    check    unsigned 32 bits, masked CRC-32 of the eight length bytes
    payload  the ids, unsigned, 16 bits each where the vocabulary fits, else 32 bits, little-endian
    check    unsigned 32 bits, masked CRC-32 of the payload

The mask is a rotation by 15 bits and an added constant, so that checksums of data that holds checksums stay independent. Next to every
data file lies an index with one fixed-size entry per record (document, offset, tokens), so that records can be read in any order.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from weirflow.llm.common import text_slices

END = 0
BLANK = "Ġ"  # fixed value: how byte-level vocabularies write a blank
MASK_DELTA = 0xA282EAD8  # fixed value of the masked checksum format
ENTRY = np.dtype([("doc_id", "<i8"), ("null", "u1"), ("width", "u1"), ("offset", "<u8"), ("tokens", "<u4")])
READ_BYTES = 8 << 20
CACHED_WORDS = 600_000
JOINED_WORDS = 500
_HEAD = struct.Struct("<QI")
_CHECK = struct.Struct("<I")


def masked(data) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + MASK_DELTA) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    size = struct.pack("<Q", len(payload))
    return b"".join((size, _CHECK.pack(masked(size)), payload, _CHECK.pack(masked(payload))))


def unframe(data: memoryview, at: int = 0) -> tuple[memoryview, int]:
    """Payload of the record at ``at`` and the offset after it; raises on a wrong checksum or a cut record."""
    if len(data) < at + 12:
        raise ValueError(f"record at {at} is cut off")
    size, check = _HEAD.unpack_from(data, at)
    if masked(data[at : at + 8]) != check:
        raise ValueError(f"length of the record at {at} is damaged")
    end = at + 12 + size
    if len(data) < end + 4:
        raise ValueError(f"record at {at} is cut off")
    payload = data[at + 12 : end]
    if masked(payload) != _CHECK.unpack_from(data, end)[0]:
        raise ValueError(f"payload of the record at {at} is damaged")
    return payload, end + 4


def _runs(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of runs that begin at ``starts``, one after the other."""
    at = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
    at += np.arange(len(at))
    return at


def _visible(char: str) -> bool:
    return char.isalnum() or "!" <= char <= "~"


class WordEncoder:
    """The library's ids of whole texts, with each different word of a batch encoded once and the words of late remembered.

    Between two visible characters the byte-level pre-tokenizer starts a token at a single blank and makes a single line feed a token,
    so the parts between them can be encoded on their own. A text with any other white space, or with the string of an added token, which
    the library turns into that token, is encoded as a whole.
    """

    def __init__(self, json: str):
        self.library = Tokenizer.from_str(json)
        self.added = [t.content for t in self.library.get_added_tokens_decoder().values() if t.content]
        vocabulary = self.library.get_vocab()
        self.width = 2 if len(vocabulary) <= 1 << 16 else 4
        self.begins, self.feeds = (np.zeros(max(vocabulary.values()) + 1, dtype=bool) for _ in range(2))
        self.begins[[i for t, i in vocabulary.items() if t.startswith(BLANK)]] = True
        self.feeds[np.frombuffer(self._ids(["\n"])[0], dtype=f"<u{self.width}")[0]] = True
        self.words = pa.array([], pa.large_string())
        self.alone, self.known = np.zeros(0, dtype=bool), np.zeros(0, dtype=f"<u{self.width}")
        self.starts, self.sizes = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)

    def _ids(self, texts: list[str]) -> list[bytes]:
        coded = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype=f"<u{self.width}").tobytes() for e in coded]

    def _joined(self, words: pa.Array, before: str) -> np.ndarray:
        """Ids of many words, each with ``before`` in front, as a few texts: one call costs less than one a word."""
        edges = pa.array([*range(0, len(words), JOINED_WORDS), len(words)], pa.int64())
        texts = pc.binary_join(pa.LargeListArray.from_arrays(edges, words), pa.scalar(before, pa.large_string())).to_pylist()
        return np.frombuffer(b"".join(self._ids([before + t for t in texts])), dtype=f"<u{self.width}")

    def _coded(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of parts of texts, those at the start of a line with its line feed: whether they can be encoded on their own, the ids of all that can, and where a
        part's ids begin and how many it has.

        A token that begins with a blank begins a word, and a line feed's token a line.
        """
        head = pc.starts_with(parts, "\n").to_numpy(zero_copy_only=False)
        words = pc.ascii_ltrim(parts, "\n")
        alone = pc.and_(pc.ascii_is_printable(words), pc.greater(pc.binary_length(words), 0)).to_numpy(zero_copy_only=False).copy()
        other = np.flatnonzero(~alone)
        alone[other] = [bool(w) and _visible(w[0]) and _visible(w[-1]) for w in words.take(pa.array(other)).to_pylist()]
        starts, sizes, known, before = np.zeros(len(parts), dtype=np.int64), np.zeros(len(parts), dtype=np.int64), [], 0
        for some, mark, begins in ((alone & ~head, " ", self.begins), (alone & head, "\n", self.feeds)):
            at = np.flatnonzero(some)
            ids = self._joined(words.take(pa.array(at)), mark)
            first = np.flatnonzero(begins[ids])
            if len(first) != len(at):
                raise ValueError("the tokenizer does not begin a token at every blank or line feed")
            starts[at], sizes[at] = before + first, np.diff(first, append=len(ids))
            known.append(ids)
            before += len(ids)
        return alone, np.concatenate(known), starts, sizes

    def encode(self, texts: list[str]) -> list[bytes]:
        special = {k for k, t in enumerate(texts) if any(a in t for a in self.added)}
        if special:
            rest = iter(self.encode([t for k, t in enumerate(texts) if k not in special]))
            at_once = iter(self._ids([texts[k] for k in sorted(special)]))
            return [next(at_once if k in special else rest) for k in range(len(texts))]
        # every part stands after a blank or, at the start of a line, after a line feed, which it keeps
        parts = pc.split_pattern(pa.array(["\n" + t.replace("\n", " \n") for t in texts], pa.large_string()), " ")
        found = parts.flatten().dictionary_encode()
        part, edges = self._learnt(found.dictionary)[found.indices.to_numpy()], parts.offsets.to_numpy()
        sizes = self.sizes[part]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        raw = self.known[_runs(self.starts[part], sizes)].tobytes()
        bounds = (ends[edges] * self.width).tolist()
        # without the line feed that was put before the text
        out = [raw[a + self.width : b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        lacking = np.concatenate([[0], np.cumsum(~self.alone[part])])[edges]
        whole = np.flatnonzero(np.diff(lacking)).tolist()
        for k, ids in zip(whole, self._ids([texts[k] for k in whole]), strict=True):
            out[k] = ids
        return out

    def _learnt(self, parts: pa.Array) -> np.ndarray:
        """Where the different ``parts`` are remembered; those not yet known are encoded. When there are too many, those that are not among ``parts`` are forgotten."""
        place = pc.index_in(parts, value_set=self.words).fill_null(-1).to_numpy().astype(np.int64)
        new = np.flatnonzero(place < 0)
        if len(self.words) + len(new) > CACHED_WORDS:
            kept = place[place >= 0]
            place[place >= 0] = np.arange(len(kept))
            self.words, self.alone, self.sizes = self.words.take(pa.array(kept)), self.alone[kept], self.sizes[kept]
            self.known = self.known[_runs(self.starts[kept], self.sizes)]
            self.starts = np.cumsum(self.sizes) - self.sizes
        added = parts.take(pa.array(new))
        alone, known, starts, sizes = self._coded(added)
        place[new] = len(self.words) + np.arange(len(new))
        self.words, self.alone = pa.concat_arrays([self.words, added]), np.concatenate([self.alone, alone])
        self.starts, self.sizes = np.concatenate([self.starts, starts + len(self.known)]), np.concatenate([self.sizes, sizes])
        self.known = np.concatenate([self.known, known])
        return place


_ENCODERS: dict[int, WordEncoder] = {}


def _encoder(json: str) -> WordEncoder:
    key = hash(json)
    if key not in _ENCODERS:
        _ENCODERS[key] = WordEncoder(json)
    return _ENCODERS[key]


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


def _put(store: fs.FileSystem, made: str, final: str) -> None:
    """Moves a finished file to its name; a repeated task writes the same bytes."""
    if store.get_file_info(final).type != fs.FileType.NotFound:
        store.delete_file(final)
    store.move(made, final)


def write(docs: DataFrame, path: str, tokenizer_json: str) -> list[tuple[int, int, int]]:
    """Writes the ids of every whole ``text`` (null: empty), each with the end id, under ``path`` in ascending doc_id order.

    Returns (part, records, tokens) per file, in order. Null ids come first; rows under one id follow by hash of their text; equal rows
    are interchangeable. ``path`` is a URI that all executors reach. An empty table writes no file.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(tokenizer_json)
    laid = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64("text").alias("h"))
    laid = laid.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h").select("doc_id", "text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _encoder(shipped.value)
        end = END.to_bytes(coder.width, "little")
        store, root = _opened(path)
        part, records, tokens, offset, entries, out = TaskContext.get().partitionId(), 0, 0, 0, [], None
        names = [f"{root}/part-{part:06d}.{kind}" for kind in ("rec", "idx")]
        made = [f"{root}/.{part:06d}-{uuid.uuid4().hex}.{kind}" for kind in ("rec", "idx")]
        try:
            for batch, texts in text_slices(batches, 4 << 20):
                if out is None:
                    store.create_dir(root, recursive=True)
                    out = store.open_output_stream(made[0])
                framed = [frame(ids + end) for ids in coder.encode(texts)]
                index = np.zeros(len(framed), dtype=ENTRY)
                sizes = np.array([len(f) for f in framed], dtype=np.int64)
                ids = batch.column("doc_id")
                index["doc_id"], index["null"] = ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False)
                index["width"], index["tokens"] = coder.width, (sizes - 16) // coder.width
                index["offset"] = offset + np.cumsum(sizes) - sizes
                out.write(b"".join(framed))
                entries.append(index.tobytes())
                offset += int(sizes.sum())
                records += len(framed)
                tokens += int(index["tokens"].sum())
        finally:
            if out is not None:
                out.close()
        if records:
            with store.open_output_stream(made[1]) as f:
                f.write(b"".join(entries))
            for a, b in zip(made, names, strict=True):
                _put(store, a, b)
            yield pa.RecordBatch.from_arrays([pa.array([part]), pa.array([records]), pa.array([tokens])], names=["part", "records", "tokens"])

    files = laid.mapInArrow(run, "part bigint, records bigint, tokens bigint")
    return sorted((r.part, r.records, r.tokens) for r in files.collect())


def index_of(path: str, part: int) -> np.ndarray:
    store, root = _opened(path)
    with store.open_input_file(f"{root}/part-{part:06d}.idx") as f:
        return np.frombuffer(f.read(), dtype=ENTRY)


def records_of(path: str, part: int, index: np.ndarray) -> Iterator[np.ndarray]:
    """Ids of the records of ``index``, which may be any part of the file's index in any order; neighbours are read together."""
    store, root = _opened(path)
    sizes = 16 + index["tokens"].astype(np.int64) * index["width"]
    starts = index["offset"].astype(np.int64)
    with store.open_input_file(f"{root}/part-{part:06d}.rec") as f:
        a = 0
        while a < len(index):
            b = a + 1
            while b < len(index) and starts[b] == starts[b - 1] + sizes[b - 1] and starts[b] + sizes[b] - starts[a] <= READ_BYTES:
                b += 1
            data = memoryview(f.read_at(int(starts[b - 1] + sizes[b - 1] - starts[a]), int(starts[a])))
            at = 0
            for k in range(a, b):
                payload, at = unframe(data, at)
                yield np.frombuffer(payload, dtype=f"<u{index['width'][k]}")
            a = b


def read(spark: SparkSession, path: str, files: list[tuple[int, int, int]]) -> DataFrame:
    """Per record, in any order of rows: doc_id, start (ids of all records before it), n_tokens, ids_crc32 (of 32-bit ids)."""
    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    if not files:
        return spark.createDataFrame([], schema)
    before, rows = 0, []
    for part, _, tokens in files:
        rows.append((part, before))
        before += tokens
    listed = spark.createDataFrame(rows, "part bigint, base bigint").repartitionByRange(len(rows), "part")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, base in zip(batch.column("part").to_pylist(), batch.column("base").to_pylist(), strict=True):
                index = index_of(path, part)
                counts = index["tokens"].astype(np.int64)
                sums = [zlib.crc32(ids.astype("<u4").tobytes()) for ids in records_of(path, part, index)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(index["doc_id"], mask=index["null"].astype(bool)), pa.array(base + np.cumsum(counts) - counts), pa.array(counts), pa.array(sums, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return listed.mapInArrow(run, schema)
