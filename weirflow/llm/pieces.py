"""SentencePiece encoding and decoding with a given model; the ids are those of the library.

A batch's new words are sorted by length and words of one length advance together through a Viterbi search in numpy: at every end
position the hashes of all substrings ending there probe the sorted piece keys, and the maximum over them gives score and
backpointer. A second hash is compared along the path, so that a piece counts only where 128 bits agree.

In a unigram model the best path is the one with the greatest sum of scores. A model of merges (BPE) ranks merges instead: its
segmentation is the only path whose neighbouring pieces would not be merged otherwise, so there a piece may follow another only if the
merges of their joined text end in the two, and among such pieces the maximum is taken.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from weirflow.llm.common import text_slices, wider

SPACE = "▁"
UNKNOWN_PENALTY = 10.0  # fixed value: the library's penalty below the worst piece
UNKNOWN_TEXT = " ⁇ "  # fixed value: what the library shows for an unknown piece
LONG_WORD = 96
CACHED_WORDS = 100_000
PAIR_BITS = 20
_BASE, _CHECK = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_SIZE, _MASK = 0xBF58476D1CE4E5B9, (1 << 64) - 1
_SPREAD = np.uint64(0x94D049BB133111EB)


@dataclass(frozen=True)
class ModelFile:
    """A SentencePiece model as bytes, read on the driver and shipped with the task."""

    proto: bytes

    @staticmethod
    def read(path: str) -> ModelFile:
        with open(path, "rb") as f:
            return ModelFile(f.read())


class Merges:
    """Rules of a model of merges: the adjacent pair whose joined piece has the greatest score is merged first, the left one of equals."""

    def __init__(self, scores: dict[str, float]):
        self.scores = scores
        self.traces: dict[str, tuple[tuple[float, ...], bytes, bytes] | None] = {}

    def trace(self, piece: str) -> tuple[tuple[float, ...], bytes, bytes] | None:
        """Scores of the merges that make ``piece`` from its characters, and the lengths of its first and last symbol before each and after all.

        None for a piece that its own merges do not give.
        """
        if piece not in self.traces:
            symbols, done, firsts, lasts = list(piece), [], [1], [1]
            while len(symbols) > 1:
                joined = [self.scores.get(a + b, -np.inf) for a, b in zip(symbols, symbols[1:], strict=False)]
                k = int(np.argmax(joined))
                if joined[k] == -np.inf:
                    break
                symbols[k : k + 2] = [symbols[k] + symbols[k + 1]]
                done.append(joined[k])
                firsts.append(len(symbols[0]))
                lasts.append(len(symbols[-1]))
            self.traces[piece] = (tuple(done), bytes(firsts), bytes(lasts)) if len(symbols) == 1 and len(piece) < 256 else None
        return self.traces[piece]

    def whole(self, piece: str) -> bool:
        return self.trace(piece) is not None

    def apart(self, a: str, b: str) -> bool:
        """True if the merges of a + b end in exactly a and b, that is if none ever goes over the border."""
        (left, _, lasts), (right, firsts, _) = self.trace(a), self.trace(b)
        i = k = 0
        while True:
            over = self.scores.get(a[-lasts[i] :] + b[: firsts[k]], -np.inf)
            mine = left[i] if i < len(left) else -np.inf
            other = right[k] if k < len(right) else -np.inf
            if over > mine and over >= other:
                return False
            if mine == other == -np.inf:
                return True
            if mine >= other:
                i += 1
            else:
                k += 1


class Vocabulary:
    """Pieces, their scores and sorted hash keys."""

    def __init__(self, model: ModelFile):
        sp = sentencepiece.SentencePieceProcessor(model_proto=model.proto)
        size = sp.get_piece_size()
        self.unknown = sp.unk_id()
        self.byte_ids: dict[int, int] = {}
        self.ids: dict[str, int] = {}
        self.scores: dict[str, float] = {}
        self.surface: list[bytes] = []
        for i in range(size):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_ids[value] = i
                self.surface.append(bytes([value]))
            elif sp.is_unknown(i):
                self.surface.append(UNKNOWN_TEXT.encode())
            elif sp.is_control(i) or sp.is_unused(i):
                self.surface.append(b"")
            else:
                self.ids.setdefault(piece, i)
                self.scores.setdefault(piece, float(sp.get_score(i)))
                self.surface.append(piece.replace(SPACE, " ").encode())
        if any(SPACE in p.lstrip(SPACE) for p in self.ids):
            raise ValueError("a piece of this model goes over a word's start; words cannot be encoded on their own")
        probe = "a  b ﬁİ"
        if sp.normalize(probe) != SPACE + probe.replace(" ", SPACE):
            raise ValueError("this model normalises its text; only models that keep it are supported")
        self.lowest = min(self.scores.values()) - UNKNOWN_PENALTY
        self.longest = max(map(len, self.ids))
        # scores of merges are ranks, those of a unigram model logarithms
        self.merges = Merges(self.scores) if all(x == int(x) for x in self.scores.values()) else None
        names = [p for p in self.ids if self.merges is None or self.merges.whole(p)]
        keys = np.array([_key(p, _BASE) for p in names], dtype=np.uint64)
        order = np.argsort(keys)
        self.keys = keys[order]
        self.checks = np.array([_key(names[k], _CHECK) for k in order], dtype=np.uint64)
        self.pieces = [names[k] for k in order]
        self.place = {p: k for k, p in enumerate(self.pieces)}
        self.pair_keys = np.full(1 << PAIR_BITS, -1, dtype=np.int64)
        self.pair_fits = np.zeros(1 << PAIR_BITS, dtype=bool)
        self.key_scores = np.array([self.scores[names[k]] for k in order])
        self.key_ids = np.array([self.ids[names[k]] for k in order], dtype=np.int32)
        # most substrings are no pieces: a small table by the key's spread bits turns them away before the search
        bits = 4 + len(names).bit_length()
        self.seen_shift = np.uint64(64 - bits)
        self.seen = np.zeros(1 << bits, dtype=bool)
        self.seen[(self.keys * _SPREAD) >> self.seen_shift] = True
        # id of an ASCII character without a piece, -1 where it takes none or more than one
        self.ascii_ids = np.array([self.byte_ids.get(c, self.unknown) if self.byte_ids else self.unknown for c in range(128)], dtype=np.int32)

    def fits(self, before: np.ndarray, piece: np.ndarray) -> np.ndarray:
        """Whether each piece may follow the one before it (-1: the start of a word, or a character without a piece)."""
        pairs = (before.astype(np.int64) + 1) * (len(self.pieces) + 1) + piece
        slots = ((pairs.astype(np.uint64) * _SPREAD) >> np.uint64(64 - PAIR_BITS)).astype(np.int64)
        new = np.flatnonzero(self.pair_keys[slots] != pairs)
        out = self.pair_fits[slots]
        if len(new):
            asked, where = np.unique(pairs[new], return_inverse=True)
            known = []
            for x in asked.tolist():
                a, b = divmod(x, len(self.pieces) + 1)
                known.append(a == 0 or self.merges.apart(self.pieces[a - 1], self.pieces[b]))
            found = np.array(known, dtype=bool)[where]
            out[new] = found
            self.pair_keys[slots[new]], self.pair_fits[slots[new]] = pairs[new], found
        return out

    def spelt(self, path: list[int]) -> bytes:
        """Ids as little-endian 32-bit integers; a negative id is a character without a piece and becomes its bytes."""
        full: list[int] = []
        for i in path:
            if i >= 0:
                full.append(i)
            elif self.byte_ids:
                full += [self.byte_ids.get(b, self.unknown) for b in chr(-i - 1).encode("utf-8", "replace")]
            else:
                full.append(self.unknown)
        return np.array(full, dtype="<i4").tobytes()


def _codes(words: list[str]) -> np.ndarray:
    """Code points of words of one length, a row each."""
    return np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).reshape(len(words), -1)


def _prefixes(codes: np.ndarray, base: np.uint64) -> np.ndarray:
    out = np.zeros((codes.shape[0], codes.shape[1] + 1), dtype=np.uint64)
    for j in range(codes.shape[1]):
        out[:, j + 1] = out[:, j] * base + codes[:, j] + np.uint64(1)
    return out


def _key(piece: str, base: np.uint64) -> int:
    raw = int(_prefixes(_codes([piece]), base)[0, -1])
    return raw ^ (len(piece) * _SIZE & _MASK)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    return np.array([pow(int(base), k, 1 << 64) for k in range(n + 1)], dtype=np.uint64)


def viterbi(words: list[str], v: Vocabulary) -> list[bytes]:
    """Ids, as little-endian 32-bit integers, of words of one length.

    Of equal sums, the path whose last piece is longest wins, at every position. In a model of merges, a position that no path reaches
    is no end of a piece.
    """
    codes = _codes(words)
    rows, length = codes.shape
    prefix, other = _prefixes(codes, _BASE), _prefixes(codes, _CHECK)
    powers, other_powers = _powers(_BASE, v.longest), _powers(_CHECK, v.longest)
    best = np.full((rows, length + 1), -np.inf)
    best[:, 0] = 0
    back = np.zeros((rows, length + 1), dtype=np.int32)
    entry = np.full((rows, length + 1), -1, dtype=np.int32)
    each = np.arange(rows)
    for j in range(1, length + 1):
        sizes = np.arange(min(j, v.longest), 0, -1)
        hashes = (prefix[:, j, None] - prefix[:, j - sizes] * powers[sizes]) ^ (sizes.astype(np.uint64) * np.uint64(_SIZE))
        likely = np.flatnonzero(v.seen[(hashes * _SPREAD) >> v.seen_shift])
        asked = hashes.ravel()[likely]
        at = np.minimum(np.searchsorted(v.keys, asked), len(v.keys) - 1)
        true = v.keys[at] == asked
        found = np.full(hashes.size, -1, dtype=np.int32)
        found[likely[true]] = at[true]
        value = np.full(hashes.size, -np.inf)
        value[likely[true]] = v.key_scores[at[true]]
        found, value = found.reshape(hashes.shape), value.reshape(hashes.shape)
        if v.merges is not None:
            rows_at, size_at = np.nonzero(found >= 0)
            fit = v.fits(entry[rows_at, j - sizes[size_at]], found[rows_at, size_at])
            value[rows_at[~fit], size_at[~fit]] = -np.inf
        value[found[:, -1] < 0, -1] = v.lowest
        value += best[:, j - sizes]
        pick = value.argmax(axis=1)
        best[:, j], back[:, j], entry[:, j] = value[each, pick], sizes[pick], found[each, pick]
    ids = np.zeros((rows, length), dtype="<i4")
    used = np.zeros(rows, dtype=np.int64)
    place, active, odd = np.full(rows, length), each, np.zeros(rows, dtype=bool)
    while len(active):
        end = place[active]
        step, k = back[active, end], entry[active, end]
        begin = end - step
        check = (other[active, end] - other[active, begin] * other_powers[step]) ^ (step.astype(np.uint64) * np.uint64(_SIZE))
        char = codes[active, end - 1]
        lone = np.where(char < 128, v.ascii_ids[char & np.uint32(127)], -1)
        odd[active] |= np.where(k >= 0, v.checks[k] != check, lone < 0)
        used[active] += 1
        ids[active, length - used[active]] = np.where(k >= 0, v.key_ids[k], lone)
        place[active] = begin
        active = active[begin > 0]
    flat = ids[np.arange(length) >= length - used[:, None]].tobytes()
    ends = (np.cumsum(used) * 4).tolist()
    out = [flat[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]
    for row in np.flatnonzero(odd).tolist():
        out[row] = v.spelt(scalar(words[row], v))
    return out


def scalar(word: str, v: Vocabulary) -> list[int]:
    """The same search for one word, by dictionary; for very long words. A negative id is a character without a piece."""
    best, back = [0.0] + [-np.inf] * len(word), [0] * (len(word) + 1)
    for j in range(1, len(word) + 1):
        top, step = -np.inf, 1
        for n in range(min(j, v.longest), 0, -1):
            piece = word[j - n : j]
            s = v.scores.get(piece) if piece in v.place else None
            if s is not None and v.merges is not None and back[j - n]:
                before = word[j - n - back[j - n] : j - n]
                s = s if before not in v.place or v.merges.apart(before, piece) else None
            s = v.lowest if piece not in v.place and n == 1 else s
            if s is not None and best[j - n] + s > top:
                top, step = best[j - n] + s, n
        best[j], back[j] = top, step
    j, path = len(word), []
    while j:
        piece = word[j - back[j] : j]
        path.append(v.ids.get(piece, -ord(piece[-1]) - 1))
        j -= back[j]
    return path[::-1]


class Codec:
    """Encodes and decodes texts; remembers the words of late, in two generations, so that frequent ones stay."""

    def __init__(self, model: ModelFile):
        self.v = Vocabulary(model)
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def learn(self, words: set[str]) -> None:
        by_length: dict[int, list[str]] = {}
        for w in words:
            known = self.old.get(w)
            if known is None:
                by_length.setdefault(len(w), []).append(w)
            else:
                self.young[w] = known
        for length, group in by_length.items():
            if length > LONG_WORD:
                self.young.update((w, self.v.spelt(scalar(w, self.v))) for w in group)
                continue
            step = max(1, 400_000 // (length * self.v.longest))
            for a in range(0, len(group), step):
                part = group[a : a + step]
                self.young.update(zip(part, viterbi(part, self.v), strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        if len(self.young) > CACHED_WORDS:
            self.old, self.young = self.young, {}
        split = [_words(t) for t in texts]
        self.learn(set().union(*split) - self.young.keys())
        return [b"".join(map(self.young.__getitem__, words)) for words in split]

    def decode(self, ids: Iterable[int]) -> str:
        raw = b"".join(map(self.v.surface.__getitem__, ids)).decode("utf-8", "replace")
        return raw[1:] if raw.startswith(" ") else raw


def _words(text: str) -> list[str]:
    """Words with the space marks before them; put together they are the text as the model sees it."""
    if not text:
        return []
    parts = text.replace(SPACE, " ").split(" ")
    if "" not in parts:
        return [SPACE + p for p in parts]
    out, marks = [], ""
    for p in parts:
        marks += SPACE
        if p:
            out.append(marks + p)
            marks = ""
    return out + [marks] if marks else out


_CODECS: dict[int, Codec] = {}


def _codec(model: ModelFile) -> Codec:
    key = hash(model.proto)
    if key not in _CODECS:
        _CODECS[key] = Codec(model)
    return _CODECS[key]


def _lists(coded: list[bytes]) -> pa.ListArray:
    offsets = np.zeros(len(coded) + 1, dtype=np.int32)
    np.cumsum([len(c) // 4 for c in coded], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(coded), dtype="<i4")))


def _split(column: pa.ListArray) -> list[np.ndarray]:
    ends = np.cumsum(column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
    return np.split(column.flatten().to_numpy(zero_copy_only=False), ends[:-1])


def encode(docs: DataFrame, model: ModelFile, ids: str = "ids") -> DataFrame:
    """All columns of ``docs`` and the piece ids of the whole ``text``; a null or empty text has none.

    The space mark of the model inside a text counts as a space. A column of the name of ``ids`` is replaced; an empty table
    gives an empty table; repeated rows are encoded alike.
    """
    rest = [c for c in docs.columns if c != ids]
    docs = docs.select(*rest)
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shipped.value)
        for part, texts in text_slices(batches, 2 << 20):
            column = _lists(codec.encode(texts))
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in rest), column], names=[*rest, ids])

    return docs.mapInArrow(run, wider(docs, **{ids: "array<int>"}))


def decode(docs: DataFrame, model: ModelFile, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """All columns of ``docs`` and the text its ids stand for; null ids give a null text."""
    rest = [c for c in docs.columns if c != text]
    docs = docs.select(*rest)
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shipped.value)
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                column = part.column(ids)
                found = [codec.decode(x.tolist()) for x in _split(column)]
                valid = column.is_valid().to_pylist()
                out = pa.array([t if ok else None for t, ok in zip(found, valid, strict=True)], pa.string())
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in rest), out], names=[*rest, text])

    return docs.mapInArrow(run, wider(docs, **{text: "string"}))


def round_trip(docs: DataFrame, model: ModelFile) -> DataFrame:
    """``docs`` with ids, n_pieces, decoded_sha256 of the text that the ids decode to, and exact, whether that is the input (null: empty).

    Encoding and decoding share one pass over the texts. Columns of these names in ``docs`` are replaced.
    """
    added = ("ids", "n_pieces", "decoded_sha256", "exact")
    rest = [c for c in docs.columns if c not in added]
    docs = docs.select(*rest)
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shipped.value)
        for part, texts in text_slices(batches, 2 << 20):
            column = _lists(codec.encode(texts))
            decoded = [codec.decode(ids.tolist()) for ids in _split(column)]
            digests = [hashlib.sha256(t.encode()).hexdigest() for t in decoded]
            exact = [a == b for a, b in zip(decoded, texts, strict=True)]
            counts = column.value_lengths().cast(pa.int64())
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in rest), column, counts, pa.array(digests, pa.string()), pa.array(exact, pa.bool_())], names=[*rest, *added])

    return docs.mapInArrow(run, wider(docs, ids="array<int>", n_pieces="bigint", decoded_sha256="string", exact="boolean"))
