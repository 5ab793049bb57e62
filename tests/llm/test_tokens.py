"""Token records and SentencePiece."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from fixtures import EDGE, by_id, frame, words_of
from tokenizers import Tokenizer

from weirflow.llm import pieces, records
from weirflow.llm.queries import byte_tokenizer, piece_model
from weirflow.session import scratch_path

ODD = [
    "a b", " a", "a ", "a  b", "a   b", "a\n b", "a \nb", "a\tb c", "it's we're", "x y z", "1 2 3", "<|endoftext|> a", "é è​ ü", "　 x", "x" * 300 + " y",
    "!? a", "a  b", "\x1c a b", "a \x85b", "😀 😀",
]


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return t


def test_ids_are_those_of_the_library(library):
    rng = random.Random(1)
    texts = [t or "" for t in EDGE] + ODD + ["".join(rng.choice(" ab\n\t.,é1 ") for _ in range(40)) for _ in range(400)]
    got = records.WordEncoder(byte_tokenizer()).encode(texts)
    for t, x in zip(texts, got, strict=True):
        assert np.frombuffer(x, "<u2").tolist() == library.encode(t, add_special_tokens=False).ids, repr(t)


def test_records_round_trip(spark, library):
    texts = EDGE + ODD + [" ".join(words_of(random.Random(k), 200, "abcdefgh", 7)) for k in range(60)]
    ids = list(range(1000, 1000 + len(texts)))
    random.Random(2).shuffle(ids)
    path = scratch_path(spark, "records")
    docs = frame(spark, texts, ids).selectExpr("*", "1 AS start", "2 AS h", "3 AS part")
    files = records.write(docs, path, byte_tokenizer())
    got = by_id(records.read(spark, path, files), "start", "n_tokens", "ids_crc32")
    start = 0
    for i, t in sorted(zip(ids, texts, strict=True)):
        want = [*library.encode(t or "", add_special_tokens=False).ids, 0]
        assert got[i] == (start, len(want), zlib.crc32(np.array(want, dtype="<u4").tobytes()))
        start += len(want)
    # records in any order, through the index
    part, count, _ = files[0]
    index = records.index_of(path, part)
    at = list(range(count))
    random.Random(3).shuffle(at)
    by = dict(zip(ids, texts, strict=True))
    for k, found in zip(at, records.records_of(path, part, index[at]), strict=True):
        assert found.tolist() == [*library.encode(by[index[k]["doc_id"]] or "", add_special_tokens=False).ids, 0]


def test_record_edges(spark):
    path = scratch_path(spark, "records")
    files = records.write(frame(spark, ["b", "a", None, "b"], ids=[4, 4, None, 4]), path, byte_tokenizer())
    rows = sorted(tuple(r) for r in records.read(spark, path, files).select("start", "n_tokens", "doc_id").collect())
    assert rows == [(0, 1, None), (1, 2, 4), (3, 2, 4), (5, 2, 4)]
    empty = scratch_path(spark, "records")
    assert records.write(frame(spark, ["b"]).limit(0), empty, byte_tokenizer()) == []
    assert records.read(spark, empty, []).count() == 0


def test_damage_is_found():
    data = records.frame(b"abcd") + records.frame(b"")
    first, at = records.unframe(memoryview(data))
    assert bytes(first) == b"abcd" and bytes(records.unframe(memoryview(data), at)[0]) == b""
    for k in range(20):
        broken = bytearray(data)
        broken[k] ^= 1
        with pytest.raises(ValueError):
            records.unframe(memoryview(broken))
    with pytest.raises(ValueError):
        records.unframe(memoryview(data[:18]))


def brute_best(word, v):
    """Best sum over all segmentations, by trying every one."""
    best = {0: 0.0}
    for j in range(1, len(word) + 1):
        options = []
        for i in range(j):
            s = v.scores[word[i:j]] if word[i:j] in v.place else None
            if s is None and j - i == 1:
                s = v.lowest
            if s is not None:
                options.append(best[i] + s)
        best[j] = max(options)
    return best[len(word)]


def test_ids_are_those_of_sentencepiece():
    """A model of merges: whole documents, random strings, runs of blanks, long words."""
    library = sentencepiece.SentencePieceProcessor(model_proto=piece_model().proto)
    codec = pieces.Codec(piece_model())
    rng = random.Random(4)
    texts = [t or "" for t in EDGE] + [t for t in ODD if "▁" not in t] + ["in the " * 60, "aaaa" * 70, "ererer" * 40 + "\n" + " " * 9 + "x"]
    texts += ["".join(rng.choice("abeth  in.,\n1é漢") for _ in range(80)) for _ in range(400)]
    texts += ["".join(rng.choice("ersthion") for _ in range(150)) for _ in range(40)]
    for t, raw in zip(texts, codec.encode(texts), strict=True):
        assert np.frombuffer(raw, "<i4").tolist() == library.encode(t), repr(t)


def test_viterbi_finds_the_best_sum():
    """Without the rule of merges, as in a unigram model."""
    v = pieces.Vocabulary(piece_model())
    v.merges = None
    rng = random.Random(5)
    words = ["▁" + "".join(rng.choice("etaoinshrdé\n😀") for _ in range(7)) for _ in range(200)]
    surface = {i: p for p, i in v.ids.items()}
    for word, raw in zip(words, pieces.viterbi(words, v), strict=True):
        assert raw == v.spelt(pieces.scalar(word, v))
        got = sum(v.scores[surface[i]] if i in surface else 0 for i in np.frombuffer(raw, "<i4").tolist())
        unknown = sum(1 for i in pieces.scalar(word, v) if i < 0)
        assert got + unknown * v.lowest == brute_best(word, v)


def test_pieces_round_trip(spark):
    texts = EDGE + [t for t in ODD if "▁" not in t] + ["w" * 500 + " end"]
    docs = frame(spark, texts).selectExpr("*", "1 AS ids", "2 AS decoded", "3 AS exact")
    rows = {r.doc_id: r for r in pieces.decode(pieces.round_trip(docs, piece_model()), piece_model()).collect()}
    assert all(rows[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest() for i, t in enumerate(texts))
    assert all(rows[i].exact and rows[i].decoded == (t or "") for i, t in enumerate(texts))
    library = sentencepiece.SentencePieceProcessor(model_proto=piece_model().proto)
    assert all(library.decode(list(rows[i].ids)) == (t or "") for i, t in enumerate(texts))
    assert rows[0].n_pieces == 0 and rows[1].n_pieces == 0
    assert pieces.round_trip(docs.limit(0), piece_model()).count() == 0


def test_words_of_the_cache_generations(monkeypatch):
    monkeypatch.setattr(pieces, "CACHED_WORDS", 5)
    codec = pieces.Codec(piece_model())
    rng = random.Random(9)
    for _ in range(20):
        texts = [" ".join(words_of(rng, 12, "abc", 3)) for _ in range(3)]
        for t, x in zip(texts, codec.encode(texts), strict=True):
            assert codec.decode(np.frombuffer(x, "<i4").tolist()) == t


def test_null_ids_decode_to_null(spark):
    rows = spark.createDataFrame([(1, None), (2, [])], "doc_id bigint, ids array<int>")
    assert by_id(pieces.decode(rows, piece_model()), "decoded") == {1: (None,), 2: ("",)}
