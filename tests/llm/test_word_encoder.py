import random
import sys

import numpy as np
import pytest
from fixtures import EDGE, words_of

from weirflow.llm import records
from weirflow.llm.queries import byte_tokenizer


def library_ids(coder, texts):
    return [np.array(e.ids, dtype=f"<u{coder.width}").tobytes() for e in coder.library.encode_batch(texts, add_special_tokens=False)]


def test_no_python_call_for_each_different_word():
    """20,000 different words: they were looked at one by one in Python, which took more CPU time than the library."""
    rng = random.Random(2)
    text = "\n".join(" ".join(words_of(rng, 20, "abcdefghijklmnopqrstuvwxyz.,", 12)) for _ in range(1000))
    coder, calls = records.WordEncoder(byte_tokenizer()), 0

    def count(frame, event, arg):
        nonlocal calls
        calls += event in ("call", "c_call")

    sys.setprofile(count)
    try:
        got = coder.encode([text])
    finally:
        sys.setprofile(None)
    assert got == library_ids(coder, [text])
    assert calls < 5000


@pytest.mark.parametrize("limit", [0, 40, 600_000])
def test_ids_stay_the_library_s_when_words_are_forgotten(monkeypatch, limit):
    monkeypatch.setattr(records, "CACHED_WORDS", limit)
    rng = random.Random(4)
    coder = records.WordEncoder(byte_tokenizer())
    odd = ["", " ", "\n", "a\n", "\na", "a \nb", "a\n\nb", "it's 's don't", "a\tb c\rd", "x y z", " ", "é à\nß", "a<|endoftext|>b", "漢字 😀\nx", "\x00 \x01\n\x7f"]
    for _ in range(6):
        texts = [t or "" for t in EDGE] + odd
        texts += ["".join(rng.choice(["a", "b", "Zz", "9", ".", ",", "'s", " ", " ", "\n", "é", "  ", "\t"]) for _ in range(rng.randrange(60))) for _ in range(60)]
        rng.shuffle(texts)
        assert coder.encode(texts) == library_ids(coder, texts)
    assert coder.encode([]) == []
