import random

import numpy as np
import pytest
from fixtures import by_id, frame, words_of

from weirflow.llm import windowdedup
from weirflow.llm.countmin import Shape
from weirflow.llm.hashing import mix
from weirflow.llm.repeats import Filter, found_twice


def test_unique_windows_do_not_pass_a_filter_smaller_than_their_number(spark):
    """40,000 windows, 2 * 4,096 cells, a passage in two texts. Counters of all windows were full here and let nearly every window pass."""
    rng = random.Random(11)
    texts = [" ".join(words_of(rng, 400, "abcdefghijklmnop", 9)) for _ in range(100)]
    passage = " ".join(words_of(rng, 30, "qrstuvw", 9))
    texts[7], texts[80] = f"{texts[7]} {passage}", f"{passage} {texts[80]}"
    raw = [t.encode() for t in texts]
    s = windowdedup.Settings(width=20, shape=Shape(cells=1 << 12, rows=2, slices=8))
    sieve = Filter(found_twice(frame(spark, texts), windowdedup._keys(s.width), s.shape))
    owner, at, _, _ = windowdedup._passing(raw, s.width, sieve)
    assert {(7, 400 + i) for i in range(11)} | {(80, i) for i in range(11)} <= set(zip(owner.tolist(), at.tolist(), strict=True))
    assert len(owner) < 0.05 * sum(len(t.split()) - 19 for t in texts)


@pytest.mark.parametrize("cells", [64, 1 << 12, 1 << 20])
def test_no_key_that_occurs_twice_is_missed(spark, cells):
    """Each text is a list of numbers, its keys; some come twice in one text, some in two texts, most once."""
    keys = lambda texts: np.array([int(w) for t in texts for w in t.split()], dtype=np.uint64)
    texts = [" ".join(str(1000 * k + i) for i in range(200)) for k in range(20)]
    texts[3] += " 777777 777777"
    texts[5] += " 888888 4007"
    texts[19] += " 888888"
    sieve = Filter(found_twice(frame(spark, texts), keys, Shape(cells=cells, rows=2, slices=8)))
    assert sieve.repeated(np.array([777777, 888888, 4007], dtype=np.uint64)).all()
    others = sieve.repeated(mix(np.arange(10**9, 10**9 + 20_000, dtype=np.uint64)))
    assert others.mean() < (0.2 if cells == 64 else 0.01)


def test_anchor_that_comes_back_in_a_periodic_text_counts_again(spark):
    """A run of words that repeats itself has the same least hash in window after window; every period is another place."""
    texts = ["a b c " * 12, "x y " * 3 + "a b c " * 4, "a " * 30, "b " * 8]
    s = windowdedup.Settings(width=6, shape=Shape(cells=1 << 12, rows=2, slices=8))
    got = by_id(windowdedup.deduplicate(frame(spark, texts), s), "n_words", "n_removed")
    seen = set()
    for i, text in enumerate(texts):
        words, gone = text.split(), set()
        for k in range(len(words) - 5):
            window = tuple(words[k : k + 6])
            if window in seen:
                gone |= set(range(k, k + 6))
            seen.add(window)
        assert got[i] == (len(words), len(gone))


def test_filter_of_few_repeated_keys_is_small(spark):
    """However great its bound is: it was 2^20 bits here, whatever was in it, and 64 MB in every worker with the default shape."""
    keys = lambda texts: np.array([int(w) for t in texts for w in t.split()], dtype=np.uint64)
    texts = [" ".join(str(100 * k + i) for i in range(110)) for k in range(20)]
    found = found_twice(frame(spark, texts), keys, Shape(cells=1 << 19, rows=2, slices=8))
    assert found.slices * found.size <= 2 * 32 * 2 * 190
    sieve = Filter(found)
    twice = np.array([100 * k + i for k in range(1, 20) for i in range(10)], dtype=np.uint64)
    assert sieve.repeated(twice).all()
    assert sieve.repeated(np.arange(10**9, 10**9 + 20_000, dtype=np.uint64)).mean() < 0.02
