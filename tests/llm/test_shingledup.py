"""Near copies by shingle similarity, against brute force."""

import random

import pytest
from fixtures import BLANKS, EDGE, by_id, frame, words_of

import corpus_pipeline
from weirflow.llm import shingledup
from weirflow.llm.countmin import Shape

TINY = Shape(cells=1 << 12, rows=2, slices=8)


def brute_set(text):
    words = BLANKS.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_kept(texts):
    sets = [brute_set(t) for t in texts]
    root = list(range(len(texts)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a == b or 9 * len(a & b) >= 4 * (len(a) + len(b)) > 0:
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {find(i) for i in root}


def planted(rng):
    """Copies with one run of words changed, of similarity 0.7 to 0.98, texts of few words, and a crowd of copies of one text."""
    texts = list(EDGE) + ["a b c", "A  b c", "a b c d e f", "a b c d e f g"]
    for k in range(60):
        base = words_of(rng, 200 if k else 60, "abcdefgh", 6)
        for _ in range(2 if k else 40):
            copy = list(base)
            n = rng.randrange(1, 30 if k else 4)
            at = rng.randrange(len(copy) - n)
            copy[at : at + n] = [f"new{rng.random()}" for _ in range(n)]
            texts.append(" ".join(copy))
        if k:
            texts.append(" ".join(base))
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("block", [256, 5])
def test_like_brute_force(spark, block):
    texts = planted(random.Random(21))
    out = by_id(shingledup.representatives(frame(spark, texts), shingledup.Settings(block=block, shape=TINY)), "text")
    assert set(out) == brute_kept(texts)
    assert all(out[i] == (texts[i],) for i in out)


def test_stage_drops_copies_of_similarity_08_to_095(spark):
    rng = random.Random(22)
    texts, share = [], []
    for k in range(40):
        base = words_of(rng, 200, "abcdefgh", 6)
        copy = list(base)
        n = 2 + k % 15
        copy[50 : 50 + n] = [f"new{i}" for i in range(n)]
        texts += [" ".join(base), " ".join(copy)]
        a, b = brute_set(texts[-2]), brute_set(texts[-1])
        share.append(len(a & b) / len(a | b))
    assert min(share) >= 0.8 and max(share) <= 0.95
    kept = by_id(corpus_pipeline.near_dedup_stage(spark, frame(spark, texts), ""), "text")
    assert set(kept) == set(range(0, 80, 2))


def test_null_ids_repeated_rows_and_empty_tables(spark):
    text = " ".join(words_of(random.Random(6), 100, "abcdef", 5))
    docs = frame(spark, [text, text, text + " x", None, ""], ids=[None, 3, 3, 9, 2])
    kept = sorted((r.doc_id, r.text) for r in shingledup.representatives(docs.union(docs), shingledup.Settings(shape=TINY)).collect())
    assert [k for k, _ in kept] == [2, 3] and kept[0][1] == ""
    assert shingledup.representatives(docs.limit(0)).count() == 0
