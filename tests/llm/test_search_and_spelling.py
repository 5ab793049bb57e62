"""Chosen paths, ranked search and spelling variants, against brute force."""

import math
import random
import re
import zlib
from collections import Counter

import pytest
from fixtures import EDGE, by_id, frame, words_of
from pyspark.sql import functions as F
from test_shingledup import brute_set, planted

from weirflow.llm import chosenpath, lexical, spelling


def brute_components(texts, percent):
    sets = [brute_set(t) for t in texts]
    root = list(range(len(texts)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {i: (len(s), find(i), find(i) == i) for i, s in enumerate(sets)}


@pytest.mark.parametrize("settings", [chosenpath.Settings(), chosenpath.Settings(node=4, group_shingles=300), chosenpath.Settings(percent=70)])
def test_chosen_paths_like_brute_force(spark, settings):
    """Also with great nodes at every level and blocks within the last."""
    texts = planted(random.Random(31))
    docs = frame(spark, texts).selectExpr("*", "1 AS n", "2 AS rec", "3 AS root")
    out = by_id(chosenpath.near_duplicates(docs, settings), "n_shingles", "component_id", "kept")
    assert out == brute_components(texts, settings.percent)


def test_chosen_paths_edges(spark):
    text = " ".join(words_of(random.Random(6), 100, "abcdef", 5))
    docs = frame(spark, [text, text, text + " x", None, "", "lone text here"], ids=[None, 3, 3, 9, 2, None])
    rows = sorted(((r.doc_id, r.n_shingles > 0, r.component_id, r.kept) for r in chosenpath.near_duplicates(docs.union(docs)).collect()), key=str)
    want = [(None, True, 3, False), (3, True, 3, True), (3, True, 3, True), (9, False, 9, True), (2, False, 2, True), (None, True, None, True)]
    assert rows == sorted(want * 2, key=str)
    assert chosenpath.near_duplicates(docs.limit(0)).count() == 0
    long = " ".join(words_of(random.Random(8), 400_000, "abcdefgh", 6))
    near = by_id(chosenpath.near_duplicates(frame(spark, [long, long + " a b c", "a b"])), "component_id")
    assert near == {0: (0,), 1: (0,), 2: (2,)}


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute_search(docs, items, k=10):
    found = [(i, Counter(terms(t))) for i, t in docs]
    full = [c for _, c in found if c]
    n, total = len(full), sum(sum(c.values()) for c in full)
    df = Counter(t for c in full for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c in found:
            m = 10 + (90 * sum(c.values()) * n) // max(1, total)
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m)) for t in set(terms(text)) if t in c
            )
            if score > 0:
                scored.append((-score, i is None, i or 0))
        out += [(item, r + 1, None if z else i, -s) for r, (s, z, i) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


@pytest.mark.parametrize("settings", [lexical.Settings(), lexical.Settings(k=3, shard_bytes=900, pair_terms=6, block_terms=40), lexical.Settings(shard_bytes=500, pair_terms=0)])
def test_search_like_brute_force(spark, settings):
    """Also with many small shards, several blocks of queries, and no pairs."""
    rng = random.Random(41)
    frequent = ["the", "of", "and", "The", "été", "in"]
    mixed = lambda n: " ".join(rng.choice(frequent) if rng.random() < 0.5 else "".join(rng.choice("abcd") for _ in range(rng.randint(1, 3))) for _ in range(n))
    texts = [*EDGE, "", "the of"] + [mixed(rng.randint(1, 80)) for _ in range(150)]
    texts += texts[20:40]
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    ids[10] = ids[11] = None
    items = [(k, mixed(rng.randint(1, 20))) for k in range(30)] + [(90, None), (91, "--"), (92, "zzzz"), (3, "the OF, the"), (None, "été a")]
    index = lexical.build(frame(spark, texts, ids).selectExpr("*", "1 AS body", "2 AS score"), settings)
    bench = spark.createDataFrame(items, "item_id bigint, text string").selectExpr("*", "1 AS rank", "2 AS doc_id")
    got = sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in lexical.search(index, bench, settings=settings).collect()), key=str)
    assert got == brute_search(list(zip(ids, texts, strict=True)), items, settings.k)


def test_pair_bounds(spark):
    """Frequent terms that are seldom in one document: a unit of both is bounded by less than the sum, and never below a document's sum."""
    rng = random.Random(42)
    texts = [("aa " if k % 2 else "bb ") * rng.randint(1, 4) + "cc " * (k % 3) + ("aa bb" if k == 7 else "") for k in range(60)]
    s = lexical.Settings(pair_terms=3)
    index = lexical.build(frame(spark, texts).coalesce(1), s)
    (row,) = index.shards.collect()
    own = [int(lexical.terms_of([w])[1][0]) for w in (b"aa", b"bb", b"cc")]
    df = {t: sum(w in x.split() for x in texts) for t, w in zip(own, ("aa", "bb", "cc"), strict=True)}
    shard = lexical.Shard(row.ids, row.rows, row.body, row.pairs, index.frequent, index.stats, df)
    shard.lookup(index.frequent)
    units = shard.units(own)
    assert sorted(t for _, unit in units for t in unit) == sorted(own) and any(len(unit) == 2 for _, unit in units)
    for bound, unit in units:
        sums = Counter()
        for t in unit:
            docs, impact, _ = shard.lists[t]
            sums.update(dict(zip(docs.tolist(), impact.tolist(), strict=True)))
        assert max(sums.values()) <= bound <= sum(shard.lists[t][2] for t in unit)
        if len(unit) == 2:
            assert bound < sum(shard.lists[t][2] for t in unit)
            both = set(shard.lists[unit[0]][0].tolist()) & set(shard.lists[unit[1]][0].tolist())
            assert set(shard.has_both(*unit).nonzero()[0].tolist()) == both


def test_search_edges(spark):
    docs = frame(spark, ["alpha beta", "alpha beta", None], ids=[5, 5, 6])
    items = spark.createDataFrame([(1, "Alpha"), (1, "Alpha")], "item_id bigint, text string")
    rows = lexical.search(lexical.build(docs.union(frame(spark, ["gamma"] * 9))), items).collect()
    assert sorted((r.item_id, r["rank"], r.doc_id) for r in rows) == [(1, 1, 5), (1, 1, 5), (1, 2, 5), (1, 2, 5)]
    assert lexical.search(lexical.build(docs.limit(0)), items).count() == 0
    assert lexical.search(lexical.build(frame(spark, [None, "", " -- "])), items).count() == 0
    assert lexical.search(lexical.build(docs), items.limit(0)).count() == 0
    long = " ".join(words_of(random.Random(8), 400_000, "abcdefgh", 6))
    (top,) = [r for r in lexical.search(lexical.build(frame(spark, [long, "zzzz zzzz", *["filler"] * 9])), spark.createDataFrame([(1, "zzzz")], "item_id int, text string")).collect()]
    assert top.doc_id == 1


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a[i + (len(a) >= len(b)) :] == b[i + (len(b) >= len(a)) :]


def brute_variants(vocab, factor):
    out = {}
    for w, n in vocab.items():
        near = [(-m, v) for v, m in vocab.items() if one_edit(w, v)]
        best = min(near, default=(0, None))
        out[w] = (best[1] if near and -best[0] >= factor * n else None, n, len(near), -best[0] if near and -best[0] >= factor * n else None)
    root = {}
    for w in vocab:
        at = w
        while out[at][0]:
            at = out[at][0]
        root[w] = at
    return {w: (f, root[w], n, k, m) for w, (f, n, k, m) in out.items()}


@pytest.mark.parametrize("crowded", [24, 1, 10_000])
def test_variants_like_brute_force(spark, crowded):
    rng = random.Random(51)
    vocab = {}
    for _ in range(120):
        word = "".join(rng.choice("abé") for _ in range(rng.randint(6, 11)))
        count = rng.randint(5, 40)
        vocab[word] = count
        for _ in range(4):
            at = rng.randrange(len(word) + 1)
            other = [word[:at] + rng.choice("abé") + word[at:], word[:at] + word[at + 1 :], word[:at] + rng.choice("abé") + word[at + 1 :]][rng.randrange(3)]
            if len(other) >= 6 and other not in vocab:
                count *= rng.choice([1, 2, 6])
                vocab[other] = count
                word = rng.choice([word, other])
    table = spark.createDataFrame(list(vocab.items()), "word string, n bigint")
    rows = spelling.variants(table, spelling.Settings(crowded=crowded)).collect()
    assert len(rows) == len(vocab)
    assert {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows} == brute_variants(vocab, 5)


def test_runs_and_vocabulary(spark):
    docs = frame(spark, [*EDGE, "Abcdef abcdef, ABCDEF-abcdef1abcdef ÀBCDEFGß ŁÓDŹxx", "àbcdefgß " * 5, "x" * 300_000]).selectExpr("*", "1 AS run", "2 AS n")
    found = spelling.vocabulary(spelling.runs(docs), "run", spelling.Settings(min_count=5))
    assert by_id(found.withColumnRenamed("word", "doc_id"), "n") == {"abcdef": (5,), "àbcdefgß": (5,)}
    assert spelling.variants(spelling.vocabulary(spelling.runs(docs.limit(0)), "run")).count() == 0
    nulls = spark.createDataFrame([(None,), (None,)], "run string")
    assert spelling.vocabulary(nulls, F.col("run"), spelling.Settings(min_count=1)).count() == 0


def test_deleted_characters(spark, tmp_path):
    """The registered query's damage rule, with null ids, against the rule in Python."""
    from weirflow.llm.queries import QUERIES

    rng = random.Random(61)
    words = ["".join(rng.choice("abcdefgé") for _ in range(rng.randint(6, 9))) for _ in range(30)]
    texts = [" ".join(rng.choice(words) for _ in range(60)) for _ in range(120)]
    ids = [None, *range(1, 120)]
    frame(spark, texts, ids).write.parquet(f"{tmp_path}/documents.parquet")
    counts = Counter()
    for i, t in zip(ids, texts, strict=True):
        for w in t.split():
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            counts[w[: h % len(w)] + w[h % len(w) + 1 :] if h % 199 == 0 else w] += 1
    vocab = {w: n for w, n in counts.items() if n >= 5 and len(w) >= 6}
    rows = QUERIES["op13_spelling_variants"](spark, str(tmp_path)).collect()
    assert {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows} == brute_variants(vocab, 5)
