import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from fixtures import BLANKS, EDGE, SCHEMA, by_id, frame, words_of

from weirflow.llm import simhash, suffixdedup, windowdedup
from weirflow.llm.components import components
from weirflow.llm.countmin import Shape

TINY = Shape(cells=1 << 12, rows=2, slices=8)


def brute_bytes(texts, span):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + span] for b in raw for i in range(len(b) - span + 1))
    out = []
    for b in raw:
        gone = np.zeros(len(b), dtype=bool)
        for i in range(len(b) - span + 1):
            if seen[b[i : i + span]] > 1:
                gone[i : i + span] = True
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((len(b), int(gone.sum()), runs, bytes(np.frombuffer(b, np.uint8)[~gone])))
    return out


@pytest.mark.parametrize("shard_bytes", [1 << 20, 600])
def test_suffix_arrays_remove_what_brute_force_removes(spark, shard_bytes):
    rng = random.Random(3)
    shared = " ".join(words_of(rng, 60))
    texts = list(EDGE)
    for k in range(40):
        a, b = sorted((rng.randrange(len(shared)), rng.randrange(len(shared))))
        texts.append(" ".join(words_of(rng, rng.randrange(30))) + shared[a:b] + " ".join(words_of(rng, rng.randrange(30), "abcdefgh")))
    texts += [texts[10], texts[10], "x" * 150, "x" * 60 + "\x00" * 90, "\x00" * 50]
    s = suffixdedup.Settings(span=48, shard_bytes=shard_bytes, shape=TINY)
    out = by_id(suffixdedup.deduplicate(frame(spark, texts), s), "n_bytes", "n_removed", "n_spans", "kept")
    for i, want in enumerate(brute_bytes(texts, 48)):
        got = out[i]
        assert (*got[:3], bytes(got[3])) == want, i


def test_anchor_dealt_over_shards_is_merged(spark):
    """One passage in many different surroundings: its anchors exceed a shard and meet only in the merge."""
    rng = random.Random(5)
    passage = " ".join(words_of(rng, 14, "klmno", 5))
    texts = ["".join(rng.choice("abcdefghij") for _ in range(60)) + passage + "".join(rng.choice("abcdefghij") for _ in range(60)) for _ in range(60)]
    s = suffixdedup.Settings(span=40, shard_bytes=400, shape=TINY)
    out = by_id(suffixdedup.deduplicate(frame(spark, texts), s), "n_bytes", "n_removed", "n_spans", "kept")
    for i, want in enumerate(brute_bytes(texts, 40)):
        assert (*out[i][:3], bytes(out[i][3])) == want


def test_suffix_array_order_and_prefixes():
    rng = np.random.default_rng(1)
    for _ in range(20):
        text = rng.integers(97, 99, rng.integers(1, 300)).astype(np.uint8)
        order, group, eight = suffixdedup.suffix_array(text, 64)
        raw = text.tobytes()
        assert [raw[i : i + 64] for i in order] == sorted(raw[i : i + 64] for i in range(len(raw)))
        shared = suffixdedup.common_prefixes(text, order, group, eight, np.array([0]), np.array([len(text)]), 40)
        for a, b in zip(order[:-1], order[1:], strict=True):
            n = 0
            while n < 40 and max(a, b) + n < len(raw) and raw[a + n] == raw[b + n]:
                n += 1
            assert shared[b] == n or (n < 32 and shared[b] <= n)


def test_prefixes_of_runs_longer_than_the_sorted_depth():
    """Runs of 64 bytes and more that then differ: ties of the order stay in text order, and no prefix may be taken as equal unseen."""
    rng = np.random.default_rng(11)
    for _ in range(60):
        base = rng.integers(97, 123, 200)
        parts = []
        for _ in range(3):
            copy = base[rng.integers(0, 60) :].copy()
            copy[rng.integers(0, len(copy), 2)] = rng.integers(65, 91, 2)
            parts.append(copy)
        text = np.concatenate(parts).astype(np.uint8)
        sizes = np.array(list(map(len, parts)))
        order, group, eight = suffixdedup.suffix_array(text, 40)
        shared = suffixdedup.common_prefixes(text, order, group, eight, np.cumsum(sizes) - sizes, sizes, 40)
        raw = text.tobytes()
        for a, b in zip(order[:-1], order[1:], strict=True):
            if max(a, b) + 40 <= len(raw):
                assert (shared[b] >= 40) == (raw[a : a + 40] == raw[b : b + 40])


def test_variants_under_one_anchor_with_long_common_runs(spark):
    """Three variants whose common runs exceed the sorted depth of 256 bytes, some windows of which are unique."""
    rng = random.Random(23)
    texts = []
    for _ in range(40):
        base = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(700))
        for _ in range(3):
            copy = list(base[rng.randrange(150) :])
            for _ in range(2):
                copy[rng.randrange(len(copy))] = rng.choice("ABC")
            texts.append("".join(copy))
    out = by_id(suffixdedup.deduplicate(frame(spark, texts), suffixdedup.Settings(shape=TINY)), "n_bytes", "n_removed", "n_spans", "kept")
    for i, want in enumerate(brute_bytes(texts, 200)):
        assert (*out[i][:3], bytes(out[i][3])) == want, i


def test_long_text_is_cut_into_overlapping_pieces(spark):
    rng = random.Random(9)
    block = "".join(rng.choice("abcdefghijklmnop") for _ in range(1000))
    long = "".join(rng.choice("abcdefghijklmnop") for _ in range((1 << 19) - 400)) + block + "".join(rng.choice("abcdefghijklmnop") for _ in range(2000))
    out = by_id(suffixdedup.deduplicate(frame(spark, [long, "#" + block + "#"])), "n_bytes", "n_removed", "n_spans")
    assert out == {0: (len(long), 1000, 1), 1: (1002, 1000, 1)}


def test_suffix_repeated_rows_and_clashing_columns(spark):
    text = "".join(random.Random(1).choice("abcdef") for _ in range(300))
    docs = frame(spark, [text, text, "short"], ids=[7, 7, None]).selectExpr("*", "1 AS kept", "2 AS id", "3 AS h", "'x' AS spans")
    rows = suffixdedup.deduplicate(docs).collect()
    assert sorted((r.n_bytes, r.n_removed) for r in rows) == [(5, 0), (300, 300), (300, 300)]
    assert suffixdedup.deduplicate(docs.limit(0)).count() == 0


def brute_windows(ids, texts, width):
    words = [BLANKS.findall(t or "") for t in texts]
    first = {}
    for i, w in sorted(zip(ids, words, strict=True)):
        for s in range(len(w) - width + 1):
            first.setdefault(tuple(w[s : s + width]), (i, s))
    out = {}
    for i, w in zip(ids, words, strict=True):
        gone = set()
        for s in range(len(w) - width + 1):
            if first[tuple(w[s : s + width])] != (i, s):
                gone.update(range(s, s + width))
        out[i] = (len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone))
    return out


@pytest.mark.parametrize("cells", [64, 1 << 16])
def test_word_windows_like_brute_force(spark, cells):
    """With 64 cells nearly every window passes the sketch, and results stay the same."""
    rng = random.Random(11)
    texts = list(EDGE) + ["\n ".join(words_of(rng, rng.randrange(60))) for _ in range(60)]
    texts += [texts[20], texts[20] + " tail", "a " * 50, "é " * 40]
    ids = list(range(100, 100 + len(texts)))
    rng.shuffle(ids)
    s = windowdedup.Settings(width=5, shape=Shape(cells=cells, rows=2, slices=8))
    out = by_id(windowdedup.deduplicate(frame(spark, texts, ids), s), "n_words", "n_removed", "kept")
    assert out == brute_windows(ids, texts, 5)


def test_windows_null_ids_repeated_rows_and_clashing_columns(spark):
    text = "one two three four five six"
    docs = frame(spark, [text, text, text, None], ids=[4, 4, None, 5]).selectExpr("*", "1 AS kept", "2 AS id", "3 AS h", "4 AS ats")
    s = windowdedup.Settings(width=3, shape=TINY)
    rows = sorted((str(r.doc_id), r.n_removed) for r in windowdedup.deduplicate(docs, s).collect())
    assert rows == [("4", 6), ("4", 6), ("5", 0), ("None", 0)]
    only = windowdedup.deduplicate(docs.where("doc_id = 4"), s).collect()
    assert [r.n_removed for r in only] == [0, 0]
    assert windowdedup.deduplicate(docs.limit(0), s).count() == 0


def brute_fingerprint(text):
    words = [w for w in BLANKS.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))]
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 4]).encode(), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_roots(values, radius):
    parent = {v: v for v in values}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    ordered = sorted(parent)
    for i, a in enumerate(ordered):
        for b in ordered[i + 1 :]:
            if (a ^ b).bit_count() <= radius:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {v: find(v) for v in parent}


def test_fingerprints():
    for t in [*EDGE, "a b c", "a b c d", "A b C d e", " ".join(words_of(random.Random(2), 500))]:
        assert simhash.fingerprint(t or "") == brute_fingerprint(t)


@pytest.mark.parametrize("crowd", [100, 2])
def test_near_duplicates_like_brute_force(spark, monkeypatch, crowd):
    monkeypatch.setattr(simhash, "CROWD", crowd)
    rng = random.Random(4)
    texts = list(EDGE)
    for _ in range(12):
        base = words_of(rng, 150, "abcdefgh", 6)
        for _ in range(rng.randint(1, 6)):
            copy = list(base)
            for _ in range(rng.randrange(3)):
                copy[rng.randrange(len(copy))] = "edit"
            texts.append(" ".join(copy))
    out = by_id(simhash.near_duplicates(frame(spark, texts)), "fingerprint", "component_id")
    fps = {i: brute_fingerprint(t) for i, t in enumerate(texts)}
    roots = brute_roots(set(fps.values()), simhash.RADIUS)
    first = {}
    for i in sorted(fps):
        first.setdefault(roots[fps[i]], i)
    assert out == {i: (f"{f:016x}", first[roots[f]]) for i, f in fps.items()}


def test_links_between_bit_patterns(spark):
    """Random fingerprints with neighbours up to six bits away, on either side of the halves, with the sign bit too."""
    rng = random.Random(8)
    values = set()
    for _ in range(60):
        base = rng.getrandbits(64)
        values.add(base)
        for _ in range(4):
            v = base
            for b in rng.sample(range(64), rng.randint(1, 6)):
                v ^= 1 << b
            values.add(v)
    signed = {v: v - (1 << 64) if v >> 63 else v for v in values}
    edges = simhash.links(spark.createDataFrame([(x,) for x in signed.values()], "fp bigint"))
    found = {r.node: r.root for r in components(edges).collect()}
    want = defaultdict(set)
    for v, r in brute_roots(values, 4).items():
        want[r].add(signed[v])
    got = defaultdict(set)
    for x in signed.values():
        got[found.get(x, x)].add(x)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_representatives(spark):
    text = " ".join(words_of(random.Random(6), 100, "abcdef", 5))
    docs = frame(spark, [text, text, text + " x", None, ""], ids=[None, 3, 3, 9, 2])
    docs = docs.union(docs)
    kept = sorted((r.doc_id, r.text) for r in simhash.representatives(docs).collect())
    assert [k for k, _ in kept] == [2, 3] and kept[0][1] == ""
    assert simhash.representatives(docs.limit(0)).count() == 0


def test_near_duplicates_edges(spark):
    out = simhash.near_duplicates(frame(spark, [None, "x y z q"], ids=[None, 1]).selectExpr("*", "1 AS fp", "2 AS component_id"))
    rows = {(r.doc_id, r.fingerprint == "0" * 16, r.component_id) for r in out.collect()}
    assert rows == {(None, True, None), (1, False, 1)}
    assert simhash.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_components_of_paths_stars_and_random_graphs(spark):
    rng = random.Random(1)
    graphs = [
        [(i, i + 1) for i in range(40)], [(99, i) for i in range(30)], [(rng.randrange(200), rng.randrange(200)) for _ in range(150)], [(1, 1)], [],
    ]
    for edges in graphs:
        parent = {}

        def find(a, parent=parent):
            while parent[a] != a:
                a = parent[a]
            return a

        for a, b in edges:
            if a != b:
                parent.setdefault(a, a), parent.setdefault(b, b)
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
        got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
        assert got == {a: find(a) for a in parent}


