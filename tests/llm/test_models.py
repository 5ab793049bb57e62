"""Classifiers, outliers, decontamination and sharding."""

import random
import re
import zlib

import numpy as np
import pytest
from conftest import SF_DIR
from fixtures import BLANKS, EDGE, SCHEMA, by_id, frame, words_of
from pyspark.sql import functions as F

from weirflow.llm import decontam, langid, outliers, quality, sharding
from weirflow.llm.common import held_out
from weirflow.session import load

DATA = SF_DIR.replace("0.001", "0.01")


def held(i):
    return zlib.crc32(str(i).encode()) % 3 == 1


def test_held_out_rows(spark):
    got = {r.doc_id: r.h for r in spark.range(50).select(F.col("id").alias("doc_id"), held_out("id").alias("h")).collect()}
    assert got == {i: held(i) for i in range(50)}


def test_quality_on_held_out_labels(spark):
    labels = load(spark, DATA, "labels")
    scored = quality.classify(load(spark, DATA, "documents").select("doc_id", "text"), labels)
    rows = scored.join(labels, "doc_id").where(held_out("doc_id")).collect()
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)


def test_quality_ignores_held_out_labels(spark):
    docs, labels = load(spark, DATA, "documents").select("doc_id", "text"), load(spark, DATA, "labels")
    turned = labels.withColumn("quality", F.when(held_out("doc_id"), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert quality.fit(docs, labels) == quality.fit(docs, turned)


def test_quality_edges(spark):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(0, 60)] + [(None, 1, 0), (3, None, 0)], "doc_id bigint, quality int, toxic int")
    texts = [("good words here " if i % 2 else "!!! ### $$$ ") * (1 + i % 5) for i in range(60)]
    docs = frame(spark, texts + EDGE).selectExpr("*", "'x' AS score", "2 AS predicted", "3 AS label")
    rows = {r.doc_id: r for r in quality.classify(docs, labels).collect()}
    assert len(rows) == 66 and rows[60].score == rows[61].score and rows[0].label == 3
    assert quality.classify(docs.limit(0), labels).count() == 0
    assert {r.score for r in quality.classify(docs, labels.limit(0)).collect()} == {0.5}
    assert {r.score for r in quality.classify(docs, labels.where("quality = 1")).collect()} == {1.0}


def test_languages_on_held_out_rows(spark):
    docs = load(spark, DATA, "documents").select("doc_id", "text", "lang")
    rows = langid.predict(docs, langid.fit(docs)).where(held_out("doc_id")).collect()
    assert np.mean([r.lang_pred == r.lang for r in rows]) > 0.97


def test_every_language_is_learned(spark):
    """More languages than the sample has room for at full size, one of them with many rows that teach nothing."""
    rng = random.Random(4)
    texts, langs = [], []
    for k in range(300):
        own = [chr(0x4E00 + 3 * k + j) for j in range(3)]
        for _ in range(6):
            texts.append(" ".join("".join(rng.choice(own) for _ in range(4)) for _ in range(12)))
            langs.append(f"l{k:03}")
    for k in range(900):
        texts.append("123 --" if k % 2 else None)
        langs.append("l007")
    rows = [(i, t, x, "s", 0) for i, (t, x) in enumerate(zip(texts, langs, strict=True))]
    docs = spark.createDataFrame(rows, SCHEMA)
    s = langid.Settings(all_docs=900, all_landmarks=600, least_docs=2)
    model = langid.fit(docs, s)
    taught = {x for i, (t, x) in enumerate(zip(texts, langs, strict=True)) if not held(i) and t and t[0] != "1"}
    assert len(taught) > 295 and set(model.names) == taught
    got = by_id(langid.predict(docs.where("text LIKE '% %' AND text NOT LIKE '1%'"), model), "lang_pred")
    assert np.mean([got[i] == (langs[i],) for i in got if langs[i] in taught]) > 0.95


def brute_fit(texts, labels, names):
    """One-versus-rest ridge on the sets' kernel with all training texts as landmarks, through the kernel matrix itself."""
    grams = [{t.lower()[i : i + n] for n in (1, 2, 3) for i in range(len(t) - n + 1)} for t in texts]
    k = np.array([[len(a & b) / np.sqrt(len(a) * len(b)) for b in grams] for a in grams])
    y = np.array([[float(x == n) for n in names] for x in labels])
    share = 1 / y.sum(axis=0)[np.argmax(y, axis=1)]
    values, vectors = np.linalg.eigh(k)
    keep = values > 1e-6 * values.max()
    features = np.column_stack([vectors[:, keep] * np.sqrt(values[keep]), np.ones(len(k))])
    beta = np.linalg.solve(features.T @ (features * share[:, None]) + 1e-3 * np.eye(features.shape[1]), features.T @ (y * share[:, None]))
    return features @ beta


def test_predictions_like_brute_force(spark):
    """With every training text a landmark, scores of the training texts are those of the full kernel matrix."""
    rng = random.Random(12)
    texts = [" ".join(words_of(rng, 12, ("abcd", "cdef", "efgh")[i % 3], 4)) for i in range(90)]
    docs = frame(spark, texts).withColumn("lang", F.concat(F.lit("l"), (F.col("doc_id") % 3).cast("string")))
    own = [i for i in range(90) if not held(i)]
    want = brute_fit([texts[i] for i in own], [f"l{i % 3}" for i in own], ["l0", "l1", "l2"])
    got = by_id(langid.predict(docs, langid.fit(docs, langid.Settings(buckets=1 << 18))), "lang_pred", "score")
    for i, w in zip(own, want, strict=True):
        assert got[i][0] == f"l{w.argmax()}" and got[i][1] == pytest.approx(np.clip(w.max(), 0, 1), abs=2e-3)


def test_presence_kernel_like_sets():
    s = langid.Settings(buckets=1 << 16)
    texts = ["abcabc", "abd", "", "ÄÖ ü", "zzz"]
    grams = [{t.lower()[i : i + n] for n in (1, 2, 3) for i in range(len(t) - n + 1)} for t in texts]
    bits = langid.presence(texts, s)
    got = langid.kernel(bits, bits.astype(np.float32))
    for i, a in enumerate(grams):
        assert bits[i].sum() == len(a)
        for j, b in enumerate(grams):
            assert got[i, j] == pytest.approx(len(a & b) / np.sqrt(max(1, len(a)) * max(1, len(b))))


def test_language_edges(spark):
    texts = ["der und die das " * 3, "the of and with " * 3] * 20 + [None, "", "123 !!"]
    docs = frame(spark, texts).withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "de").when(F.col("doc_id") != 5, "en")).selectExpr("*", "1 AS lang_pred", "2 AS bits")
    out = by_id(langid.predict(docs, langid.fit(docs)), "lang_pred", "score")
    assert [out[i] for i in (40, 41, 42)] == [("und", 0.0)] * 3
    assert out[5][0] == "en" and out[4][0] == "de"
    assert langid.fit(docs.limit(0)) is None
    assert {r.lang_pred for r in langid.predict(docs, None).collect()} == {"und"}


def brute_statistics(text):
    text = text or ""
    words = BLANKS.findall(text)
    seen = {}
    for i in range(len(words) - 2):
        seen.setdefault(tuple(words[i : i + 3]), []).append(i)
    covered = {i + k for at in seen.values() if len(at) > 1 for i in at for k in range(3)}
    lines = [x for x in text.split("\n") if BLANKS.search(x)]
    n = len(words)
    failed = n < 50 or 100 * len(covered) > 50 * n
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), failed


def test_statistics_like_brute_force(spark):
    rng = random.Random(2)
    texts = list(EDGE) + ["a b c", "a b c a b c", "x x x x", "# * $%&|<>  é"]
    texts += ["\n".join(" ".join(words_of(rng, rng.randrange(9), "ab#", 2)) for _ in range(rng.randrange(40))) for _ in range(40)]
    out = by_id(outliers.statistics(frame(spark, texts)), *outliers.STATISTICS)
    assert out == {i: brute_statistics(t) for i, t in enumerate(texts)}


def normal_share(x, degrees):
    """Chi-square distribution by adding up its density."""
    t = np.linspace(0, x, 200_001)[1:]
    y = t ** (degrees / 2 - 1) * np.exp(-t / 2)
    return y.sum() * (t[1] - t[0]) / (2 ** (degrees / 2) * {4: 1, 6: 2}[degrees])


def brute_mcd(x, floors, share):
    """Centre and covariance by full sorts: an estimate of its own, not the operator's binned steps."""
    quantile = next(q for q in np.arange(5, 6, 0.001) if normal_share(q, 4) >= share)
    scale = share / normal_share(quantile, 6)
    centre, factor = np.median(x, axis=0), np.diag(floors)
    last = None
    for _ in range(100):
        d2 = (np.linalg.solve(factor, (x - centre).T) ** 2).sum(axis=0)
        near = d2 <= np.sort(d2)[int(np.ceil(share * len(x))) - 1]
        if last is not None and (near == last).all():
            break
        last, centre = near, x[near].mean(axis=0)
        cov = np.cov(x[near].T, bias=True) * scale
        factor = np.zeros((4, 4))
        for i in range(4):
            for j in range(i + 1):
                left = cov[i, j] - factor[i, :j] @ factor[j, :j]
                factor[i, j] = np.sqrt(max(left, floors[i] ** 2)) if i == j else left / factor[j, j]
    return (np.linalg.solve(factor, (x - centre).T) ** 2).sum(axis=0)


def test_chi_square():
    s = outliers.Settings()
    assert normal_share(s.cut, 4) == pytest.approx(0.975, abs=1e-4) and normal_share(5.385, 4) == pytest.approx(0.75, abs=1e-3)
    assert outliers.chi_square_share(7.0, 6) == pytest.approx(normal_share(7.0, 6), abs=1e-4)


@pytest.mark.parametrize("size", [60, 200, 600])
def test_planted_outliers_and_clean_documents(spark, size):
    """Of 300 words: repeat-only documents from 10 % to 48 %, line copies from 3 to 13 of 30, symbols; all rejected, clean ones kept."""
    rng = random.Random(size)
    plain = lambda n: ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(n)]
    texts = [" ".join(plain(rng.randint(150, 500))) for _ in range(size)]
    planted = []
    for share in (10, 14, 20, 25, 30, 36, 42, 48):
        run = plain(3 * share // 2)
        planted.append(" ".join(run + plain(300 - 2 * len(run)) + run))
    for copies in (3, 5, 8, 11, 13):
        lines = [" ".join(plain(10)) for _ in range(30 - copies)]
        planted.append("\n".join(lines + lines[:1] * copies))
    planted.append(" ".join(w if k % 4 else "#" + w for k, w in enumerate(plain(300))))
    stats = [brute_statistics(t) for t in texts + planted]
    docs = frame(spark, texts + planted).selectExpr("*", "1 AS a", "2 AS n", "3 AS v0", "'x' AS kept")
    rows = {r.doc_id: r for r in outliers.judge(docs).collect()}
    assert rows[0].a == 1 and rows[0].v0 == 3
    assert not any(rows[i].kept for i in range(size, len(stats)))
    assert np.mean([rows[i].kept for i in range(size)]) >= 0.97
    ids = [i for i, x in enumerate(stats) if not x[5]]
    x = np.array([[np.log(c / n), np.log1p(1000 * m / c), np.log1p(1000 * d / n), np.log1p(100 * w / n)] for n, c, m, d, w, _ in (stats[i] for i in ids)])
    s = outliers.Settings()
    want = brute_mcd(x, np.array(s.floors), s.share) <= 11.1433
    assert np.mean([rows[i].kept == w for i, w in zip(ids, want, strict=True)]) >= 0.99


def test_outlier_edges(spark):
    docs = frame(spark, EDGE, lang=None, source=None)
    rows = outliers.judge(docs.union(docs)).collect()
    assert len(rows) == 12 and not any(r.kept for r in rows)
    few = frame(spark, [" ".join(words_of(random.Random(k), 80, "abcdefgh", 8)) for k in range(5)])
    assert all(r.kept and r.d2 is None for r in outliers.judge(few).collect())
    assert outliers.judge(docs.limit(0)).count() == 0


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_hits(texts, items, length):
    tokens = lambda t: WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    windows = {}
    for i, t in items:
        w = tokens(t)
        m = min(length, len(w))
        for s in range(len(w) - m + 1 if m else 0):
            windows.setdefault(tuple(w[s : s + m]), set()).add(i)
    out = {}
    for i, t in enumerate(texts):
        w, hit, found = tokens(t), set(), set()
        for m in {len(x) for x in windows}:
            for s in range(len(w) - m + 1):
                if tuple(w[s : s + m]) in windows:
                    hit.update(range(s, s + m))
                    found |= windows[tuple(w[s : s + m])]
        import hashlib

        out[i] = (len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest(), bool(hit))
    return out


@pytest.mark.parametrize("limit", [decontam.BROADCAST_WINDOWS, 0])
def test_winnowing_like_brute_force(spark, monkeypatch, limit):
    """Also without a broadcast."""
    monkeypatch.setattr(decontam, "BROADCAST_WINDOWS", limit)
    rng = random.Random(13)
    items = [(k, " ".join(words_of(rng, rng.randint(1, 16), "abc", 2))) for k in range(30)] + [(90, None), (91, "--"), (92, "ß-Ä"), (2, items_text := "q r s")]
    texts = list(EDGE) + [" ".join(words_of(rng, rng.randrange(40), "abc", 2)) for _ in range(40)]
    texts += [f"x {items[3][1].upper()}; y", f"({items_text})", "ß Ä ß"]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    columns = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    docs = frame(spark, texts).selectExpr("*", "1 AS n_hit", "2 AS k", "3 AS mark", "4 AS window")
    assert by_id(decontam.contamination(docs, bench), *columns) == brute_hits(texts, items, 10)


def test_winnowing_edges(spark):
    bench = spark.createDataFrame([(1, "alpha beta")], "item_id bigint, text string")
    docs = frame(spark, ["Alpha, BETA gamma", "Alpha, BETA gamma", None, "beta alpha"], ids=[5, 5, None, None])
    rows = sorted((str(r.doc_id), r.n_words, r.n_hit) for r in decontam.contamination(docs, bench).collect())
    assert rows == [("5", 3, 2), ("5", 3, 2), ("None", 0, 0), ("None", 2, 0)]
    none = decontam.contamination(docs, bench.limit(0)).collect()
    assert len(none) == 4 and not any(r.contaminated for r in none)
    assert decontam.contamination(docs.limit(0), bench).count() == 0


def test_hilbert_curve_steps_to_a_neighbour():
    for dims, bits in ((2, 4), (3, 3)):
        side = 1 << bits
        cells = np.array(np.meshgrid(*[np.arange(side)] * dims)).reshape(dims, -1).T
        index = sharding.hilbert_index(cells, bits)
        assert sorted(index) == list(range(side**dims))
        assert (np.abs(np.diff(cells[np.argsort(index)], axis=0)).sum(axis=1) == 1).all()


def test_shards(spark, tmp_path):
    rng = random.Random(3)
    docs = frame(spark, [None, "", "é"] + [" ".join(words_of(rng, rng.randrange(200))) for _ in range(98)])
    docs = docs.union(docs.limit(4)).selectExpr("*", "1 AS curve", "2 AS rank", "3 AS shard")
    rows = sharding.shards(docs).collect()
    by_shard = {}
    for r in rows:
        by_shard.setdefault(r.shard, []).append(r)
    assert set(by_shard) == set(range(8)) and max(map(len, by_shard.values())) - min(map(len, by_shard.values())) <= 1
    assert all(sorted(r.slot for r in x) == list(range(len(x))) for x in by_shard.values())
    placed = [r.curve for k in range(8) for r in sorted(by_shard[k], key=lambda r: r.slot)]
    assert placed == sorted(placed)
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    assert all(r.size == len(texts[r.doc_id].encode()) + 1 and r.text_crc32 == zlib.crc32(texts[r.doc_id].encode()) for r in rows)
    assert {r.law for r in rows} == {"rows"} and {r.grown_shard for r in rows} == {None}
    assert sharding.shards(docs.limit(0)).count() == 0
    assert sorted(r.shard for r in sharding.shards(docs.limit(3)).collect()) == [0, 2, 5]
    same = frame(spark, ["one text"] * 80 + [f"text {k}" for k in range(80)], ids=[None] * 40 + [7] * 40 + list(range(80))).selectExpr("*", "1 AS slot", "2 AS _row")
    kept = sharding.write_shards(same, f"{tmp_path}/s").collect()
    assert sorted(r.rows for r in kept) == [20] * 8
    written = spark.read.parquet(f"{tmp_path}/s").collect()
    assert sorted((r.shard, r.slot) for r in written) == [(s, i) for s in range(8) for i in range(20)]
    placed = [r.curve for r in sorted(written, key=lambda r: (r.shard, r.slot))]
    assert placed == sorted(placed) and all(r["_row"] == 2 for r in written)
    assert sharding.write_shards(docs.limit(0), f"{tmp_path}/none").count() == 0


def test_shards_of_an_empty_schema(spark):
    assert sharding.shards(spark.createDataFrame([], SCHEMA)).count() == 0
