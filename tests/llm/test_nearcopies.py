"""Near copies of the pipeline: SimHash ball hashing first, chosen paths beyond the ball, against brute force."""

import random

import numpy as np
import pytest
from fixtures import EDGE, by_id, frame, words_of
from test_shingledup import brute_kept, planted

import corpus_pipeline
from weirflow.llm import chosenpath, nearcopies, simhash, windowdedup
from weirflow.session import load


def test_fingerprints_by_majority():
    sets = chosenpath.shingle_sets(["a b c d e f g h", "x", " ".join(map(str, range(500)))])
    starts = np.cumsum([0, *map(len, sets)])[:-1]
    got = chosenpath.majority(np.concatenate(sets), starts).view(np.uint64).tolist()
    for fp, values in zip(got, sets, strict=True):
        assert fp == sum(1 << k for k in range(64) if 2 * sum(int(v) >> k & 1 for v in values) > len(values))


@pytest.mark.parametrize("settings", [nearcopies.SIMILAR, chosenpath.Settings(percent=80, trees=5, node=4, group_shingles=300)])
def test_like_brute_force(spark, settings):
    texts = planted(random.Random(21))
    out = by_id(nearcopies.representatives(frame(spark, texts), settings), "text")
    assert set(out) == brute_kept(texts)
    assert all(out[i] == (texts[i],) for i in out)


def test_stage_takes_its_pairs_from_ball_hashing(spark, monkeypatch):
    """Without the paths the stage still joins what lies within the ball, and nothing that the whole sets don't confirm."""
    rng = random.Random(5)
    base = words_of(rng, 2000, "abcdefgh", 6)
    texts = [" ".join(base), " ".join([*base, "one"]), " ".join(words_of(rng, 300, "abcdefgh", 6))]
    seen = []
    whole = simhash.links
    monkeypatch.setattr(simhash, "links", lambda fps: seen.append(fps.count()) or whole(fps))
    monkeypatch.setattr(chosenpath, "_children", lambda level, trees: "array(rec)")  # no two records meet
    assert set(by_id(corpus_pipeline.near_dedup_stage(spark, frame(spark, texts), ""), "text")) == {0, 2}
    assert seen and seen[0] >= 2


def test_near_copies_edges(spark):
    text = " ".join(words_of(random.Random(6), 100, "abcdef", 5))
    docs = frame(spark, [text, text, text + " x", None, "", " "], ids=[None, 3, 3, 9, 2, 2])
    kept = sorted((r.doc_id, r.text) for r in nearcopies.representatives(docs.union(docs)).collect())
    assert [k for k, _ in kept] == [2, 3] and kept[0][1] in ("", " ")
    assert nearcopies.representatives(docs.limit(0)).count() == 0
    alone = frame(spark, ["only one", "another text"], ids=[None, None])
    assert sorted(r.text for r in nearcopies.representatives(alone.union(alone)).collect()) == ["another text", "only one"]
    assert len(by_id(nearcopies.representatives(frame(spark, EDGE)), "text")) == 4


def test_only_rows_that_change_are_shuffled_with_their_texts(spark):
    rng = random.Random(8)
    texts = [" ".join(words_of(rng, 300, "abcdefgh", 6)) for _ in range(30)]
    docs = frame(spark, [*texts, texts[0], texts[1] + " x"])
    for out in (windowdedup.deduplicate(docs), nearcopies.representatives(docs)):
        assert "Union" in out._jdf.queryExecution().optimizedPlan().toString()  # of rows as they are and of those joined
    cut = by_id(windowdedup.deduplicate(docs.union(docs)), "n_removed", "kept")
    assert [i for i, (n, _) in sorted(cut.items()) if n] == [30, 31] and cut[30] == (300, "") and cut[31][1] == "x"
    assert windowdedup.deduplicate(docs.union(docs)).count() == 64


def test_workers_get_small_batches_unless_the_user_says_otherwise(spark):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.unset(name)
    load(spark, "/root/testdata/sf0.001", "documents")
    assert spark.conf.get(name) == "8000000"
    spark.conf.set(name, "1000000")
    load(spark, "/root/testdata/sf0.001", "documents")
    assert spark.conf.get(name) == "1000000"
    spark.conf.unset(name)
