"""The registered corpus queries and the pipeline."""


import numpy as np
import pytest
from fixtures import by_id, frame
from oracle import connect
from test_dedup import brute_windows
from test_models import brute_hits
from test_shingledup import brute_kept

import __spark_entry__
import corpus_pipeline
from weirflow.llm import pieces, quality
from weirflow.llm.queries import ORACLES, QUERIES, piece_model
from weirflow.session import load

SF = "/root/testdata/sf0.001"


def test_all_are_registered():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(__spark_entry__.queries())
    assert set(ORACLES) <= set(__spark_entry__.oracle_sql())


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_oracle(spark, key):
    df = QUERIES[key](spark, SF)
    cur = connect(SF).execute(ORACLES[key])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    assert sorted(cur.fetchall()) == sorted(tuple(r) for r in df.select(*names).collect())


@pytest.mark.parametrize("key", sorted(set(QUERIES) - set(ORACLES)))  # these have a row per document
def test_one_row_per_document(spark, key):
    rows = QUERIES[key](spark, SF).select("doc_id").collect()
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in load(spark, SF, "documents").select("doc_id").collect())


def test_stages_like_brute_force(spark, tmp_path):
    docs = load(spark, SF, "documents")
    tables = {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        out = stage(spark, docs, SF)
        if name != "sentencepiece":
            assert out.columns == list(corpus_pipeline.COLUMNS)
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        after = {r.doc_id: r for r in docs.collect()}
        assert len(after) == docs.count() and set(after) <= set(before)
        tables[name] = before, after
    before, after = tables["quality"]
    model = quality.fit(load(spark, SF, "documents"), load(spark, SF, "labels"))
    gain = quality.Gain(model)
    want = {i for i, r in before.items() if gain(r.text) * model.slope + model.offset >= 0}
    assert set(after) == want
    before, after = tables["near_dedup"]
    ids = sorted(before)
    assert set(after) == {ids[k] for k in brute_kept([before[i].text for i in ids])}
    assert all(after[i] == before[i] for i in after)
    before, after = tables["substring_dedup"]
    ids = sorted(before)
    cut = brute_windows(ids, [before[i].text for i in ids], 20)
    for i in ids:
        assert after[i].text == (cut[i][2] if cut[i][1] else before[i].text)
        assert after[i].n_chars == len(after[i].text)
    before, after = tables["decontamination"]
    ids = sorted(before)
    items = [(r.item_id, r.text) for r in load(spark, SF, "benchmark").collect()]
    hits = brute_hits([before[i].text for i in ids], items, 10)
    assert set(after) == {i for k, i in enumerate(ids) if not hits[k][4]}
    before, after = tables["sentencepiece"]
    codec = pieces.Codec(piece_model())
    assert set(after) == set(before)
    for i, r in after.items():
        assert r.exact and r.n_pieces == len(r.ids) and codec.decode(r.ids) == before[i].text
        assert np.frombuffer(codec.encode([before[i].text])[0], "<i4").tolist() == list(r.ids)


def test_pipeline_runs_the_stages(spark):
    rows = corpus_pipeline.run(spark, SF)
    assert rows.columns == ["doc_id", "n_pieces", "ids", "exact"] and rows.count() > 0


def test_stages_take_nulls_and_empty_tables(spark, tmp_path):
    text = "some good words that go on " * 30
    docs = frame(spark, [None, "", text, text, "short"], ids=[1, None, 3, 4, 5], lang=None, source=None).selectExpr("*", "1 AS h", "2 AS fp")
    for _, stage in corpus_pipeline.STAGES:
        assert len(by_id(stage(spark, docs, SF), "doc_id")) <= 5
        assert stage(spark, docs.limit(0), SF).count() == 0


