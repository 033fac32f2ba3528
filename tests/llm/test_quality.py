import numpy as np
import pytest

from millrace.llm import quality, queries

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    return queries.quality_model(spark, FOLDER)


def test_held_out_rows_are_told_apart(spark):
    scored = {r.doc_id: r for r in queries.op3_quality_classifier(spark, FOLDER).collect()}
    assert len(scored) == 1000
    held = [(scored[r.doc_id], r.quality) for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()
            if scored[r.doc_id].held_out]
    assert np.mean([s.predicted == q for s, q in held]) > 0.95 and len(held) > 50


def test_votes_equal_brute_force(model):
    texts = ["The and of it was.", "WORD!! WORD!! MORE!!", "a | b | c | d", "x" * 200_000, "word " * 40_000, "", "é"]
    got = quality.vote(model, texts)
    for text, score in zip(texts, got):
        f = quality.counts(text)[None]
        if not f.any():
            assert score == 0
            continue
        v = quality._latent(f, model.weights, model.directions)[0]
        near = sorted(((float(v @ u), y) for u, y in zip(model.vectors, model.labels)), reverse=True)
        near = near[:quality.NEIGHBOURS]
        w = [max(c, 0) ** quality.SHARPNESS for c, _ in near]
        want = sum(a * y for a, (_, y) in zip(w, near)) / sum(w) if sum(w) else model.prior
        assert abs(score - want) < 1e-4


def test_awkward_rows(spark, model):
    docs = spark.createDataFrame([(None, None, "s"), (1, "", "s"), (1, "", "s"), (2, "The and of.", None)],
                                 "doc_id long, text string, score string")
    scores = sorted(r.score for r in quality.classify(docs, model, {"doc_id": "doc_id"}).collect())
    assert scores[:3] == [0, 0, 0] and 0 < scores[3] <= 1
    kept = quality.keep_good(docs, model, 0.3)
    assert kept.columns == docs.columns and kept.count() == 1
    assert quality.classify(docs.limit(0), model, {"doc_id": "doc_id"}).count() == 0


def test_nothing_labelled(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, quality int")
    model = quality.fit(docs, labels)
    assert quality.vote(model, ["a b", ""]).tolist() == [0.5, 0.0]


def test_ties_and_repeated_rows_fit(spark):
    docs = spark.createDataFrame([(1, "good text here")] * 3 + [(2, "BAD!! BAD!!"), (3, "good text here")],
                                 "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (3, 1), (9, 0)], "doc_id long, quality int")
    model = quality.fit(docs, labels)
    assert len(model.labels) == 3
    assert quality.vote(model, ["good text here"])[0] > 0.9 > 0.5 > quality.vote(model, ["BAD!! BAD!!"])[0]
