import sys
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
import sentencepiece

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
from millrace.llm import mixing, quality  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


def shingles(text):
    w = text.lower().split()
    return {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)}


def test_stages_equal_brute_force(spark):
    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    names = list(stages)
    good = stages[names[0]](spark, docs, FOLDER)
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").filter(corpus_pipeline.fold() != 0)
    model = quality.fit(docs, labels)
    given = docs.collect()
    scores = quality.vote(model, [r.text for r in given])
    rows = good.collect()
    assert {r.doc_id for r in rows} == {r.doc_id for r, s in zip(given, scores) if s >= 0.3}

    once = stages[names[1]](spark, good, FOLDER)
    keep = {}
    for r in rows:
        keep[r.text] = max(keep.get(r.text, -1), r.doc_id)
    rows = once.collect()
    assert {r.doc_id for r in rows} == set(keep.values()) and once.columns == docs.columns

    apart = stages[names[2]](spark, once, FOLDER)
    sets = {r.doc_id: shingles(r.text) for r in rows}
    label = {i: i for i in sets}
    for _ in range(5):
        for a in sets:
            for b in sets:
                if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    label[a] = label[b] = min(label[a], label[b])
    rows = apart.collect()
    assert {r.doc_id for r in rows} == set(label.values()) and apart.columns == docs.columns

    mix = stages[names[3]](spark, apart, FOLDER)
    taken = {r.doc_id: r.taken // r.size for r in mixing.mix(apart).collect() if r.size}
    rows = mix.collect()
    assert Counter(r.doc_id for r in rows) == {i: n for i, n in taken.items() if n} and mix.columns == docs.columns

    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    text = {r.doc_id: r.text for r in rows}
    coded = stages[names[4]](spark, mix, FOLDER).collect()
    assert len(coded) == len(rows)
    for r in coded:
        ids = sp.encode(text[r.doc_id], add_bos=True, add_eos=True)
        assert np.frombuffer(r.ids, "<u4").tolist() == ids and r.decoded == sp.decode(ids)


def test_awkward_rows_pass_every_stage(spark, tmp_path):
    rows = [(1, None, "en", "s", 0), (None, "The and of it was.", None, None, None), (2, "", "en", "s", 0),
            (3, "The and of it was.", "en", "s", 18), (3, "The and of it was.", "en", "s", 18), (4, "x " * 50_000, "en", "t", 1)]
    names = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, names).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(3, 1), (4, 0)], "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in out} <= {3, 4}
    for name, stage in corpus_pipeline.STAGES:
        empty = spark.createDataFrame([], names + ", _own_cls int, score int")
        assert stage(spark, empty, str(tmp_path)).count() == 0, name
