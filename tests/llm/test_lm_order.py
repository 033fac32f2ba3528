import math
from collections import Counter

import numpy as np
import pandas as pd
import pytest

from millrace import session
from millrace.llm import lm, queries
from millrace.llm.words import word_hashes

from test_lm import END, TEST, TRAIN, close, tokens


class Brute:
    """The model of any order with dictionaries."""

    def __init__(self, texts, order):
        self.order, self.counts = order, {}
        runs = Counter(g for t in texts for g in self.grams(t))
        self.c = Counter(w for t in texts for w in tokens(t))
        self.n, self.v = sum(self.c.values()), len(self.c)
        for k in range(order, 0, -1):
            self.counts[k] = runs
            runs = Counter(g[1:] for g in runs)
        self.d = {}
        for k, counts in self.counts.items():
            found = Counter(counts.values())
            self.d[k] = lm._discounts(found[1], found[2], found[3], found[4])
        self.total, self.rest = Counter(), Counter()
        for k, counts in self.counts.items():
            for g, n in counts.items():
                self.total[g[:-1]] += n
                self.rest[g[:-1]] += self.d[k][min(n, 3) - 1]

    def grams(self, text):
        run = [*[END] * (self.order - 1), *tokens(text)]
        return [tuple(run[k:k + self.order]) for k in range(len(run) - self.order + 1)]

    def p(self, g):
        k = len(g)
        lower = self.p(g[1:]) if k > 1 else 1 / (self.v + 1)
        if not self.total[g[:-1]]:
            return lower
        n = self.counts[k][g]
        cut = max(0.0, n - self.d[k][min(n, 3) - 1]) if n else 0.0
        return (cut + self.rest[g[:-1]] * lower) / self.total[g[:-1]]

    def score(self, text):
        return sum(math.log10(self.p(g)) for g in self.grams(text))


@pytest.mark.parametrize("order", [2, 3, 4])
def test_scores_of_an_order_equal_brute_force(spark, monkeypatch, order):
    monkeypatch.setattr(lm, "CELL_BYTES", 2000)
    train = spark.createDataFrame([(t,) for t in TRAIN], "text string").repartition(3)
    model, brute = lm.train(train, order=order), Brute(TRAIN, order)
    assert (model.tokens, model.vocabulary, model.pairs) == (brute.n, brute.v, len(brute.counts[2]))
    docs = spark.createDataFrame(list(enumerate(TEST)), "doc_id long, text string")
    for r in lm.score(docs, model, {"doc_id": "doc_id"}).collect():
        assert close([r.score], [brute.score(TEST[r.doc_id])]), TEST[r.doc_id]
    for u in (("the", "cat", "sat"), ("never", "a", "b"), (END,) * 3):
        assert math.isclose(sum(brute.p((*u[4 - order:], w)) for w in [*brute.c, "unseen"]), 1, rel_tol=1e-9)


def test_one_text_only(spark):
    """The context of ends alone is seen once, and not as a run of its own."""
    model, brute = lm.train(spark.createDataFrame([("a b a",)], "text string"), order=3), Brute(["a b a"], 3)
    docs = spark.createDataFrame([(0, "a b a"), (1, "b a b"), (2, None)], "doc_id long, text string")
    for r in lm.score(docs, model, {"doc_id": "doc_id"}).collect():
        assert close([r.score], [brute.score(["a b a", "b a b", None][r.doc_id])])


def test_query_looks_two_words_back(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = queries.op8_lm_scoring(spark, folder).collect()
    brute = Brute([texts[r.doc_id] for r in rows if not r.held_out], 3)
    for r in rows[:60]:
        assert math.isclose(r.score, brute.score(texts[r.doc_id]), rel_tol=1e-9)


def test_tokens_are_numbered_by_falling_frequency(spark, tmp_path):
    """Numbers are dense and all different, so runs move without a dictionary; a token that was not counted has none."""
    texts = [*(t or "" for t in TRAIN), "a a a a a a a a rare"]
    lm._number_tokens(str(tmp_path), spark.createDataFrame([(t,) for t in texts], "_text string").repartition(3), 3)
    counts = Counter(w for t in texts for w in tokens(t) if w != END)
    words, _ = word_hashes(list(counts))
    rising = np.argsort(words)
    numbers = dict(zip(np.array(list(counts))[rising].tolist(), lm._numbers(str(tmp_path), 3, words[rising]).tolist()))
    assert len(set(numbers.values())) == len(counts) and max(numbers.values()) <= len(counts) + 1 and min(numbers.values()) >= 1
    levels = [counts[w].bit_length() for w in sorted(counts, key=numbers.get)]
    assert levels == sorted(levels, reverse=True)
    assert lm._numbers(str(tmp_path), 3, word_hashes(["never-seen"])[0]).tolist() == [0]


def test_runs_move_and_stay_in_few_bytes(tmp_path):
    """Rare tokens in many cells: bytes of a run when moved, and no row of facts for each token."""
    rng = np.random.default_rng(5)
    columns, counts = lm._distinct_runs(list((3_000_000 * rng.random((3, 400_000)) ** 4).astype(np.uint64)), None)
    rows = list(lm._packed(lm._cell_of([lm._ids(c) for c in columns], 8), columns, counts))
    assert sum(len(known) + len(data) for _, known, data, _ in rows) < 8 * len(counts)
    frame = pd.DataFrame(rows, columns=["place", "tokens", "numbers", "widths"])
    frame = frame[frame["place"] == frame["place"].iloc[0]]
    assert len(lm._merge_cell(str(tmp_path), 8, 4, 3, 3)(frame)) <= 4 + 4 + 8


def test_spent_facts_are_deleted(spark, tmp_path, monkeypatch):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    cleaned = spark.conf.get(name)
    monkeypatch.setattr(session, "work_root", lambda spark: str(tmp_path))
    lm.train(spark.createDataFrame([(t,) for t in TRAIN], "text string"), order=3)
    assert spark.conf.get(name) == cleaned
    assert {p.name for p in tmp_path.glob("run-facts-3-*/kind=*")} == {f"kind={lm.TO_TOKENS}"}
