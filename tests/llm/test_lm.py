import math
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pandas as pd

from millrace.llm import lm, queries, words

END = None


def tokens(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), END]


class Brute:
    """The same model with dictionaries."""

    def __init__(self, texts):
        runs = [tokens(t) for t in texts]
        self.c = Counter(t for r in runs for t in r)
        self.pairs = Counter(p for r in runs for p in zip([END, *r], r))
        self.before = Counter(w for _, w in self.pairs)
        self.n, self.v = sum(self.c.values()), len(self.c)

        def discounts(counts):
            k = Counter(counts)
            return lm._discounts(k[1], k[2], k[3], k[4])

        self.d2, self.d1 = discounts(self.pairs.values()), discounts(self.before.values())

    @staticmethod
    def cut(count, d):
        return max(0.0, count - d[min(count, 3) - 1]) if count else 0.0

    def unigram(self, w):
        if not self.pairs:
            return 1 / (self.v + 1)
        rest = sum(self.d1[min(b, 3) - 1] for b in self.before.values()) / len(self.pairs)
        return self.cut(self.before[w], self.d1) / len(self.pairs) + rest / (self.v + 1)

    def p(self, u, w):
        if not self.c[u]:
            return self.unigram(w)
        rest = sum(self.d2[min(n, 3) - 1] for (a, _), n in self.pairs.items() if a == u)
        return self.cut(self.pairs[u, w], self.d2) / self.c[u] + rest / self.c[u] * self.unigram(w)

    def row(self, text):
        t = tokens(text)
        base = sum(math.log10((self.c[w] + 0.5) / (self.n + 0.5 * (self.v + 1))) for w in t)
        return len(t), sum(self.c[w] > 0 for w in t), base, sum(math.log10(self.p(u, w)) for u, w in zip([END, *t], t))


TRAIN = [None, "", "a b c", "A b\tc d\r\nb", "the cat sat on the mat", "the cat sat", "é é x", "a b a b a b", "a b",
         "long " * 300, "w" * 70_000]
TEST = [*TRAIN, "unknown words only", "the the cat", "a b unknown c", "ı İ K"]


def close(a, b):
    return len(a) == len(b) and all(math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-9) for x, y in zip(a, b))


def test_scores_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(lm, "CELL_BYTES", 2000)  # several cells and ranges
    train = spark.createDataFrame([(t,) for t in TRAIN], "text string").repartition(3)
    model, brute = lm.train(train), Brute(TRAIN)
    assert (model.tokens, model.vocabulary, model.pairs) == (brute.n, brute.v, len(brute.pairs)) and model.side > 2
    docs = spark.createDataFrame([(n, t, 0.0) for n, t in enumerate(TEST)], "doc_id long, text string, score double")
    for r in lm.score(docs, model, {"doc_id": "doc_id"}).collect():
        assert close(tuple(r)[1:], brute.row(TEST[r.doc_id])), TEST[r.doc_id]
    for u in ("the", "a", END, "never"):
        assert math.isclose(sum(brute.p(u, w) for w in [*brute.c, "unseen"]), 1, rel_tol=1e-9)


def test_nothing_to_learn_from(spark):
    none = spark.createDataFrame([], "text string")
    model = lm.train(none)
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    rows = {r.doc_id: tuple(r)[1:] for r in lm.score(docs, model, {"doc_id": "doc_id"}).collect()}
    assert rows == {1: (3, 0, 0.0, 0.0), 2: (1, 0, 0.0, 0.0)}
    assert lm.score(docs.limit(0), model, {"doc_id": "doc_id"}).count() == 0


def test_words_in_windows(monkeypatch):
    texts = ["aa bb  cc", "", " ", "dd\n\nee ff", "x" * 100 + " y", "\x0b\x0czz"]
    whole = words.word_hashes(texts)
    monkeypatch.setattr(words, "WINDOW_BYTES", 3)
    cut = words.word_hashes(texts)
    assert whole[0].tolist() == cut[0].tolist() and whole[1].tolist() == cut[1].tolist() == [3, 0, 0, 3, 2, 1]
    assert words.word_hashes(["AA"])[0][0] == whole[0][0] and len(set(whole[0].tolist())) == 9


def test_query_on_the_table(spark):
    folder = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}

    def held(i):
        return zlib.crc32(str(i).encode()) % 5 == 1

    brute = Brute([t for i, t in docs.items() if not held(i)])
    rows = queries.op8_lm_scoring(spark, folder).collect()
    assert len(rows) == len(docs) and {r.train_tokens for r in rows} == {brute.n}
    for r in rows[:60]:
        t = tokens(docs[r.doc_id])
        base = sum(math.log10((brute.c[w] + 0.5) / (brute.n + 0.5 * (brute.v + 1))) for w in t)
        assert (r.held_out, r.n_tokens, r.n_known) == (held(r.doc_id), len(t), sum(brute.c[w] > 0 for w in t))
        assert math.isclose(r.base_score, base, rel_tol=1e-9)
    per = [(r.score / r.n_tokens, r.base_score / r.n_tokens) for r in rows if r.held_out]
    assert sum(a > b for a, b in per) > 0.9 * len(per)


def test_runs_are_counted_without_a_column_beside_them():
    rng = np.random.default_rng(7)
    words = rng.integers(0, 2**63, 40_000).astype("<u8")
    for length, n in ((2, 300), (3, 40_000), (7, 4_000)):  # seven columns pass 64 bits, if not shortened in between
        rows = words[rng.integers(0, min(n, len(words)), (n, length))]
        rows = np.concatenate((rows, rows[: n // 3]))
        want, seen = np.unique(rows, axis=0, return_counts=True)
        for counts in (None, np.full(len(rows), 2, np.uint64)):
            columns, summed = lm._distinct_runs(list(rows.T), counts)
            assert np.array_equal(np.stack(columns, 1), want)
            assert np.array_equal(summed, seen * (1 if counts is None else 2))
    numbers = rng.integers(0, 50_000, 1_000_000).astype(np.uint32)
    columns = lm._back(numbers, np.full(1_000, 1_000), 0, 3)
    tracemalloc.start()
    runs, summed = lm._distinct_runs(columns, None, 50_000)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert int(summed.sum()) == 1_000_000 and len(runs) == 3
    assert peak < 60 * len(numbers)  # bytes


def test_a_cell_is_merged_in_little_memory(tmp_path):
    """Bytes for each run that comes in: moved, held at most, and passed on."""
    rng, rows = np.random.default_rng(3), []
    vocabulary = rng.integers(0, 2**63, 60_000).astype("<u8")
    for _ in range(4):
        tokens = vocabulary[(60_000 * rng.random((3, 150_000)) ** 3).astype(int)]
        columns, counts = lm._distinct_runs(list(tokens), None)
        rows += lm._packed(np.zeros(len(counts), np.int64), columns, counts)
    frame = pd.DataFrame(rows, columns=["place", "tokens", "numbers", "widths"])
    tracemalloc.start()
    out = lm._merge_cell(str(tmp_path), 1, 2, 3, 3)(frame)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    sizes = [sum(len(x) for c in ("tokens", "ids", "numbers") if c in f for x in f[c] if x is not None) for f in (frame, out)]
    assert sizes[0] < 8 * 600_000 and peak < 240 * 600_000 and sizes[1] < 12 * 600_000
