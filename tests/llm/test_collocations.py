import random
import re
from collections import Counter, defaultdict
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from millrace.llm import collocations, queries
from oracle import compare, connect


def brute(rows, least, top):
    """Every phrase counted, every cut tried, every longer phrase looked at."""
    counts = defaultdict(Counter)
    for lang, text in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            for m in range(1, 6):
                counts[lang or "und"].update(tuple(words[i:i + m]) for i in range(len(words) - m + 1))
    out = []
    for lang, f in counts.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        candidates = [p for p, c in f.items() if len(p) > 1 and c >= least]
        held = set()
        for q in candidates:
            for s in range(2, len(q)):
                held |= {q[i:i + s] for i in range(len(q) - s + 1) if f[q] >= f[q[i:i + s]]}
        found = []
        for p in candidates:
            score, k = min((1000 * f[p] * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            if p not in held:
                found.append((-score, -f[p], " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, rank, p.decode(), -a, l, r, n, -score) for rank, (score, a, p, l, r) in enumerate(sorted(found)[:top], 1)]
    return sorted(out)


def texts(seed, many=300, vocabulary=25):
    draw = random.Random(seed)
    words = [f"w{k}" for k in range(vocabulary)] + ["É", "Xx", "日本"]
    weights = [1 / (k + 1) for k in range(len(words))]
    fixed = ["the quick brown fox jumps over it", "a b c d e f", "new york city", "New York"]
    out = []
    for n in range(many):
        parts = [" ".join(draw.choices(words, weights, k=draw.randrange(0, 9))) for _ in range(4)] + draw.sample(fixed, 2)
        draw.shuffle(parts)
        out.append((draw.choice(["en", "en", "fr", None]), draw.choice([". ", ", ", "\n", "  ", "\t"]).join(parts)))
    return out


def table(spark, rows):
    return spark.createDataFrame([(n, *r, 1) for n, r in enumerate(rows)], "doc_id long, lang string, text string, n int").repartition(5)


@pytest.mark.parametrize("least,top,first,chunk", [(5, 2000, None, 1 << 20), (4, 8, 10, 40)])
def test_equals_brute_force(spark, monkeypatch, least, top, first, chunk):
    real = collocations._read

    def small(batches):
        collocations.CHUNK_WORDS, collocations.SLICE_BYTES = chunk, 200
        yield from real(batches)
        collocations.CHUNK_WORDS, collocations.SLICE_BYTES = 1 << 20, 1 << 20

    monkeypatch.setattr(collocations, "_read", small)
    rows = texts(least) + [("en", None), ("fr", ""), ("de", "only once here"), ("en", "same words " * 500), ("und", "a b c d e f")]
    got = collocations.collocations(table(spark, rows), least, top, first_pairs=first)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, least, top)


def test_growth_stops_when_settled(spark, monkeypatch):
    """Frequent first words are never expanded once the last rank is out of their reach."""
    rows = [("en", f"rare{k} pair{k}") for k in range(30) for _ in range(3)] + [("en", f"common x{k % 7} y{k % 5}") for k in range(3000)]
    grown = []
    real = collocations._grown
    monkeypatch.setattr(collocations, "_grown", lambda *given: grown.append(real(*given)) or grown[-1])
    got = collocations.collocations(table(spark, rows), 3, 10, first_pairs=20)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, 3, 10)
    # 20 of the rare words, then the 10 others that tie; the band of `common` and of the x is left alone.
    assert len(grown) == 2


def test_empty_table(spark):
    assert collocations.collocations(table(spark, texts(1)).limit(0)).collect() == []
    assert collocations.collocations(table(spark, [("en", "a b"), (None, None)])).collect() == []


def test_products_pass_64_bits(spark):
    big = 3_000_000_000_000
    one = spark.range(1).select(collocations._floor_ratio(F.lit(big), F.lit(5 * big), F.lit(big + 1), F.lit(big)))
    assert one.first()[0] == 1000 * big * 5 * big // ((big + 1) * big)


def test_query_equals_its_sql(spark):
    name, folder = "op12_collocations", "/root/testdata/sf0.01"
    assert not compare(spark, connect(folder), SimpleNamespace(run=queries.QUERIES[name], sql=queries.SQL[name]), folder)


def test_words_and_pairs_move_packed(spark, monkeypatch):
    """A row for each chunk and place, not for each word or pair of a chunk; any number of places counts the same."""
    rows, kept, real = texts(7), {}, collocations.settle
    monkeypatch.setattr(collocations, "PLACE_WORDS", 1_000)
    monkeypatch.setattr(collocations, "settle", lambda df, purpose: kept.setdefault(purpose, []).append(real(df, purpose)) or kept[purpose][-1])
    got = collocations.collocations(table(spark, rows), 5, 2000)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, 5, 2000)
    (words,), (pairs,) = ([m.filter("chunk is not null") for m in kept[p]] for p in ("word-places", "pair-places"))
    assert words.select("place").distinct().count() > 3 and pairs.select("place").distinct().count() > 6
    for met in (words, pairs):
        assert met.groupBy("chunk", "place").count().filter("count > 1").isEmpty()
