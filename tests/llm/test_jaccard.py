import random
import re

import numpy as np
import pytest

from millrace.llm import jaccard


def shingles(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(w[k:k + 4]) for k in range(len(w) - 3)} if len(w) >= 4 else {tuple(w)} if w else set()


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    n = len(rows)
    near = [[a != b and bool(sets[a]) and bool(sets[b]) and
             100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]) for b in range(n)] for a in range(n)]
    label = list(range(n))
    changed = True
    while changed:
        new = [min([label[a], *(label[b] for b in range(n) if near[a][b])]) for a in range(n)]
        changed, label = new != label, new
    name = {g: min((rows[a][0] for a in range(n) if label[a] == g and rows[a][0] is not None), default=None) for g in label}
    return sorted(((i, len(sets[a]), name[label[a]], sum(near[a])) for a, (i, _) in enumerate(rows)), key=repr)


def got(spark, rows):
    frame = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, component_id int")
    return sorted((tuple(r) for r in jaccard.jaccard_join(frame).collect()), key=repr)


def texts(seed, families=12, size=12, words=150):
    """Families of edited copies with shared passages, some of them chained."""
    draw = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(300)]
    passage = [f"p{k}" for k in range(40)]
    out = []
    for _ in range(families):
        base = [draw.choice(vocabulary) for _ in range(draw.randint(5, words))]
        if draw.random() < 0.5:
            base = passage + base[:draw.randint(1, 20)]
        for _ in range(draw.randint(1, size)):
            base = list(base)
            for _ in range(draw.choice((0, 1, 1, 2))):
                base[draw.randrange(len(base))] = draw.choice(vocabulary)
            out.append(" ".join(base[:draw.choice((len(base), len(base), len(base) - 1))]))
    return out


def test_awkward_rows(spark):
    rows = [(7, None), (6, ""), (5, " \n\t"), (4, "one two"), (3, "ONE\ttwo"), (2, "one two three four"),
            (1, "one two three four five"), (9, "x" * 60_000), (8, "a b c d " * 4000), (10, "a b c d " * 3999),
            (None, "one two"), (4, "one two"), (None, "lonely null"), (11, "É é e f"), (12, "é é e f")]
    assert got(spark, rows) == brute(rows)
    assert got(spark, []) == []


@pytest.mark.parametrize("block", [512, 6])
def test_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(jaccard, "BLOCK_SETS", block)
    monkeypatch.setattr(jaccard, "RANGE_BYTES", 3000)
    monkeypatch.setattr(jaccard, "STEP", 5)
    rows = [(n, t) for n, t in enumerate(texts(block))]
    want = brute(rows)
    assert sum(r[3] for r in want) > 100
    assert got(spark, rows) == want


def test_trie_equals_brute_force(monkeypatch):
    monkeypatch.setattr(jaccard, "STEP", 3)
    for seed in range(40):
        draw = random.Random(seed)
        base = [draw.sample(range(60), draw.randint(1, 40)) for _ in range(4)]
        sets = []
        for _ in range(30):
            one = set(draw.choice(base))
            for _ in range(draw.randint(0, 4)):
                one ^= {draw.randrange(70)}
            sets.append(sorted(one or {1}))
        links = dict(jaccard.trie_links([np.array(s, np.uint64) for s in sets], 85))
        for a, s in enumerate(sets):
            want = [b for b, t in enumerate(sets) if a != b and 100 * len({*s} & {*t}) >= 85 * len({*s} | {*t})]
            assert sorted(links.get(a, np.empty(0)).tolist()) == want


def test_one_of_each_group_stays(spark):
    rows = [(n, t, "s") for n, t in enumerate(texts(3))] + [(900, None, "s"), (901, "", None), (None, "p q r s t", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n string")
    kept = jaccard.drop_similar(docs)
    want = {r[0] for r in brute([r[:2] for r in rows]) if r[0] == r[2]}
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted(want, key=repr)
