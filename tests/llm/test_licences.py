import random
import re

import pytest

from millrace.llm import licences, queries

FOLDER = "/root/testdata/sf0.001"
CASES = [None, "", "mit license", "MIT-License", "mit licenseé", "the Apache License; apache  license general public license",
         "general public licence", "x Licensed under CC BY-NC 4.0. y", "word " * 70_000 + "mit license",
         "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and also "
         "associated documentation files, to deal in the Software without any restriction, including without "
         "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies",
         "mit mit license license", "This work is licensed under the"]


def brute(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places = []
    for phrase, label in licences.PHRASES.items():
        p = phrase.split()
        places += [(label, k) for k in range(len(words)) if words[k:k + len(p)] == p]
    return len(words), sorted(places, key=lambda p: (p[1], p[0]))


def test_base_places_equal_brute_force(spark):
    docs = spark.createDataFrame([(n, t, "c") for n, t in enumerate(CASES)] + [(None, "MIT license", "d")],
                                 "doc_id long, text string, spans string")
    texts = dict(enumerate(CASES)) | {None: "MIT license"}
    for r in licences.scan(docs).collect():
        assert (r.n_words, [tuple(p) for p in r.places]) == brute(texts[r.doc_id])
    assert licences.scan(docs.limit(0)).count() == 0


def test_statistics_equal_brute_force():
    sequences = [[1, 2, 3, 1, 2, 4], [2, 3, 1, 5], [1, 2, 3, 1, 2, 4], [7], [3, 3, 3]]
    grams = {tuple(s[a:b]) for s in sequences for a in range(len(s)) for b in range(a + 1, len(s) + 1)}
    automaton = licences.SuffixAutomaton(sequences)
    read = [1, 2, 3, 1, 2, 3, 1, 5, 3, 3, 3, 3, 9, 7, 2, 4, 1, 2, 3, 1, 2, 4]
    for n, (state, length) in enumerate(automaton.statistics(read)):
        best = max((k for k in range(n + 2) if tuple(read[n + 1 - k:n + 1]) in grams), default=0)
        assert length == best
        if length:
            seen = {(i, e) for i, s in enumerate(sequences) for e in range(len(s))
                    if e + 1 >= length and s[e + 1 - length:e + 1] == read[n + 1 - length:n + 1]}
            assert set(automaton.ends[state]) == seen


def test_spans_are_chained():
    scanner = licences.LicenceScanner()
    assert [s[0] for s in scanner.scan(CASES[9])[2]] == ["mit"] and scanner.scan(CASES[9])[2][0][3] > 0.9
    assert scanner.scan(CASES[7])[2] == [("cc-by-nc", 1, 8, 1.0)]
    assert [s[0] for s in scanner.scan(CASES[11])[2]] == []


def common(read, template):
    """Words of the longest common subsequence."""
    row = [0] * (len(read) + 1)
    for w in licences.words_of(template):
        last = 0
        for k, r in enumerate(read, 1):
            last, row[k] = row[k], last + 1 if r == w.decode() else max(row[k], row[k - 1])
    return row[-1]


@pytest.mark.parametrize("number", range(len(licences.TEMPLATES)))
def test_every_template_is_found_with_changed_words(number):
    label, text = licences.TEMPLATES[number]
    scanner, words = licences.LicenceScanner(), [w.decode() for w in licences.words_of(text)]
    dice = random.Random(number)
    for changes in (0, 1, 1, 2, 3):
        changed = sorted(dice.sample(range(len(words)), min(changes, len(words) // 10)))
        edges = [-1, *changed, len(words)]
        runs = [(a + 1, b) for a, b in zip(edges, edges[1:]) if b - a - 1 >= licences.MIN_MATCH]
        read = [w if k not in changed else "zzz" for k, w in enumerate(words)]
        found = scanner.scan("zzz " * 7 + " ".join(read) + " zzz" * 7)[2]
        if sum(b - a for a, b in runs) >= 0.8 * len(words):
            alike = max(common(read, o) for other, o in licences.TEMPLATES if other != label)
            assert (7 + runs[0][0], 7 + runs[-1][1]) in [s[1:3] for s in found]
            if alike < len(words) - len(changed):  # else the changed word is what tells two licences apart
                assert (label, 7 + runs[0][0], 7 + runs[-1][1]) in [s[:3] for s in found]
        assert all(a[2] <= b[1] for a, b in zip(found, found[1:]))


def test_later_parts_and_families():
    scanner = licences.LicenceScanner()

    def labels(*numbers):
        return [s[0] for s in scanner.scan(" zzz ".join(licences.TEMPLATES[n][1] for n in numbers))[2]]

    by_label = {}
    for n, (label, _) in enumerate(licences.TEMPLATES):
        by_label.setdefault(label, []).append(n)
    for label, numbers in by_label.items():
        assert set(labels(*numbers)) == {label}
    assert [s[0] for s in scanner.scan("this library is free software you can redistribute it")[2]] == []


def test_strongest_of_overlapping_spans_equals_brute_force():
    dice = random.Random(5)
    for _ in range(200):
        spans = []
        for _ in range(dice.randrange(9)):
            start = dice.randrange(20)
            spans.append((dice.randrange(1, 6), start, dice.choice("abc"), start + dice.randrange(1, 8), dice.choice((0.7, 1.0))))
        kept = []
        for _, start, label, end, share in sorted(spans, key=lambda s: (-s[0], -s[4], *s[1:4])):
            if all(end <= k[1] or k[2] <= start for k in kept):
                kept.append((label, start, end, share))
        assert licences._apart(spans) == sorted(kept, key=lambda k: k[1])


def test_query_on_the_table(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = queries.op10_license_scans(spark, FOLDER).collect()
    assert len(rows) == len(docs)
    for r in rows:
        n, places = brute(docs[r.doc_id])
        starts = [k for _, k in places]
        assert (r.n_words, r.n_base, r.base_labels) == (n, len(places), ",".join(sorted({p for p, _ in places})))
        assert (r.first_word, r.last_word) == (min(starts, default=None), max(starts, default=None))
        assert set(r.base_labels.split(",")) <= set(r.labels.split(",")) | {""} and 0 <= r.score <= 1
