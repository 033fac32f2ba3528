import hashlib

from millrace.llm import exact

ROWS = [(1, "a"), (2, "a"), (9, "a"), (3, "b"), (None, "b"), (4, None), (5, ""), (6, "A"), (7, "x" * 100_000),
        (8, "x" * 100_000), (10, "x" * 99_999 + "y"), (2, "a"), (None, "only null"), (None, "only null"), (11, "é"),
        (12, "c"), (12, "c"), (13, "x" * 256 + "1"), (14, "x" * 256 + "2")]


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    return {t: (max((i for i in ids if i is not None), default=None), len(ids)) for t, ids in groups.items()}


def test_equals_brute_force(spark):
    docs = spark.createDataFrame([(i, t, False, 7) for i, t in ROWS], "doc_id long, text string, kept boolean, _len int")
    want = brute(ROWS)
    text_of = {hashlib.sha256(t.encode()).hexdigest(): t for t in want}
    rows = exact.exact_dedup(docs.repartition(3), digests=True).collect()
    assert len(rows) == len(ROWS)
    for r in rows:
        assert (r.keep_id, r.group_size) == want[text_of[r.text_sha256]]
    kept = [r for r in rows if r.kept]
    assert len(kept) == len(want) and all(r.doc_id == r.keep_id for r in kept)
    lazily = exact.exact_dedup(docs.repartition(3)).collect()
    assert sorted(map(repr, (tuple(r)[:4] for r in rows))) == sorted(map(repr, (tuple(r)[:4] for r in lazily)))


def test_one_row_of_each_text_stays(spark):
    docs = spark.createDataFrame([(i, t, 7) for i, t in ROWS], "doc_id long, text string, _len int").repartition(3)
    kept = exact.drop_exact_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(((r.text or "", r.doc_id) for r in kept.collect()), key=repr) == sorted(
        ((t, k) for t, (k, _) in brute(ROWS).items()), key=repr)
    assert exact.drop_exact_copies(docs.limit(0)).count() == 0 == exact.exact_dedup(docs.limit(0)).count()
