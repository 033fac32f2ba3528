from collections import defaultdict
from types import SimpleNamespace

import pytest

from millrace.llm import mixing, queries
from oracle import compare, connect


def targets(sizes):
    """Water filling by hand: sizes by source in order."""
    weights = [k % 3 + 1 for k in range(len(sizes))]
    target, open_ = [0.0] * len(sizes), set(range(len(sizes)))
    rest = sum(sizes)
    while open_:
        level = rest / sum(weights[k] for k in open_)
        above = {k for k in open_ if weights[k] * level > 3 * sizes[k]}
        if not above:
            for k in open_:
                target[k] = weights[k] * level
            break
        for k in above:
            target[k] = 3.0 * sizes[k]
            rest -= 3 * sizes[k]
        open_ -= above
    return target


def docs_of(spark, many=60):
    rows = [(n, "w " * (n % 7 + 1), ["b", "a", "é", None, "tiny", "Z"][n % 6 if n % 4 else 0]) for n in range(many)]
    rows += [(100, None, "a"), (101, "", "empty"), (None, "x y", "a"), (5, "w w", "b"), (5, "w w", "b"), (102, "v " * 3000, "tiny")]
    return rows, spark.createDataFrame([(*r, 1.5) for r in rows], "doc_id long, text string, source string, target double")


@pytest.mark.parametrize("bucket", [1000, 3])
def test_targets_and_takes(spark, monkeypatch, bucket):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", bucket)
    rows, docs = docs_of(spark)
    size, most = defaultdict(int), defaultdict(int)
    for _, t, s in rows:
        n = len((t or "").split())
        size[s] += n
        most[s] = max(most[s], n)
    order = sorted((s for s in size if s is not None), key=lambda s: s.encode()) + [None]
    want = dict(zip(order, targets([size[s] for s in order])))
    source = {(i, len((t or "").split())): s for i, t, s in rows}
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    taken = defaultdict(int)
    for r in got:
        s = source[r.doc_id, r.size]
        assert (r.source_size, r.target) == (size[s], want[s]) and r.taken <= 3 * r.size and r.taken % max(1, r.size) == 0
        assert r.first_position is None or 0 <= r.first_position <= 1
        taken[s] += r.taken
    assert all(abs(taken[s] - want[s]) <= most[s] / 2 + 1e-6 for s in want)
    again = mixing.mix(docs.repartition(5)).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))


def test_curriculum_repeats_whole_rows_in_order(spark):
    rows, docs = docs_of(spark)
    copies = defaultdict(int)
    for r in mixing.mix(docs).collect():
        if r.size:
            copies[r.doc_id, r.size] += r.taken // r.size
    out = mixing.curriculum(docs)
    seen = defaultdict(int)
    for r in out.collect():
        n = len((r.text or "").split())
        if n:
            seen[r.doc_id, n] += 1
    assert out.columns == docs.columns and seen == {k: v for k, v in copies.items() if v}


def test_weights_move_over_time(spark):
    """With drift 0.5, 0, -0.5 the sources' middles lie late, in the middle and early."""
    rows = [(n, "a b c", "abc"[n % 3]) for n in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    seen = [r.source for r in mixing.curriculum(docs).collect()]
    middle = {s: sum(k for k, x in enumerate(seen) if x == s) / seen.count(s) for s in "abc"}
    assert middle["a"] > middle["b"] > middle["c"]


def test_empty_tables(spark):
    docs = docs_of(spark)[1]
    assert mixing.mix(docs.limit(0)).count() == 0 == mixing.curriculum(docs.limit(0)).count()
    silent = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    assert {(r.target, r.taken) for r in mixing.mix(silent).collect()} == {(0.0, 0)}


def test_the_query_goes_through_schedule_and_ranges(spark):
    """The inverted integral and the range exchange are in the optimised plan of the query."""
    plan = queries.op7_mixing(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "SQRT" in plan and "rangepartitioning(first_position" in plan


def test_query_equals_its_sql(spark):
    name, folder = "op7_mixing", "/root/testdata/sf0.001"
    assert not compare(spark, connect(folder), SimpleNamespace(run=queries.QUERIES[name], sql=queries.SQL[name]), folder)
