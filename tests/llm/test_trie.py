import hashlib
import random
import zlib
from collections import defaultdict
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import queries, trie
from oracle import compare, connect


def brute(sequences):
    """{id: [(role, text)]} to the nodes' rows, prefix by prefix; an id may be NULL."""
    members = defaultdict(list)
    for i, turns in sequences:
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append((i, len(turns)))

    def name(p):
        return min((i for i, _ in members[p] if i is not None), default=None)

    kids = defaultdict(list)
    for p in members:
        if p:
            kids[p[:-1]].append(p)

    def under(p):
        todo, out = [p], []
        while todo:
            x = todo.pop()
            out.append(x)
            todo += kids[x]
        return out

    rows = []
    for p, who in members.items():
        tree = under(p)
        saved = sum((len(members[x]) - 1) * len(x[-1][1].replace("\x0b", " ").split()) for x in tree if x)
        ends = ",".join(str(i) for i in sorted(i for i, n in who if n == len(p) and i is not None))
        rows.append((name(p), len(p), name(p[:-1]) if p else None, len(who), len(kids[p]),
                     sum(not kids[x] for x in tree), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(rows, key=repr)


def found(sequences):
    return sorted((tuple(r) for r in trie.prefix_trie(sequences).collect()), key=repr)


def table(spark, sequences):
    rows = [(i, n, role, text, "x") for i, turns in sequences for n, (role, text) in enumerate(turns)]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, depth string")


def talks(many, seed=1):
    draw = random.Random(seed)
    out = []
    for i in range(many):
        turns = [("user", "hello there")] if draw.random() < 0.5 else []
        turns += [(draw.choice("ua"), draw.choice(["a", "b c", "", "d e f"])) for _ in range(draw.randrange(1, 6))]
        out.append((i * 3, turns))
    return out + [(10_000 + k, [("user", "hello there"), ("a", "copy")]) for k in range(many // 2)]


def shrink(monkeypatch, block, edges):
    """Small blocks in workers too."""
    real_first = trie._first_level

    def first(batches):
        trie.BLOCK_CONVS, trie.PIECE_IDS = block, 3
        yield from real_first(batches)
        trie.BLOCK_CONVS, trie.PIECE_IDS = 1 << 15, 256

    monkeypatch.setattr(trie, "_first_level", first)
    monkeypatch.setattr(trie, "EDGES_AT_ONCE", edges)


@pytest.mark.parametrize("block,edges", [(1 << 15, 1 << 15), (7, 1 << 15), (1, 1 << 15), (3, 24)])
def test_equals_brute_force(spark, monkeypatch, block, edges):
    shrink(monkeypatch, block, edges)
    sequences = talks(120) + [(None, [("user", "hello there"), ("a", "b c")]), (-5, [("user", "")])]
    made = trie.turn_sequences(table(spark, sequences))
    assert found(made) == brute(sequences)


def test_awkward_rows(spark):
    rows = [(1, None, "u", "first"), (1, 0, None, None), (1, 5, "u", "x y"), (2, 1, "", "first"), (2, 1, "", "first"),
            (3, 1, "u", "w " * 100_000), (4, 1, "u1", "x"), (5, 1, "u", "1x")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    want = brute([(1, [("u", "first"), ("", ""), ("u", "x y")]), (2, [("", "first")] * 2), (3, [("u", "w " * 100_000)]),
                  (4, [("u1", "x")]), (5, [("u", "1x")])])
    assert found(trie.turn_sequences(turns)) == want
    assert found(trie.turn_sequences(turns.limit(0))) == []


def test_heads_are_shared(spark):
    sequences = [(i, [("u", f"{i} {n}") for n in range(i % 5 + 1)]) for i in (0, 1, 2, 3, 20, 21, 22, 47, 48, 49)]
    own, want = dict(sequences), []
    for i, turns in sequences:
        h = zlib.crc32(str(i).encode()) % 4
        want.append((i, own.get(i - i % 20, [])[:h] + turns[h:]))
    made = trie.turn_sequences(table(spark, sequences))
    shared = trie.share_heads(made, (F.crc32(F.col("id").cast("string").cast("binary")) % 4).cast("int"), F.col("id") - F.col("id") % 20)
    assert found(shared) == brute(want)


def test_extents_equal_a_scan():
    draw = np.random.default_rng(3)
    for n in (1, 2, 3, 8, 33):
        common = np.concatenate(([-1], draw.integers(0, 4, n - 1)))
        row, depth = np.repeat(np.arange(n), 5), np.tile(np.arange(5), n)
        left, right = trie.extents(common, row, depth)
        for r, d, a, b in zip(row, depth, left, right):
            x = y = r
            while x > 0 and common[x] >= d:
                x -= 1
            while y + 1 < n and common[y + 1] >= d:
                y += 1
            assert (a, b) == (x, y)


def test_query_equals_its_sql(spark):
    name, folder = "op11_prefix_trie", "/root/testdata/sf0.01"
    assert not compare(spark, connect(folder), SimpleNamespace(run=queries.QUERIES[name], sql=queries.SQL[name]), folder)
