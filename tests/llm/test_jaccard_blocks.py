import numpy as np
from pyspark.sql import functions as F

from millrace.llm import jaccard

from test_jaccard import brute, got, texts
from test_jaccard import test_trie_equals_brute_force as trie


def test_long_sets_are_cut_by_bytes(spark, monkeypatch):
    """40 long sets are fewer than a block may hold, and too many bytes."""
    monkeypatch.setattr(jaccard, "BLOCK_BYTES", 100_000, raising=False)
    draw = np.random.default_rng(1)
    rows = [(bytes([k]) * 16, 5000, 1, draw.integers(0, 2**63, 5000, np.uint64).tobytes()) for k in range(40)]
    found = spark.createDataFrame(rows, "cls binary, n long, copies long, shingles binary")
    families = found.select("cls", F.lit(b"f").alias("family"))
    units = jaccard._units(found, families, 85)
    size = units.groupBy("unit", "i", "j").agg(F.sum(F.length("shingles")).alias("b"))
    assert size.agg(F.max("b")).first()[0] < 2 * 5 * 100_000 < 40 * 40_000  # blocks of 2.5 sets on average
    pairs = units.alias("a").join(units.alias("b"), ["unit", "i", "j"]).filter("a.cls < b.cls").select("a.cls", "b.cls")
    assert pairs.distinct().count() == 40 * 39 // 2


def test_blocks_by_bytes_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_BYTES", 4000, raising=False)
    monkeypatch.setattr(jaccard, "TABLE_BYTES", 500, raising=False)
    rows = list(enumerate(texts(8)))
    assert got(spark, rows) == brute(rows)


def test_lists_of_sets_equal_brute_force(monkeypatch):
    monkeypatch.setattr(jaccard, "TABLE_BYTES", 0, raising=False)
    trie(monkeypatch)
