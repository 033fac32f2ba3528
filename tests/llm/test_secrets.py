import hashlib
import re
import time

from pyspark.sql import functions as F

from millrace.llm import queries, secrets

FOLDER = "/root/testdata/sf0.01"
RULES = secrets.BASE_RULES + secrets.MORE_RULES


def brute(text):
    spans = []
    for n, rule in enumerate(RULES):
        for m in re.finditer(rule.pattern, text or "", re.ASCII):
            if len(m.group(rule.group)) >= rule.least:
                spans.append((m.start(), n, m.end()))
    return sorted(spans)


CASES = [
    None, "", "password=abc", "secret=token:abcdefgh", "é password = 'hunter22' passwd:\"Zq/9+=-_.x\"",
    "PASSWORD=abcdef token token=abcdef", "AKIA" + "A" * 15, "AKIA" + "B2" * 8 + " AKIAAKIA" + "C" * 16,
    "ab" * 12, "ab" * 12 + "g" + "0" * 23, "\U0001f600 api_key: abcdef apikey='xyz12345'",
    "-----BEGIN RSA PRIVATE KEY-----", "ghp_" + "a1" * 18, "https://user:pa55@host/x", "x" * 50_000 + " token=abcdefg",
    "token=abcdef " * 500, "password=abc", "K token=ſecret", "to\nken=abcdef",
]


def test_spans_equal_a_scan_by_regex(spark):
    rows = [(n, t, "clash") for n, t in enumerate(CASES)] + [(None, "token=abcdef", "x"), (2, "token: 'abcdef'", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    got = sorted(((r.doc_id is None, r.doc_id or 0, [tuple(s) for s in r.spans]) for r in secrets.scan(docs).collect()))
    want = sorted((i is None, i or 0, brute(t)) for i, t, _ in rows)
    assert got == want


def test_many_matches_in_one_text(spark):
    """A log file of 100,000 matches; a square of them would not end."""
    text = "".join(f"token=abc{'defg'[:n % 5]} " for n in range(100_000)) + "0123456789abcdef" * 2
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    start = time.time()
    found = [tuple(s) for s in secrets.scan(docs).first().spans]
    assert found == brute(text) and time.time() - start < 60


def test_queries_hold_in_every_match():
    for rule in RULES:
        for text in filter(None, CASES):
            for m in re.finditer(rule.pattern, text, re.ASCII):
                low = m.group().lower()
                assert all(any(all(t in low for t in s) for s in anyof) for anyof in secrets.trigram_query(rule.pattern))
    assert secrets.trigram_query(r"[0-9a-f]{24,}") == []
    assert secrets.trigram_query("AKIA[A-Z0-9]+") == [[frozenset({"aki", "kia"})]]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert secrets.scan(docs).count() == 0


def test_query_equals_brute_force_on_the_table(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    want = {}
    for doc in docs:
        spans = brute(doc.text)
        listed = [f"{RULES[n].kind}:{a}:{b}" for a, n, b in spans]
        base = ",".join(x for x, s in zip(listed, spans) if s[1] < 3)
        want[doc.doc_id] = (*[sum(s[1] == n for s in spans) for n in range(3)],
                            hashlib.sha256(base.encode()).hexdigest(), ",".join(listed))
    got = queries.op9_secret_scans(spark, FOLDER)
    assert {r.doc_id: tuple(r)[1:] for r in got.collect()} == want
    assert got.agg(F.sum(F.col("n_assign") + F.col("n_access") + F.col("n_hex"))).first()[0] > 0
