"""The counts of FIXTURES.md, written out, at sf0.001."""

from conftest import rows

from millrace.operators.gate import gate_totals, rows_in
from millrace.plans import silver
from millrace.sources.retail import RetailTables

FOLDER = "/root/testdata/sf0.001"


def test_rule_counts_and_verdicts(spark):
    raw = RetailTables(spark, FOLDER)
    results = silver.results(silver.tag_all(silver.conform(raw.all))).persist()
    assert dict(rows(results, "rule", "violations")) == {
        "R1": 1, "R2": 11, "R4": 6, "R5": 44, "R6": 20, "R7": 34, "R8": 110, "R17": 354,
        "R10": 16, "R12": 29, "R13": 11, "R14": 4}
    totals = gate_totals(results, rows_in(list(raw.all.values())), 5.0, 2.5)
    assert rows(totals, "threshold_pct", "fail_violations", "rows_quarantined", "rows_in", "status") == [
        (2.5, 242, 249, 7729, "HALT"), (5.0, 242, 249, 7729, "PASS")]
    results.unpersist()
