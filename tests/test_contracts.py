import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace.operators import gate, keys, references
from millrace.operators.rules import (
    FAIL, WARN, ForeignKeyRule, Lookup, RowRule, UniqueRule, check, conformance_gap, examples,
)
from millrace.operators.tagging import rejected, survivors, tag
from millrace.plans import silver


def lines(spark, data):
    return spark.createDataFrame(data, "id string, depot string, qty int, price double, due string")


def test_null_key_is_an_orphan_only_where_asked(spark):
    child = spark.createDataFrame([("a",), (None,), ("z",)], "k string")
    parent = spark.createDataFrame([("a",), (None,), ("a",)], "k string")
    strict = tag(child, "t", [ForeignKeyRule("R", "k", "parent", parent=parent, parent_column="k")])
    assert rows(rejected(strict), "k") == sorted([("z",), (None,)], key=repr)
    lenient = tag(child, "t", [ForeignKeyRule("R", "k", "parent", parent=parent, parent_column="k", null_is_orphan=False)])
    assert rows(rejected(lenient), "k") == [("z",)]
    assert rows(references.orphans(child, "k", parent, "k"), "k") == rows(rejected(strict), "k")
    assert rows(references.orphans(child, "k", parent, "k", null_is_orphan=False), "k") == [("z",)]
    assert rows(references.with_parent(child, "k", parent, "k"), "k") == [("a",)]
    report = references.fk_report(child, "k", parent, "k", "c").first()
    assert (report["orphans"], str(report["orphan_pct"]), report["first_bad_keys"]) == (1, "50.00", "z")


def test_repeated_null_keys_survive(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("b", 1), ("b", 2), ("c", 1)], "k string, v int")
    judged = tag(df, "t", [UniqueRule("R", "k", "unique")])
    assert rows(rejected(judged), "k", "v") == [("b", 1), ("b", 2)]
    assert rows(survivors(judged), "k", "v") == sorted([("c", 1), (None, 1), (None, 2)], key=repr)
    log = gate.rule_results([judged]).first()
    assert (log["violations"], log["rows_rejected"], log["status"]) == (1, 2, "FAIL")


def test_null_predicate_passes(spark):
    df = spark.createDataFrame([(None,), (0,), (5,)], "q int")
    judged = tag(df, "t", [RowRule("R6", "q", "positive", bad=F.col("q") <= 0)])
    assert rows(survivors(judged)) == sorted([(None,), (5,)], key=repr)


def test_warn_flag_is_always_there(spark):
    df = spark.createDataFrame([(1,), (2,)], "q int")
    judged = tag(df, "t", [RowRule("R5", "q", "present", WARN, bad=F.col("q").isNull())])
    assert rows(survivors(judged), "q", "_dq_r5") == [(1, False), (2, False)]
    assert gate.rule_results([judged]).first()["status"] == "PASS"


def test_identical_rows_of_two_batches_keep_the_earliest_load(spark):
    df = spark.sql(
        "select * from values ('a', 1, timestamp'2026-01-02', 'f2', 'b2'), ('a', 1, timestamp'2026-01-01', 'f1', 'b1'), "
        "('b', 1, timestamp'2026-01-02', 'f2', 'b2') as t(k, v, _ingested_at, _source_file, _ingest_batch)")
    out = keys.drop_identical(df)
    assert out.columns == df.columns
    assert rows(out, "k", "_source_file", "_ingest_batch") == [("a", "f1", "b1"), ("b", "f2", "b2")]
    judged = tag(df, "t", [UniqueRule("R1", "k", "unique")], drop_identical=True)
    assert rejected(judged).count() == 0 and survivors(judged).count() == 2


def test_cost_equal_to_price_passes(spark):
    from millrace.plans.silver import tag_products

    df = spark.createDataFrame([("p", 2.0, 2.0), ("q", 2.1, 2.0)], "product_id string, unit_cost double, unit_price double")
    assert rows(rejected(tag_products(df)), "product_id", "_dq_rule") == [("q", "R2")]


def test_quarantine_names_table_rule_and_expected_value(spark):
    df = lines(spark, [("1", "d", 1, 2.0, None), ("2", "d", 1, 3.0, None)])
    master = spark.createDataFrame([("d", 2.0)], "k string, price double")
    rule = RowRule("R8", "price", "drift", bad=F.round("price", 2) != F.round("_m", 2))
    judged = tag(df, "orders", [rule], [Lookup("depot", master, "k", {"price": "_m"})])
    held = rejected(judged).first()
    assert (held["_dq_table"], held["_dq_rule"], held["_dq_reason"], held["_dq_expected_m"]) == ("orders", "R8", "drift", 2.0)
    assert "_m" not in survivors(judged).columns
    wide = gate.quarantine([judged, tag(df.select("id"), "other", [RowRule("X", "id", "x", bad=F.col("id") == "1")])])
    assert rows(wide, "_dq_table", "id", "price") == [("orders", "2", 3.0), ("other", "1", None)]
    assert rows(gate.triage(wide), "_dq_table", "n_rows") == [("orders", 1), ("other", 1)]


def _total(spark, n):
    return spark.range(n).agg(F.count("*"))


def test_gate_threshold_and_empty_input(spark):
    df = spark.range(100).selectExpr("id", "id < 5 as bad")
    judged = tag(df, "t", [RowRule("R", "id", "r", bad=F.col("bad"))])
    results = gate.rule_results([judged])
    at_limit = gate.enforce(results, _total(spark, 100), 5.0).first()
    assert at_limit["status"] == "PASS" and str(at_limit["violation_pct"]) == "5.00"
    with pytest.raises(gate.ContractViolation, match="5 violations in 100 rows"):
        gate.enforce(results, _total(spark, 100), 4.99)
    empty = tag(df.limit(0), "t", [RowRule("R", "id", "r", bad=F.col("bad"))])
    assert gate.enforce(gate.rule_results([empty]), _total(spark, 0)).first()["status"] == "PASS"


def test_halting_rule_stops_below_the_threshold(spark):
    df = spark.range(100).selectExpr("id", "id = 5 as bad")
    judged = tag(df, "t", [RowRule("R8", "id", "r", halt=True, bad=F.col("bad"))])
    with pytest.raises(gate.ContractViolation):
        gate.enforce(gate.rule_results([judged]), _total(spark, 100))


def _random_table(seed):
    rnd = random.Random(seed)
    pick = lambda *v: rnd.choice(v)
    return [(pick("a", "b", "c", "d", "e", "f", None), pick("x", "y", "z", None), pick(-1, 0, 1, 2, 3, None),
             float(i), pick("t", "t", None)) for i in range(14)]


def _sequential(data, names):
    """The rules one after another on plain tuples: survivors and counts per rule."""
    alive, log, held = list(data), {}, []
    for name in names:
        if name == "U":
            present = [r[0] for r in alive if r[0] is not None]
            bad = [r for r in alive if r[0] is not None and present.count(r[0]) > 1]
            n = len({r[0] for r in bad})
        elif name == "F":
            bad = [r for r in alive if r[1] not in ("x", "y")]
            n = len(bad)
        elif name == "Q":
            bad = [r for r in alive if r[2] is not None and r[2] <= 0]
            n = len(bad)
        else:
            log[name] = len([r for r in alive if r[4] is None])
            continue
        log[name] = n
        held += [(r[3], name) for r in bad]
        alive = [r for r in alive if r not in bad]
    return sorted(r[3] for r in alive), log, sorted(held)


@pytest.mark.parametrize("seed", range(8))
def test_one_pass_equals_rule_after_rule(spark, seed):
    data = _random_table(seed)
    names = ["U", "F", "Q", "W"]
    random.Random(seed + 100).shuffle(names)
    parent = spark.createDataFrame([("x",), ("y",), ("y",)], "d string")
    make = {
        "U": lambda: UniqueRule("U", "id", "unique"),
        "F": lambda: ForeignKeyRule("F", "depot", "parent", parent=parent, parent_column="d"),
        "Q": lambda: RowRule("Q", "qty", "positive", FAIL, bad=F.col("qty") <= 0),
        "W": lambda: RowRule("W", "due", "due", WARN, bad=F.col("due").isNull()),
    }
    judged = tag(lines(spark, data), "t", [make[n]() for n in names])
    want_alive, want_log, want_held = _sequential(data, names)
    kept = survivors(judged)
    assert sorted(r[0] for r in rows(kept, "price")) == want_alive
    assert {r["rule"]: r["violations"] for r in gate.rule_results([judged]).collect()} == want_log
    assert sorted(rows(rejected(judged), "price", "_dq_rule")) == want_held
    # Judging the survivors again rejects nothing.
    again = tag(kept.drop("_dq_w"), "t", [make[n]() for n in names])
    assert rejected(again).count() == 0


def test_rows_are_conserved(spark):
    data = [("a", "x", 1, 1.0, "t")] * 3 + [("b", "x", 1, 1.0, "t"), ("b", "x", 2, 1.0, "t"), ("c", "q", 0, 1.0, None)]
    df = lines(spark, data)
    judged = tag(df, "t", [UniqueRule("U", "id", "unique"), RowRule("Q", "qty", "positive", bad=F.col("qty") <= 0)],
                 drop_identical=True)
    removed = df.count() - df.distinct().count()
    assert survivors(judged).count() + rejected(judged).count() + removed == df.count()
    integrity = keys.key_integrity(df, "id", "t").first()
    assert tuple(integrity) == ("t", "id", 6, 3, 3, 2, "DUP")
    assert rows(keys.duplicate_kind(df, "id")) == [("CONFLICT", 1, 2), ("IDENTICAL", 1, 3)]
    unique, repeated = keys.reject_repeated(df, ["id"])
    assert (unique.count(), repeated.count()) == (1, 5)


def test_reports_do_not_remove_rows(spark):
    df = spark.createDataFrame([(" a",), ("A",), (None,), ("b",)], "s string")
    assert tuple(conformance_gap(df, "s").first()) == ("s", 2, 3, 2)
    assert tuple(check(df, F.col("s").isNull(), "null").first()) == ("null", 1, "FAIL")
    assert rows(examples(df, F.col("s").isNotNull(), ["s"], 2)) == [(" a",), ("A",)]


def test_results_come_from_one_judgement_of_each_table(spark):
    """Children read the written verdicts of their parents; no order line is judged a second time for its deliveries."""
    tables = {
        "products": spark.createDataFrame([(1, 1.0, 2.0), (2, 3.0, 2.0), (3, 1.0, 4.0), (3, 1.0, 5.0), (None, 1.0, 2.0)],
                                          "product_id long, unit_cost double, unit_price double"),
        "depots": spark.createDataFrame([(7,), (8,)], "depot_id long"),
        "orders": spark.createDataFrame(
            [("a", 1, 7, 1, 5, 2.0), ("a", 1, 7, 1, 5, 2.0), ("b", 2, 7, 1, 5, 2.0), ("b", 2, 7, 1, 6, 2.0), ("c", 3, 9, 1, 5, 2.0),
             ("d", 4, 8, 1, 0, 2.0), ("e", 5, 8, 1, 5, 2.5), ("f", 6, 8, 2, 5, 2.0), (None, 7, 8, 3, 5, 2.0), (None, None, 8, 1, 5, 2.0)],
            "order_line_id string, order_id long, depot_id long, product_id long, quantity int, unit_price double",
        ).withColumn("requested_delivery_date", F.when(F.col("order_id") != 6, F.current_date())),
        "deliveries": spark.createDataFrame(
            [(1, 1, False, 1.0), (2, 2, False, 1.0), (3, 6, None, 1.0), (4, 7, True, -1.0), (5, None, True, 1.0)],
            "delivery_id long, order_id long, temperature_breach_flag boolean, distance_km double",
        ).selectExpr("*", "timestamp_ntz'2020-01-01 00:00:00' as dispatched_at", "timestamp_ntz'2020-01-01 01:00:00' as delivered_at"),
    }
    results = silver.judged_results(tables)
    want = silver.results(silver.tag_all(tables))
    names = ("rule", "table", "description", "action", "violations", "rows_rejected", "halts", "status")
    assert rows(results, *names) == rows(want, *names)
    by_rule = {r["rule"]: r["violations"] for r in results.collect()}
    assert (by_rule["R1"], by_rule["R4"], by_rule["R10"], by_rule["R17"]) == (1, 1, 2, 2)
    plan = results._jdf.queryExecution().optimizedPlan().toString()
    assert "Relation [" in plan and "depot_id" not in plan


def test_counts_only_keep_null_and_repeated_keys_apart(spark):
    lines = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1), ("b", 2), (None, 3), (None, 3), (None, 4), ("c", 5)], "k string, v int")
    rules_ = [UniqueRule("U", "k", "k occurs once"), RowRule("V", "v", "v is below five", FAIL, bad=F.col("v") >= 5)]
    counts = [rows(gate.rule_results([tag(lines, "t", rules_, drop_identical=True, to_count=c)]), "rule", "violations", "rows_rejected")
              for c in (False, True)]
    assert counts[0] == counts[1] == [("U", 1, 2), ("V", 1, 1)]
