import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace.operators.gate import ContractViolation
from millrace.plans import gold, silver
from millrace.session import work_folder
from millrace.sources import audit, raw, tables
from millrace.sources.retail import RetailTables
from millrace.streaming import bronze

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def retail(spark):
    return RetailTables(spark, FOLDER)


def test_raw_csv_keeps_blanks_and_reads_empty_cells_as_null(spark, tmp_path):
    (tmp_path / "depots.csv").write_text("id,city,opened\n1, leeds,2020-01-01\n2,,\n")
    df = raw.read_raw(spark, str(tmp_path / "depots.csv"), ["id", "city", "opened"])
    assert rows(df) == [("1", " leeds", "2020-01-01"), ("2", None, None)]
    assert {f.dataType.simpleString() for f in raw.read_raw(spark, str(tmp_path)).schema} == {"string"}
    inferred = raw.read_inferred(spark, str(tmp_path))
    assert dict(inferred.dtypes)["id"] == "int"
    stamped = raw.stamp(df, "b7").first()
    assert (stamped["_source_file"], stamped["_ingest_batch"]) == ("depots.csv", "b7") and stamped["_ingested_at"]


def test_count_gate(spark):
    ten, nine = spark.range(10), spark.range(9)
    audit.enforce_counts(audit.count_gate({"a": ten}, {"a": ten}))
    with pytest.raises(audit.LandingMismatch, match="b: 10 read, 9 landed"):
        audit.enforce_counts(audit.count_gate({"a": ten, "b": ten}, {"a": ten, "b": nine}))
    with pytest.raises(audit.LandingMismatch):
        audit.enforce_counts(audit.count_gate({"a": ten, "b": ten}, {"a": ten}))


def test_work_folder_is_fresh_and_below_the_shared_one(spark):
    a, b = work_folder(spark, "x"), work_folder(spark, "x")
    assert a != b and a.startswith(spark.conf.get("spark.checkpoint.dir"))


def test_registry_and_lazy_frames(spark):
    spark.range(3).createOrReplaceTempView("silver_things")
    registry = tables.SourceRegistry(spark, "silver_").add("own", spark.range(2))
    assert (registry.ref("own").count(), registry.ref("things").count()) == (2, 3)
    built = []
    frames = tables.Frames({"a": lambda: built.append("a") or 1, "b": lambda: built.append("b") or 2})
    assert frames["a"] == 1 and frames["a"] == 1 and built == ["a"] and len(frames) == 2


def test_raw_text_to_published_silver(spark, retail):
    """Text in, typed and gated tables out, equal to gating the typed tables."""
    text = {name: raw.stamp(raw.as_text(df), "b1", f"{name}.csv") for name, df in retail.all.items()}
    run = silver.publish_silver(silver.type_all(text), "t1_", location=work_folder(spark, "silver"))
    direct = silver.results(silver.tag_all(silver.conform(retail.all)))
    assert rows(run.results, "rule", "violations") == rows(direct, "rule", "violations")
    assert run.totals.first()["status"] == "PASS"
    assert run.quarantine.count() == run.totals.first()["rows_quarantined"]
    flagged = run.tables["orders"]
    assert {"_dq_r5", "_dq_r17", "_ingest_batch"} <= set(flagged.columns) and "_master_price" not in flagged.columns
    star = gold.build_gold(run.tables, silver.type_products(text["products"]))
    published = gold.publish_gold(star, "t1_", location=work_folder(spark, "gold"))
    assert set(published) == {"fact_orders", "fact_deliveries", "dim_depot", "dim_product"}
    assert published["fact_orders"].count() == flagged.count()


def test_a_shut_gate_publishes_nothing_but_the_quarantine(spark, retail):
    typed = silver.conform(retail.all)
    with pytest.raises(ContractViolation):
        silver.publish_silver(typed, "t2_", max_pct=1.0, location=work_folder(spark, "silver"))
    names = {t.name for t in spark.catalog.listTables()}
    assert "quarantine_t2" in names and not any(n.startswith("t2_") for n in names)


def test_stream_appends_each_file_once(spark, tmp_path):
    src, out, log = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "log")
    spark.range(5).write.parquet(str(src / "one"))
    schema, marks = spark.range(1).schema, [str(tmp_path / m) for m in ("c1", "c2")]
    glob = f"{src}/*"

    def run():
        bronze.stream_bronze(bronze.read_files(spark, glob, schema), "b", out, marks[0]).awaitTermination()
        bronze.stream_row_audit(bronze.read_files(spark, glob, schema), out + "2", log, marks[1], "b").awaitTermination()

    run()
    assert spark.read.parquet(out).count() == 5
    spark.range(5, 8).write.parquet(str(src / "two"))
    run()
    run()
    assert spark.read.parquet(out).count() == 8
    assert rows(spark.read.parquet(log), "batch_id", "n_rows") == [(0, 5), (1, 3)]
    assert spark.read.parquet(out + "2").select("id", "_source_file").filter(F.col("_source_file").isNotNull()).count() == 8


def test_adapter_places_copies_and_ghosts(retail):
    lines = retail.order_lines
    assert lines.count() - lines.distinct().count() > 0
    assert retail.deliveries.filter("order_id >= 1000000000").count() > 0
