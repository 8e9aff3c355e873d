"""Files that are not quite right, unfinished outputs, and counts without issue rows."""

from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import clean, contracts, quality
from ledgerline.plans import pipeline
from ledgerline.plans.settings import default_settings
from ledgerline.sources import export, ingest, warehouse
from ledgerline.streaming import load as stream
from tests.fixture_data import EVENTS, write_events, write_fixture


def test_malformed_line_then_clean_incremental_run(spark, workdir):
    write_fixture(workdir)
    settings = default_settings(workdir)
    events = settings["raw_files"]["product_events"]
    with open(events, "a", encoding="utf-8") as file:
        file.write("{not json\n")
    pipeline.run_pipeline(spark, settings, mode="full")
    stored = warehouse.read_table(spark, settings["warehouse"], "fact_product_events")
    assert "_corrupt_record" not in stored.columns
    before = stored.count()
    write_events(events, [*EVENTS, ("E-0000077", "C-0001", "U-1", "2025-02-01", "Billing", "view")])
    out = pipeline.run_pipeline(spark, settings, mode="incremental")
    assert out["loaded"]["fact_product_events"] == 1
    assert warehouse.read_table(spark, settings["warehouse"], "fact_product_events").count() == before + 1
    # The plain copy of every stored table follows each load.
    copy = spark.read.parquet(os.path.join(settings["parquet_layers"], "fact_product_events.parquet"))
    assert copy.count() == before + 1


def test_strict_json_from_settings(spark, workdir):
    write_fixture(workdir)
    settings = default_settings(workdir) | {"readers": {"product_events": {"strict": True}}}
    with open(settings["raw_files"]["product_events"], "a", encoding="utf-8") as file:
        file.write("{not json\n")
    with pytest.raises(Exception, match="(?i)malformed|corrupt|not json"):
        pipeline.run_pipeline(spark, settings, mode="full")


def test_json_values_stay_as_written_and_listed_columns_need_no_inference(spark, workdir):
    path = os.path.join(workdir, "e.jsonl")
    with open(path, "w", encoding="utf-8") as file:
        file.write('{"event_id": "E-1", "price": 1.10, "more": "x"}\n')
    row = ingest.read_jsonl(spark, path).first()
    assert (row["event_id"], row["price"], row["more"]) == ("E-1", "1.10", "x")
    contract = {"product_events": {"required_columns": ["event_id"], "extra_columns": ["price"]}}
    listed = ingest.read_raw_tables(spark, {"product_events": path}, contract)["product_events"]
    assert [c for c in listed.columns if not c.startswith("_")] == ["event_id", "price"]
    assert listed.first()["price"] == "1.10"


def test_unfinished_export_counts_as_missing(spark, workdir):
    done, torn = os.path.join(workdir, "done.csv"), os.path.join(workdir, "torn.csv")
    spark.range(1).write.csv(done)
    os.makedirs(torn)
    open(os.path.join(torn, "part-0.csv"), "w").close()
    assert quality.missing_exports(spark, {"a": done, "b": torn, "c": workdir + "/none.csv"}) == [torn, workdir + "/none.csv"]


def test_pointer_order_does_not_follow_the_clock(spark, workdir, monkeypatch):
    for n in range(1, 12):
        monkeypatch.setattr("time.time", lambda n=n: 1e9 - n)
        warehouse.write_table(spark, workdir, "t", spark.range(n))
    assert warehouse.read_table(spark, workdir, "t").count() == 11


def test_issue_counts_equal_issue_rows(spark, workdir):
    write_fixture(workdir)
    settings = default_settings(workdir)
    tables = pipeline.read_raw(spark, settings)
    tables["empty"] = tables["customers"].limit(0)
    rules = settings["contracts"] | {"empty": settings["contracts"]["customers"]}
    counted = {
        r["table_name"]: (r["raw_rows"], r["validation_issues"]) for r in contracts.issue_counts(tables, rules).collect()
    }
    listed = {
        r["table_name"]: r["n"]
        for r in contracts.validate_contracts(tables, rules).groupBy("table_name").agg(F.count("*").alias("n")).collect()
    }
    assert counted == {name: (df.count(), listed.get(name, 0)) for name, df in tables.items()}
    assert counted["empty"] == (0, 0) and counted["customers"][1] > 0
    # One pass over each table counts the same, and the rows that cleaning keeps.
    del tables["empty"]
    kept = clean.clean_tables(tables)
    flagged = {r["table_name"]: r for r in quality.flagged_counts(tables, rules).collect()}
    for name, r in flagged.items():
        assert (r["raw_rows"], r["validation_issues"]) == counted[name]
        assert r["clean_rows"] == kept[clean.SILVER_NAMES[name]].count()
    whole = quality.quality_summary(tables, {n: kept[clean.SILVER_NAMES[n]] for n in tables}, contracts.validate_contracts(tables, rules))
    order = lambda df: sorted(map(tuple, df.select(whole.columns).collect()))
    assert order(quality.quality_summary_from_flags(tables, rules)) == order(whole)


def test_flagged_counts_of_empty_tables_and_foreign_rules(spark, workdir):
    write_fixture(workdir)
    settings = default_settings(workdir)
    tables = {n: df.where("false") for n, df in pipeline.read_raw(spark, settings).items()}
    rows = quality.quality_summary_from_flags(tables, settings["contracts"]).collect()
    assert len(rows) == 5 and all(r["raw_rows"] == r["clean_rows"] == r["validation_issues"] == 0 and r["quality_score"] == 1 for r in rows)
    with pytest.raises(ValueError, match="unique key"):
        quality.flagged_counts(tables, {"customers": {"required_columns": [], "unique_key": "segment"}})


def _pointers(root, name):
    folder = os.path.join(root, name, "_pointers")
    return [json.load(open(os.path.join(folder, f))) for f in sorted(os.listdir(folder)) if f.endswith(".json")]


def test_parked_rows_are_added_not_rewritten(spark, workdir):
    schema = (
        "ticket_id string, customer_id string, opened_date string, "
        "_ingest_file string, _ingest_offset long, _ingest_row long"
    )
    for epoch in range(4):
        rows = [(f"T-{epoch}-{k}", f"C-{k}", "2025-01-01", "f", epoch, k) for k in range(5)]
        assert stream.process_batch(spark, workdir, "support_tickets", spark.createDataFrame(rows, schema)) == 0
    # Every batch adds a run of 5 rows, and leaves those before as they are.
    parked = [p["stream"]["parked"]["runs"] for p in _pointers(workdir, "fact_support_tickets")]
    assert [len(runs) for runs in parked] == [1, 2, 3, 4] and parked[-1][:3] == parked[-2]
    assert spark.read.parquet(*parked[-1]).count() == 20
    customers = spark.createDataFrame(
        [("C-1", "g", 0, 0), ("C-3", "g", 0, 1)], "customer_id string, _ingest_file string, _ingest_offset long, _ingest_row long"
    )
    stream.process_batch(spark, workdir, "customers", customers)
    assert stream.retry_orphans(spark, workdir, "support_tickets") == 8
    assert stream.retry_orphans(spark, workdir, "support_tickets") == 0
    assert warehouse.read_table(spark, workdir, "fact_support_tickets").count() == 8
    # Only those still waiting are left.
    (waiting,) = _pointers(workdir, "fact_support_tickets")[-1]["stream"]["parked"]["runs"]
    assert spark.read.parquet(waiting).count() == 12


def test_a_failed_export_leaves_the_one_before(spark, workdir):
    path = f"{workdir}/out/mart.csv"
    export.write_csv(spark.range(5).selectExpr("id"), path, bounded=True)
    bad = spark.range(20).select(F.when(F.col("id") == 13, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        export.write_csv(bad, path, bounded=False)
    assert spark.read.option("header", True).csv(path).count() == 5
    assert os.path.exists(f"{path}/_SUCCESS")
    export.write_csv(spark.range(7).selectExpr("id"), path, bounded=True)
    assert spark.read.option("header", True).csv(path).count() == 7
    # Nothing is left beside it.
    assert [f for f in os.listdir(f"{workdir}/out") if not f.endswith(".crc")] == ["mart.csv"]
