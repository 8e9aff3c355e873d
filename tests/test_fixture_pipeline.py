"""End-to-end on the hand fixture: exact expected issues, counts and marts."""

from __future__ import annotations

import os
from decimal import Decimal

import pytest

from ledgerline.operators import billing, marts
from ledgerline.plans import pipeline
from ledgerline.plans.settings import default_settings, export_paths
from ledgerline.sources import warehouse
from tests import brute_force
from tests.fixture_data import write_fixture

EXPECTED_ISSUES = sorted(
    [
        ("customers", "invalid_id_format", "X-1"),
        ("customers", "duplicate_key", "C-0002"),
        ("customers", "invalid_date", "X-1"),
        ("customers", "date_above_max", "C-0003"),
        ("customers", "invalid_allowed_value", "X-1"),
        ("subscriptions", "duplicate_key", "S-00003"),
        ("subscriptions", "invalid_numeric", "S-00006"),
        ("subscriptions", "numeric_below_min", "S-00003"),
        ("subscriptions", "missing_foreign_key", "S-00004"),
        ("invoices", "duplicate_key", "I-000003"),
        ("product_events", "duplicate_key", "E-0000003"),
        ("product_events", "missing_foreign_key", "E-0000004"),
    ]
)


@pytest.fixture(scope="module")
def project(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("fixture-project"))
    write_fixture(base)
    settings = default_settings(base)
    result = pipeline.run_pipeline(spark, settings, mode="full")
    return settings, result


def _csv(spark, path):
    return spark.read.option("header", True).csv(path)


def test_issues_match_fixture(spark, project):
    settings, _ = project
    issues = _csv(spark, export_paths(settings)["data_quality_issues"]).collect()
    got = sorted((r["table_name"], r["issue_type"], r["row_reference"]) for r in issues)
    assert got == EXPECTED_ISSUES


def test_validate_breakdown(spark, project):
    settings, _ = project
    _, breakdown = pipeline.validate(spark, settings)
    assert sum(n for _, _, n in breakdown) == 12
    assert ("subscriptions", "duplicate_key", 1) in breakdown
    assert breakdown == sorted(breakdown)


def test_clean_counts_and_run_totals(spark, project):
    settings, result = project
    assert result["clean_counts"] == {
        "dim_customers": 4,
        "dim_plans": 3,
        "fact_subscriptions": 3,
        "fact_invoices": 6,
        "fact_product_events": 3,
        "fact_support_tickets": 2,
    }
    assert sum(result["raw_counts"].values()) == 25
    assert sum(result["loaded"].values()) == 21
    subs = warehouse.read_table(spark, settings["warehouse"], "fact_subscriptions")
    assert sorted(r["subscription_id"] for r in subs.collect()) == ["S-00001", "S-00002", "S-00005"]


def test_quality_summary(spark, project):
    settings, _ = project
    rows = _csv(spark, export_paths(settings)["data_quality_summary"]).collect()
    got = {
        r["table_name"]: (
            int(r["raw_rows"]),
            int(r["clean_rows"]),
            int(r["rejected_rows"]),
            int(r["validation_issues"]),
            float(r["quality_score"]),
        )
        for r in rows
    }
    assert got == {
        "customers": (5, 4, 1, 5, 0.0),
        "subscriptions": (7, 3, 4, 4, 0.4286),
        "invoices": (6, 6, 0, 1, 0.8333),
        "product_events": (5, 3, 2, 2, 0.6),
        "support_tickets": (2, 2, 0, 0, 1.0),
    }


def test_marts(spark, project):
    settings, _ = project
    root = settings["warehouse"]
    mrr = {str(r["invoice_month"]): r for r in warehouse.read_table(spark, root, "mart_mrr").collect()}
    assert mrr["2025-01-01"]["mrr"] == Decimal("448.00")
    assert mrr["2025-01-01"]["paying_customers"] == 3
    assert mrr["2025-01-01"]["arpa"] == 149.33
    assert mrr["2025-02-01"]["mrr"] == Decimal("0.00")
    assert mrr["2025-02-01"]["paying_customers"] == 2
    assert mrr["2025-02-01"]["arpa"] == 0.0

    churn = warehouse.read_table(spark, root, "mart_churn").collect()
    assert [(str(r["churn_month"]), r["churned_customers"], r["churned_mrr"]) for r in churn] == [
        ("2025-03-01", 1, Decimal("399.00"))
    ]

    adoption = {r["feature"]: tuple(r)[1:] for r in warehouse.read_table(spark, root, "mart_feature_adoption").collect()}
    assert adoption == {"Dashboard": (2, 2, 2), "Reports": (1, 1, 1)}

    health = {r["customer_id"]: r for r in warehouse.read_table(spark, root, "mart_customer_health").collect()}
    assert (health["C-0001"]["revenue"], health["C-0001"]["health_score"]) == (Decimal("49.00"), -2.71)
    assert (health["C-0002"]["revenue"], health["C-0002"]["health_score"]) == (Decimal("399.00"), 4.39)
    assert health["C-0003"]["health_score"] == 0.0 and health["X-1"]["health_score"] == 0.0

    overview = warehouse.read_table(spark, root, "executive_overview").collect()
    assert len(overview) == 1
    o = overview[0]
    assert (o["annual_recurring_revenue"], o["active_customers"], o["trial_customers"]) == (Decimal("448.00"), 1, 1)
    assert (o["churned_customers"], o["active_users"], o["average_health_score"]) == (1, 3, 0.42)


def test_paid_only_payers_and_parity(spark, project):
    settings, _ = project
    root = settings["warehouse"]
    inv = warehouse.read_table(spark, root, "fact_invoices")
    paid = {str(r["invoice_month"]): r for r in marts.mart_mrr(inv, paid_only_payers=True).collect()}
    assert (paid["2025-01-01"]["paying_customers"], paid["2025-01-01"]["arpa"]) == (2, 224.0)
    assert (paid["2025-02-01"]["paying_customers"], paid["2025-02-01"]["arpa"]) == (0, None)

    tables = {n: warehouse.read_table(spark, root, n) for n in pipeline.SILVER}
    args = (tables["dim_customers"], inv, tables["fact_product_events"], tables["fact_support_tickets"])
    closed = {r["customer_id"]: (r["revenue"], r["health_score"]) for r in marts.customer_health(*args, fan_out=True).collect()}
    literal = {r["customer_id"]: (r["revenue"], r["health_score"]) for r in brute_force.customer_health_literal(*args).collect()}
    assert closed == literal
    assert closed["C-0001"] == (Decimal("196.00"), -1.24)
    assert closed["C-0002"] == (Decimal("399.00"), 4.39)
    overview = marts.executive_overview(
        marts.mart_mrr(inv),
        marts.mart_churn(tables["fact_subscriptions"]),
        marts.customer_health(*args, fan_out=True),
        tables["fact_subscriptions"],
        tables["fact_product_events"],
    ).first()
    assert overview["average_health_score"] == 0.79


def test_billing_schedule(spark, project):
    settings, _ = project
    subs = warehouse.read_table(spark, settings["warehouse"], "fact_subscriptions")
    rows = billing.billing_schedule(subs, "2025-12-01").collect()
    per_sub = {}
    for r in rows:
        per_sub[r["subscription_id"]] = per_sub.get(r["subscription_id"], 0) + 1
    assert per_sub == {"S-00001": 12, "S-00002": 3, "S-00005": 9}


def test_exports_and_health(spark, project):
    settings, _ = project
    for path in export_paths(settings).values():
        assert os.path.exists(path), path
    failures = pipeline.verify(spark, settings)
    assert failures == [
        "customers quality below threshold",
        "invoices quality below threshold",
        "product_events quality below threshold",
        "subscriptions quality below threshold",
    ]
    with pytest.raises(RuntimeError, match="Health checks failed"):
        pipeline.health_check(spark, settings)


def test_incremental_rerun_loads_nothing(spark, project):
    settings, _ = project
    before = warehouse.read_table(spark, settings["warehouse"], "fact_invoices").count()
    again = pipeline.run_pipeline(spark, settings, mode="incremental")
    assert sum(again["loaded"].values()) == 0
    assert warehouse.read_table(spark, settings["warehouse"], "fact_invoices").count() == before
    runs = _csv(spark, export_paths(settings)["pipeline_run_summary"]).collect()
    assert sorted(r["mode"] for r in runs) == ["full", "incremental"]


def test_bad_mode_rejected(spark, project):
    settings, _ = project
    with pytest.raises(ValueError, match="mode must be"):
        pipeline.run_pipeline(spark, settings, mode="weekly")


def test_export_existing_and_ensure_outputs(spark, project, tmp_path):
    settings, _ = project
    paths = pipeline.export_existing_marts(spark, settings)
    assert set(paths) == {
        "executive_overview",
        "mart_mrr",
        "mart_churn",
        "mart_feature_adoption",
        "mart_customer_health",
    }
    # Fresh project without outputs: ensure_outputs rebuilds, then the
    # health check fails on the fixture's planted quality problems.
    base = str(tmp_path / "fresh")
    write_fixture(base)
    fresh = default_settings(base)
    with pytest.raises(RuntimeError, match="quality below threshold"):
        pipeline.ensure_outputs(spark, fresh)
    assert not [p for p in export_paths(fresh).values() if not os.path.exists(p)]
    loose = dict(fresh, quality={"minimum_quality_score": 0.0})
    assert pipeline.ensure_outputs(spark, loose) is False


def test_missing_required_column(spark, tmp_path):
    base = str(tmp_path / "broken")
    write_fixture(base)
    path = os.path.join(base, "raw", "support_tickets.csv")
    with open(path, encoding="utf-8") as fh:
        lines = [",".join(line.rstrip("\n").split(",")[:-1]) for line in fh]
    with open(path, "w", encoding="utf-8") as fh:
        fh.write("\n".join(lines) + "\n")
    with pytest.raises(ValueError, match="support_tickets missing required columns: category"):
        pipeline.validate(spark, default_settings(base))
