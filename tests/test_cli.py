"""The spark-submit entry point drives the same functions as the library."""

from __future__ import annotations

import os

import pytest

from ledgerline import cli
from ledgerline.sources import warehouse
from tests.fixture_data import write_fixture


def test_cli_commands(spark, workdir, capsys):
    base = os.path.join(workdir, "project")
    write_fixture(base)
    cli.main(["--base", base, "validate-contracts"])
    out = capsys.readouterr().out
    assert "Contract issues found: 12" in out
    assert "subscriptions\tmissing_foreign_key\t1" in out

    cli.main(["--base", base, "run-pipeline", "--mode", "full"])
    assert "Warehouse:" in capsys.readouterr().out

    cli.main(["--base", base, "export-marts"])
    assert "- mart_customer_health" in capsys.readouterr().out

    with pytest.raises(RuntimeError, match="quality below threshold"):
        cli.main(["--base", base, "health-check"])

    layers = warehouse.write_parquet_layers(spark, os.path.join(base, "warehouse"), os.path.join(base, "parquet"))
    assert set(layers) == set(warehouse.PRIMARY_KEYS)
    assert spark.read.parquet(layers["dim_plans"]).count() == 3


def test_cli_stream_load(spark, workdir, capsys):
    from tests.fixture_data import CUSTOMERS, SUBSCRIPTIONS, write_lines

    base = os.path.join(workdir, "streamed")
    write_lines(os.path.join(base, "landing", "customers", "part-0001.csv"), CUSTOMERS)
    write_lines(os.path.join(base, "landing", "subscriptions", "part-0001.csv"), SUBSCRIPTIONS)
    os.makedirs(os.path.join(base, "landing", "invoices"))
    os.makedirs(os.path.join(base, "landing", "product_events.jsonl"))
    os.makedirs(os.path.join(base, "landing", "support_tickets"))
    cli.main(["--base", base, "stream-load"])
    out = capsys.readouterr().out
    assert "dim_customers\t4" in out and "fact_subscriptions\t3" in out
