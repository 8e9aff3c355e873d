"""Quality scores, run totals and health checks over the pipeline outputs."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.coerce import round_half_away
from ledgerline.functions.order import column
from ledgerline.operators.clean import KEYS, first_order, with_parent_flag, with_validity
from ledgerline.operators.contracts import check_required_columns, row_rules
from ledgerline.sources.tables import path_exists

RAW_TABLES = ["customers", "subscriptions", "invoices", "product_events", "support_tickets"]


def _counts(tables: Mapping[str, DataFrame], name_of_count: str) -> DataFrame:
    """Row count per table in one job: tagged zero-column scans, unioned, counted."""
    parts = [df.select(F.lit(name).alias("table_name")) for name, df in tables.items()]
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part)
    return stacked.groupBy("table_name").agg(F.count(F.lit(1)).alias(name_of_count))


def quality_summary(
    raw: Mapping[str, DataFrame],
    clean: Mapping[str, DataFrame],
    issues: DataFrame,
) -> DataFrame:
    """Raw, clean, rejected and issue counts and a score per raw table.

    ``clean`` is keyed by the raw table names.  Score =
    ``round(max(0, 1 - issues / raw), 4)``; an empty table scores 1.
    """
    spark = issues.sparkSession
    names = spark.createDataFrame([(n, i) for i, n in enumerate(raw)], "table_name string, _pos int")
    counts = names.join(_counts(raw, "raw_rows"), "table_name", "left").join(
        _counts({n: clean[n] for n in raw}, "clean_rows"), "table_name", "left"
    )
    return _score(counts, _issue_counts(issues))


def flagged_counts(
    tables: Mapping[str, DataFrame], contracts: Mapping[str, Any], order: Mapping[str, list[str]] | None = None
) -> DataFrame:
    """Raw rows, rows that cleaning keeps and contract issues of every raw table, each read once.

    A pass flags every row (fired rules, foreign keys without a parent, valid for
    cleaning) and groups by the table's key: the copies after the first are
    repeats, and the table keeps the key if its first copy is valid.  Only the key,
    the order of the copies and the flags are shuffled, behind a map-side partial aggregate.
    """
    parts = []
    customers = tables["customers"].select("customer_id")
    for name in (n for n in RAW_TABLES if n in tables):
        df, contract, key = tables[name], contracts.get(name) or {}, KEYS[name]
        check_required_columns(name, df, contract)
        if contract.get("unique_key", key) != key:
            raise ValueError(f"table {name}: the contract's unique key is not the key that cleaning uses")
        rows = with_validity(name, df, customers)
        flags = [rule.isNotNull() for rule in row_rules(df, contract)]
        for k, (child, fk) in enumerate((contract.get("foreign_keys") or {}).items()):
            if name != "customers" and (child, fk["table"], fk["column"]) == ("customer_id", "customers", "customer_id"):
                flags.append(F.col("_missing"))
            else:
                rows = with_parent_flag(rows, f"_orphan_{k}", tables[fk["table"]], child, fk["column"])
                flags.append(F.col(f"_orphan_{k}"))
        fired = sum((f.cast("bigint") for f in flags), F.lit(0).cast("bigint"))
        one = F.count(F.lit(1))
        if name == "invoices":
            kept = F.sum(F.col("_valid").cast("bigint"))
        else:
            kept = F.min(F.struct(first_order(name, df, (order or {}).get(name)), "_valid"))["_valid"].cast("bigint")
        repeats = one - 1 if contract.get("unique_key") else F.lit(0)
        by_key = rows.groupBy(column(key).alias("_key")).agg(
            one.alias("_rows"), kept.alias("_kept"), (F.sum(fired) + repeats).alias("_issues")
        )
        total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
        parts.append(
            by_key.agg(total("_rows").alias("raw_rows"), total("_kept").alias("clean_rows"), total("_issues").alias("validation_issues"))
            .withColumn("table_name", F.lit(name))
        )
    return reduce(DataFrame.unionByName, parts)


def quality_summary_from_flags(
    tables: Mapping[str, DataFrame], contracts: Mapping[str, Any], order: Mapping[str, list[str]] | None = None
) -> DataFrame:
    """A6 with every table read once (``flagged_counts``)."""
    return _score_joined(flagged_counts(tables, contracts, order))


def quality_summary_from_issue_counts(counts: DataFrame, clean: Mapping[str, DataFrame]) -> DataFrame:
    """A6 from ``contracts.issue_counts``: no issue row is built; tables that ``clean`` lacks are left out."""
    clean_rows = _counts(clean, "clean_rows")
    names = counts.sparkSession.createDataFrame([(n,) for n in clean], "table_name string")
    return _score_joined(names.join(counts, "table_name", "left").join(clean_rows, "table_name", "left"))


def quality_summary_from_counts(
    spark: SparkSession,
    raw_rows: Mapping[str, int],
    clean_rows: Mapping[str, int],
    issues: DataFrame,
) -> DataFrame:
    """A6 from counts already known (observed during earlier writes): one row
    per table built from bounded scalars, so no table is scanned again."""
    rows = [(n, int(raw_rows[n]), int(clean_rows.get(n, 0))) for n in raw_rows]
    counts = spark.createDataFrame(rows, "table_name string, raw_rows bigint, clean_rows bigint")
    return _score(counts, _issue_counts(issues))


def _issue_counts(issues: DataFrame) -> DataFrame:
    return issues.groupBy("table_name").agg(F.count(F.lit(1)).alias("validation_issues"))


def _score(counts: DataFrame, issue_counts: DataFrame) -> DataFrame:
    return _score_joined(counts.join(issue_counts, "table_name", "left"))


def _score_joined(joined: DataFrame) -> DataFrame:
    raw_rows = F.coalesce(F.col("raw_rows"), F.lit(0)).cast("bigint")
    clean_rows = F.coalesce(F.col("clean_rows"), F.lit(0)).cast("bigint")
    n_issues = F.coalesce(F.col("validation_issues"), F.lit(0)).cast("bigint")
    rate = F.when(raw_rows > 0, n_issues / raw_rows).otherwise(F.lit(0.0))
    return joined.select(
        "table_name",
        raw_rows.alias("raw_rows"),
        clean_rows.alias("clean_rows"),
        (raw_rows - clean_rows).alias("rejected_rows"),
        n_issues.alias("validation_issues"),
        round_half_away(F.greatest(F.lit(0.0), F.lit(1.0) - rate), 4).alias("quality_score"),
    )


def overall_quality(summary: DataFrame) -> DataFrame:
    """Mean quality score over the tables."""
    return summary.agg(round_half_away(F.avg("quality_score"), 4).alias("average_quality_score"))


def run_summary(
    spark: SparkSession,
    mode: str,
    started_at: datetime,
    finished_at: datetime,
    rows_read: int,
    rows_cleaned: int,
    loaded_rows: int,
) -> DataFrame:
    """The one-row run record.  The counts are bounded scalars observed
    during the writes, so building the row costs no job."""
    row = (
        started_at.strftime("%Y%m%dT%H%M%S%fZ"),
        mode,
        started_at.isoformat(),
        finished_at.isoformat(),
        round((finished_at - started_at).total_seconds(), 3),
        int(rows_read),
        int(rows_cleaned),
        int(loaded_rows),
    )
    schema = (
        "run_id string, mode string, started_at_utc string, finished_at_utc string, "
        "duration_seconds double, rows_read bigint, rows_cleaned bigint, loaded_rows bigint"
    )
    return spark.createDataFrame([row], schema)


# ----------------------------------------------------------------------------
# Health checks
# ----------------------------------------------------------------------------


def missing_exports(spark: SparkSession, paths: Mapping[str, str]) -> list[str]:
    """H1: outputs without the marker of a finished write (any Hadoop file system)."""
    return [p for p in paths.values() if not path_exists(spark, f"{p}/_SUCCESS")]


def quality_failures(summary: DataFrame, threshold: float = 0.90) -> DataFrame:
    """H2: one failure row per table scoring under ``threshold``."""
    return summary.filter(F.col("quality_score") < F.lit(float(threshold))).select(
        "table_name",
        F.concat(F.col("table_name"), F.lit(" quality below threshold")).alias("failure"),
    )


def mrr_reconciliation(exported: DataFrame, stored: DataFrame) -> DataFrame:
    """H3: exported vs stored MRR totals, one row, exact in DECIMAL.

    ``reconciled`` is false only when both totals exist and differ (the
    reference skips the check when either side is missing).
    """
    total = T.DecimalType(38, 2)
    stacked = exported.select(F.lit("exported").alias("_side"), F.col("mrr").cast(total).alias("_mrr")).unionByName(
        stored.select(F.lit("stored").alias("_side"), F.col("mrr").cast(total).alias("_mrr"))
    )
    totals = stacked.agg(
        F.round(F.sum(F.when(F.col("_side") == "exported", F.col("_mrr"))), 2).cast(total).alias("exported_mrr"),
        F.round(F.sum(F.when(F.col("_side") == "stored", F.col("_mrr"))), 2).cast(total).alias("stored_mrr"),
    )
    agree = (
        F.col("exported_mrr").isNull() | F.col("stored_mrr").isNull() | (F.col("exported_mrr") == F.col("stored_mrr"))
    )
    return totals.select("exported_mrr", "stored_mrr", agree.alias("reconciled"))


def assert_healthy(failures: list[str]) -> None:
    if failures:
        raise RuntimeError("Health checks failed:\n- " + "\n- ".join(failures))
