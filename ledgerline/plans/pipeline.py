"""End-to-end entry points: run the pipeline, validate, re-export, check health.

Stages and their jobs (everything between them stays lazy):

1. read raw files (bronze, all strings) and check required columns (no job);
   bronze is staged once as Parquet under the checkpoint folder with its
   ingest-order columns, raw row counts observed during that write.  Text
   is parsed exactly once; every later stage reads the columnar copy and
   only the columns it needs;
2. validate contracts -> issue log written to the exports;
3. clean -> silver tables; a full load writes them straight into new
   warehouse versions, an incremental one stages them as Parquet under the
   checkpoint folder first; row counts are observed during those writes;
4. incremental: append the staged rows whose key is not stored yet; then a
   plain Parquet copy of every table (``parquet_layers``; none when null);
5. marts rebuilt from the stored silver tables and stored; the overview is
   built from the stored marts, as the reference builds it last;
6. marts exported as sorted CSV, then the quality summary and run summary.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators import clean, contracts, marts, quality
from ledgerline.plans.settings import export_paths
from ledgerline.session import scratch_path
from ledgerline.sources import export, ingest, warehouse

SILVER = list(warehouse.PRIMARY_KEYS)


def _count_rows(df: DataFrame, path: str) -> int:
    obs = Observation(f"rows_{uuid.uuid4().hex}")
    df.observe(obs, F.count(F.lit(1)).alias("rows")).write.parquet(path)
    return int(obs.get.get("rows", 0) or 0)


def stage_bronze(
    spark: SparkSession, raw: dict[str, DataFrame], stage: str
) -> tuple[dict[str, DataFrame], dict[str, int]]:
    """Write every raw table once as Parquet (ingest-order columns included)
    and read it back; the row counts are observed during the writes.

    The staged copy also fixes the ingest order for good: a task retried
    after a lost executor reads the same ``_ingest_row`` values."""
    counts = {name: _count_rows(df, f"{stage}/{name}") for name, df in raw.items()}
    staged = {
        name: spark.read.parquet(f"{stage}/{name}").select(*[F.col(f"`{c}`") for c in df.columns])
        for name, df in raw.items()
    }
    return staged, counts


def read_raw(spark: SparkSession, settings: dict[str, Any]) -> dict[str, DataFrame]:
    return ingest.read_raw_tables(spark, settings["raw_files"], settings["contracts"], settings.get("readers"))


def validate(spark: SparkSession, settings: dict[str, Any]) -> tuple[DataFrame, list[tuple[str, str, int]]]:
    """The issue log (lazy) and its breakdown (bounded, collected)."""
    raw, _ = stage_bronze(spark, read_raw(spark, settings), scratch_path(spark, "validate"))
    issues = contracts.validate_contracts(raw, settings["contracts"])
    breakdown = [(r["table_name"], r["issue_type"], int(r["issue_count"])) for r in contracts.issue_breakdown(issues).collect()]
    return issues, breakdown


def _build_and_store_marts(spark: SparkSession, root: str, health_params: dict[str, Any]) -> dict[str, DataFrame]:
    stored = {name: warehouse.read_table(spark, root, name) for name in SILVER}
    built = {
        "mart_mrr": marts.mart_mrr(stored["fact_invoices"]),
        "mart_churn": marts.mart_churn(stored["fact_subscriptions"]),
        "mart_feature_adoption": marts.mart_feature_adoption(stored["fact_product_events"]),
        "mart_customer_health": marts.customer_health(
            stored["dim_customers"],
            stored["fact_invoices"],
            stored["fact_product_events"],
            stored["fact_support_tickets"],
            **health_params,
        ),
    }
    for name, df in built.items():
        warehouse.write_table(spark, root, name, df)
    out = {name: warehouse.read_table(spark, root, name) for name in built}
    overview = marts.executive_overview(
        out["mart_mrr"],
        out["mart_churn"],
        out["mart_customer_health"],
        stored["fact_subscriptions"],
        stored["fact_product_events"],
    )
    warehouse.write_table(spark, root, "executive_overview", overview)
    out["executive_overview"] = warehouse.read_table(spark, root, "executive_overview")
    return out


def export_existing_marts(spark: SparkSession, settings: dict[str, Any]) -> dict[str, str]:
    """Rebuild the marts from the stored silver tables and export them."""
    stored = _build_and_store_marts(spark, settings["warehouse"], settings.get("health", {}))
    return export.export_marts(stored, settings["exports"])


def run_pipeline(spark: SparkSession, settings: dict[str, Any], mode: str = "full") -> dict[str, Any]:
    """Read -> validate -> clean -> load -> marts -> exports -> quality -> run summary."""
    if mode not in {"full", "incremental"}:
        raise ValueError("mode must be 'full' or 'incremental'")
    started = datetime.now(timezone.utc)
    raw, raw_counts = stage_bronze(spark, read_raw(spark, settings), scratch_path(spark, "bronze"))
    issues = contracts.validate_contracts(raw, settings["contracts"])
    exports_root = settings["exports"]
    issues_path = export.write_issues(issues, exports_root)
    issues_written = spark.read.options(**export.CSV_OPTIONS).csv(issues_path)

    silver = clean.clean_tables(raw, settings["contracts"])
    if mode == "full":
        # Silver goes straight into new warehouse versions; the clean counts
        # are observed on those writes, so silver is written once.
        loaded = warehouse.load(spark, silver, settings["warehouse"], mode)
        clean_counts = dict(loaded)
    else:
        # Staged once: the staging writes count every silver row, and the
        # anti join against the stored keys then reads the staged copy.
        stage = scratch_path(spark, "silver")
        clean_counts = {name: _count_rows(df, f"{stage}/{name}") for name, df in silver.items()}
        staged = {name: spark.read.parquet(f"{stage}/{name}") for name in silver}
        loaded = warehouse.load(spark, staged, settings["warehouse"], mode)
    if settings.get("parquet_layers"):
        warehouse.write_parquet_layers(spark, settings["warehouse"], settings["parquet_layers"])
    stored_marts = _build_and_store_marts(spark, settings["warehouse"], settings.get("health", {}))
    paths = export.export_marts(stored_marts, exports_root)

    summary = quality.quality_summary_from_counts(
        spark,
        {n: raw_counts[n] for n in clean.SILVER_NAMES},
        {raw_name: clean_counts[silver_name] for raw_name, silver_name in clean.SILVER_NAMES.items()},
        issues_written,
    )
    paths["data_quality_issues"] = issues_path
    paths["data_quality_summary"] = export.write_quality_summary(summary, exports_root)

    finished = datetime.now(timezone.utc)
    run = quality.run_summary(
        spark,
        mode,
        started,
        finished,
        rows_read=sum(raw_counts.values()),
        rows_cleaned=sum(clean_counts.values()),
        loaded_rows=sum(loaded.values()),
    )
    paths["pipeline_run_summary"] = export.write_run_summary(run, exports_root)
    return {
        "warehouse": settings["warehouse"],
        "exports": exports_root,
        "paths": paths,
        "raw_counts": raw_counts,
        "clean_counts": clean_counts,
        "loaded": loaded,
    }


def verify(spark: SparkSession, settings: dict[str, Any]) -> list[str]:
    """H4: missing exports, tables under the quality threshold, MRR mismatch."""
    paths = export_paths(settings)
    missing = quality.missing_exports(spark, paths)
    failures = [f"Missing export: {p}" for p in missing]
    summary_path = paths["data_quality_summary"]
    if summary_path not in missing:
        summary = spark.read.option("header", True).csv(summary_path)
        summary = summary.withColumn("quality_score", F.col("quality_score").cast("double"))
        threshold = settings["quality"]["minimum_quality_score"]
        failures += [r["failure"] for r in quality.quality_failures(summary, threshold).orderBy("table_name").collect()]
    root = settings["warehouse"]
    if paths["mart_mrr"] not in missing and warehouse.table_exists(spark, root, "mart_mrr"):
        exported = spark.read.option("header", True).csv(paths["mart_mrr"])
        row = quality.mrr_reconciliation(exported, warehouse.read_table(spark, root, "mart_mrr")).first()
        if row is not None and not row["reconciled"]:
            failures.append("Exported MRR does not match stored mart_mrr")
    return failures


def health_check(spark: SparkSession, settings: dict[str, Any]) -> None:
    """Raise ``RuntimeError`` listing every failure."""
    quality.assert_healthy(verify(spark, settings))


def ensure_outputs(spark: SparkSession, settings: dict[str, Any]) -> bool:
    """H5: if every export exists, check health and return False; otherwise
    rebuild everything from the raw files, check health and return True."""
    if not quality.missing_exports(spark, export_paths(settings)):
        health_check(spark, settings)
        return False
    run_pipeline(spark, settings, mode="full")
    health_check(spark, settings)
    return True
