"""Sinks: mart CSV exports, quality outputs and the run-summary history.

Marts are written sorted, as the reference exports them.  Bounded marts
(one row per month, or a single row) go to one file; the others grow with the
data and are written by all tasks after a range-partitioned sort.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.order import column as named
from ledgerline.sources.tables import _fs_path as fs_path

# Sort order of each export (ties broken by the key for a stable file).
EXPORT_ORDER = {
    "mart_mrr": [("invoice_month", "asc")],
    "mart_churn": [("churn_month", "asc")],
    "mart_feature_adoption": [("active_users", "desc"), ("feature", "asc")],
    "mart_customer_health": [("health_score", "desc"), ("customer_id", "asc")],
}

# How every CSV is written: quotes inside quoted fields doubled, blanks around values kept.
CSV_OPTIONS = {
    "header": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}

# Outputs whose size does not grow with the data (features are free text, so
# feature adoption may).
BOUNDED = {"executive_overview", "mart_mrr", "mart_churn", "data_quality_summary"}


def _sort_key(column: str, direction: str):
    """Nulls last in both directions, like the reference's SQL engine."""
    return named(column).desc_nulls_last() if direction == "desc" else named(column).asc_nulls_last()


def export_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}.csv"


def write_csv(df: DataFrame, path: str, bounded: bool, mode: str = "overwrite") -> str:
    """Write ``df`` as CSV files in the folder ``path``; a failed write leaves what stands there as it was.

    To replace a folder, the new one is written beside it under a hidden name and then takes its place by two renames.
    """
    out = df.coalesce(1) if bounded else df
    if mode != "overwrite":
        out.write.mode(mode).options(**CSV_OPTIONS).csv(path)
        return path
    folder, name = path.rstrip("/").rsplit("/", 1)
    mark = uuid.uuid4().hex
    new, old = f"{folder}/.{name}.{mark}.new", f"{folder}/.{name}.{mark}.old"
    spark = df.sparkSession
    fs, target = fs_path(spark, path)
    staged, before = fs_path(spark, new)[1], fs_path(spark, old)[1]
    try:
        out.write.options(**CSV_OPTIONS).csv(new)
        there = fs.exists(target)
        if there and not fs.rename(target, before):
            raise OSError(f"could not replace {path}")
        if not fs.rename(staged, target):
            if there:
                fs.rename(before, target)
            raise OSError(f"could not publish {path}")
        fs.delete(before, True)
    finally:
        fs.delete(staged, True)
    return path


def export_marts(marts: Mapping[str, DataFrame], root: str) -> dict[str, str]:
    """Write every mart as CSV with a header, sorted; returns the paths."""
    paths = {}
    for name, df in marts.items():
        order = EXPORT_ORDER.get(name)
        out = df.orderBy(*[_sort_key(c, d) for c, d in order]) if order else df
        paths[name] = write_csv(out, export_path(root, name), name in BOUNDED)
    return paths


def read_export(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read an exported CSV back with the mart's schema."""
    return spark.read.options(**CSV_OPTIONS).schema(schema).csv(path)


def write_issues(issues: DataFrame, root: str) -> str:
    """The issue log (not bounded, written by all tasks)."""
    return write_csv(issues, export_path(root, "data_quality_issues"), bounded=False)


def write_quality_summary(summary: DataFrame, root: str) -> str:
    """The per-table quality summary (one row per table)."""
    return write_csv(summary.orderBy("table_name"), export_path(root, "data_quality_summary"), bounded=True)


def write_run_summary(summary: DataFrame, root: str) -> str:
    """The one-row run summary, appended to a history (the reference overwrites)."""
    return write_csv(summary, export_path(root, "pipeline_run_summary"), bounded=True, mode="append")
