"""Pipeline settings and the default data contracts of the five sources."""

from __future__ import annotations

from typing import Any

# The data contracts of the five raw sources (required
# columns, unique key, id pattern, date bounds, numeric minimum, allowed
# values and foreign keys).
DEFAULT_CONTRACTS: dict[str, Any] = {
    "customers": {
        "required_columns": ["customer_id", "customer_name", "segment", "country", "signup_date"],
        "unique_key": "customer_id",
        "id_pattern": r"^C-\d{4}$",
        "date_columns": {"signup_date": {"min": "2024-01-01", "max": "2025-12-31"}},
        "allowed_values": {"segment": ["Startup", "SMB", "Mid-Market", "Enterprise"]},
    },
    "subscriptions": {
        "required_columns": ["subscription_id", "customer_id", "plan", "start_date", "end_date", "status", "mrr"],
        "unique_key": "subscription_id",
        "id_pattern": r"^S-\d{5}$",
        "date_columns": {"start_date": {"min": "2024-01-01", "max": "2025-12-31"}},
        "numeric_ranges": {"mrr": {"min": 0, "inclusive_min": False}},
        "allowed_values": {"plan": ["Starter", "Growth", "Scale"], "status": ["trial", "active", "cancelled"]},
        "foreign_keys": {"customer_id": {"table": "customers", "column": "customer_id"}},
    },
    "invoices": {
        "required_columns": ["invoice_id", "customer_id", "invoice_month", "amount", "status"],
        "unique_key": "invoice_id",
        "id_pattern": r"^I-\d{6}$",
        "date_columns": {"invoice_month": {"min": "2025-01-01", "max": "2025-12-31"}},
        "numeric_ranges": {"amount": {"min": 0, "inclusive_min": False}},
        "allowed_values": {"status": ["paid", "failed", "refunded"]},
        "foreign_keys": {"customer_id": {"table": "customers", "column": "customer_id"}},
    },
    "product_events": {
        "required_columns": ["event_id", "customer_id", "user_id", "event_time", "feature", "event_type"],
        "unique_key": "event_id",
        "id_pattern": r"^E-\d{7}$",
        "date_columns": {"event_time": {"min": "2025-01-01", "max": "2025-12-31"}},
        "allowed_values": {
            "feature": ["Dashboard", "Reports", "Automation", "Integrations", "Billing"],
            "event_type": ["view", "click", "export", "create"],
        },
        "foreign_keys": {"customer_id": {"table": "customers", "column": "customer_id"}},
    },
    "support_tickets": {
        "required_columns": ["ticket_id", "customer_id", "opened_date", "priority", "status", "category"],
        "unique_key": "ticket_id",
        "id_pattern": r"^T-\d{5}$",
        "date_columns": {"opened_date": {"min": "2025-01-01", "max": "2025-12-31"}},
        "allowed_values": {
            "priority": ["low", "medium", "high"],
            "status": ["open", "solved"],
            "category": ["billing", "bug", "onboarding", "feature_request"],
        },
        "foreign_keys": {"customer_id": {"table": "customers", "column": "customer_id"}},
    },
}

# The minimum quality score a table must reach.
MINIMUM_QUALITY_SCORE = 0.90

RAW_FILES = {
    "customers": "raw/customers.csv",
    "subscriptions": "raw/subscriptions.csv",
    "invoices": "raw/invoices.csv",
    "product_events": "raw/product_events.jsonl",
    "support_tickets": "raw/support_tickets.csv",
}

EXPORTS = [
    "executive_overview",
    "mart_mrr",
    "mart_churn",
    "mart_feature_adoption",
    "mart_customer_health",
    "data_quality_issues",
    "data_quality_summary",
    "pipeline_run_summary",
]


def default_settings(base: str) -> dict[str, Any]:
    """Settings for a project rooted at ``base`` (any Hadoop file system URI)."""
    base = base.rstrip("/")
    return {
        "raw_files": {name: f"{base}/{rel}" for name, rel in RAW_FILES.items()},
        "warehouse": f"{base}/warehouse",
        "exports": f"{base}/exports",
        "parquet_layers": f"{base}/parquet",
        "readers": {},
        "contracts": DEFAULT_CONTRACTS,
        "quality": {"minimum_quality_score": MINIMUM_QUALITY_SCORE},
        "health": {},
    }


def export_paths(settings: dict[str, Any]) -> dict[str, str]:
    root = settings["exports"].rstrip("/")
    return {name: f"{root}/{name}.csv" for name in EXPORTS}
