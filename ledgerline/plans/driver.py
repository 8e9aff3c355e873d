"""Every operator as a query over the driver's tables.

Each function takes ``(spark, sf_dir)`` and returns a lazy DataFrame.  The
five source tables come from ``ledgerline.sources.driver_views``; silver
tables are the cleaning operators applied to them, exactly as the pipeline
does.  ``ledgerline.plans.oracle`` holds the matching DuckDB SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.functions.coerce import MONEY
from ledgerline.operators import billing, clean, contracts, marts, quality, reports
from ledgerline.session import scratch_path
from ledgerline.sources import driver_views as views
from ledgerline.sources import export, ingest, warehouse
from ledgerline.streaming import adoption as stream_adoption
from ledgerline.streaming import load as stream_loading

# Parameters of the driver queries.  Revenue on these tables is large, so the
# health score divides it by 20000 instead of 100 (with 100 nearly every
# customer sits at the cap).
HEALTH = {"revenue_divisor": 20000}
HORIZON = "2001-12-01"
TOP_SEGMENTS = ["BUILDING", "MACHINERY"]
TOP_N = 25
QUALITY_THRESHOLD = 0.90
STORED_BEFORE = "1998-01-01"  # incremental test: orders before this date are already stored
INVALID_DATE_TEXT = "renewal_text"
RSD = 0.05  # stated error of the sketches

DRIVER_CONTRACTS = {
    "customers": {
        "required_columns": ["customer_id", "customer_name", "segment", "country"],
        "unique_key": "customer_id",
        "id_pattern": r"^\d{1,3}$",
        "numeric_ranges": {"acctbal": {"min": 0, "inclusive_min": False}},
        "allowed_values": {"segment": ["Automobile", "BUILDING", "furniture", "Machinery"]},
    },
    "subscriptions": {
        "required_columns": ["subscription_id", "customer_id", "plan", "start_date", "end_date", "status", "mrr"],
        "unique_key": "subscription_id",
        "date_columns": {"start_date": {"min": "1996-01-01", "max": "2000-12-31"}},
        "numeric_ranges": {"mrr": {"min": 0, "inclusive_min": False}},
        "allowed_values": {"status": ["trial", "active", "cancelled"]},
        "foreign_keys": {"customer_id": {"table": "customers", "column": "customer_id"}},
    },
    "invoices": {
        "required_columns": ["invoice_id", "customer_id", "invoice_month", "amount", "status"],
        "unique_key": "invoice_id",
        "date_columns": {"invoice_month": {"min": "1995-01-01", "max": "2001-06-30"}},
        "numeric_ranges": {"amount": {"min": 0, "inclusive_min": False}},
        "allowed_values": {"status": ["PAID", "Failed"]},
        "foreign_keys": {"customer_id": {"table": "customers", "column": "customer_id"}},
    },
    "product_events": {
        "required_columns": ["event_id", "customer_id", "user_id", "event_time", "feature", "event_type"],
        "unique_key": "event_id",
        "date_columns": {"event_time": {"min": "2024-01-02", "max": "2024-01-29"}},
        "allowed_values": {"event_type": ["view", "click", "purchase"], "feature": ["F0", "F1", "F2", "F3"]},
        "foreign_keys": {"user_id": {"table": "suppliers", "column": "s_suppkey"}},
    },
    "support_tickets": {
        "required_columns": ["ticket_id", "customer_id", "opened_date"],
        "unique_key": "ticket_id",
        "date_columns": {"opened_date": {"min": "2024-01-01", "max": "2024-01-31"}},
        "foreign_keys": {"customer_id": {"table": "customers", "column": "customer_id"}},
    },
}


# ----------------------------------------------------------------------------
# shared building blocks
# ----------------------------------------------------------------------------


def raw(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return views.raw_tables(spark, sf)


def suppliers(spark: SparkSession, sf: str) -> DataFrame:
    return views.table(spark, sf, "supplier")


def validation_tables(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    tables = raw(spark, sf)
    tables["suppliers"] = suppliers(spark, sf)
    return tables


def silver(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Silver tables keyed by raw table name."""
    return cleaned(raw(spark, sf))


def cleaned(r: dict[str, DataFrame]) -> dict[str, DataFrame]:
    keys = r["customers"].select("customer_id")  # same key set as the deduplicated customers
    return {
        "customers": clean.clean_customers(r["customers"]),
        "subscriptions": clean.clean_subscriptions(r["subscriptions"], keys),
        "invoices": clean.clean_invoices(r["invoices"], keys),
        "product_events": clean.clean_events(r["product_events"], keys),
        "support_tickets": clean.clean_tickets(r["support_tickets"], keys),
    }


def _health(s: dict[str, DataFrame], fan_out: bool = False) -> DataFrame:
    return marts.customer_health(
        s["customers"], s["invoices"], s["product_events"], s["support_tickets"], fan_out=fan_out, **HEALTH
    )


def _issues(spark: SparkSession, sf: str) -> DataFrame:
    return contracts.validate_contracts(validation_tables(spark, sf), DRIVER_CONTRACTS)


def _summary(spark: SparkSession, sf: str) -> DataFrame:
    return quality.quality_summary_from_flags(validation_tables(spark, sf), DRIVER_CONTRACTS)


# ----------------------------------------------------------------------------
# queries
# ----------------------------------------------------------------------------


def q_mart_mrr(spark, sf):
    return marts.mart_mrr(silver(spark, sf)["invoices"])


def q_mart_mrr_paid(spark, sf):
    return marts.mart_mrr(silver(spark, sf)["invoices"], paid_only_payers=True)


def q_mart_churn(spark, sf):
    return marts.mart_churn(silver(spark, sf)["subscriptions"])


def q_mart_feature_adoption(spark, sf):
    return marts.mart_feature_adoption(silver(spark, sf)["product_events"])


def _near(estimate: str, exact: str):
    """Whether a sketch's estimate is within three times its stated error of the exact count."""
    return F.abs(F.col(estimate) - F.col(exact)) <= 3 * RSD * F.col(exact)


def q_feature_adoption_approx(spark, sf):
    """A3b beside A3: exact counts, and whether each estimate keeps its error bound."""
    events = silver(spark, sf)["product_events"]
    estimates = marts.mart_feature_adoption(events, approx=True, rsd=RSD).select(
        F.col("feature").alias("f"), F.col("events").alias("e"), F.col("active_users").alias("u"),
        F.col("active_customers").alias("c"),
    )
    exact = marts.mart_feature_adoption(events)
    return exact.join(estimates, exact["feature"].eqNullSafe(estimates["f"]) & (F.col("e") == F.col("events"))).select(
        "feature",
        "events",
        "active_users",
        "active_customers",
        _near("u", "active_users").alias("users_near"),
        _near("c", "active_customers").alias("customers_near"),
    )


def q_customer_health(spark, sf):
    return _health(silver(spark, sf))


def q_customer_health_parity(spark, sf):
    return _health(silver(spark, sf), fan_out=True)


def q_executive_overview(spark, sf):
    s = silver(spark, sf)
    return marts.executive_overview(
        marts.mart_mrr(s["invoices"]),
        marts.mart_churn(s["subscriptions"]),
        _health(s),
        s["subscriptions"],
        s["product_events"],
    )


def q_health_top25(spark, sf):
    return reports.top_customers(_health(silver(spark, sf)), TOP_SEGMENTS, TOP_N)


def q_health_segments(spark, sf):
    return reports.segments(_health(silver(spark, sf)))


def q_contract_id_format(spark, sf):
    c = DRIVER_CONTRACTS["customers"]
    return contracts.id_format_issues("customers", raw(spark, sf)["customers"], c["unique_key"], c["id_pattern"])


def q_contract_duplicate_key(spark, sf):
    return contracts.duplicate_key_issues("invoices", raw(spark, sf)["invoices"], "invoice_id")


def renewal_text(subscriptions: DataFrame) -> DataFrame:
    """Subscriptions with a text date whose month runs 00..13 (00 and 13 do not parse)."""
    month = F.lpad((F.col("subscription_id") % 14).cast("string"), 2, "0")
    return subscriptions.withColumn(INVALID_DATE_TEXT, F.concat(F.lit("1996-"), month, F.lit("-01")))


def q_contract_invalid_date(spark, sf):
    subs = renewal_text(raw(spark, sf)["subscriptions"])
    return contracts.date_issues("subscriptions", subs, INVALID_DATE_TEXT, "subscription_id", fmt="yyyy-MM-dd")


def q_contract_date_range(spark, sf):
    rule = DRIVER_CONTRACTS["subscriptions"]["date_columns"]["start_date"]
    return contracts.date_issues(
        "subscriptions", raw(spark, sf)["subscriptions"], "start_date", "subscription_id", rule["min"], rule["max"]
    )


def q_contract_numeric(spark, sf):
    return contracts.numeric_issues(
        "customers", raw(spark, sf)["customers"], "acctbal", "customer_id", 0, inclusive_min=False
    )


def q_contract_allowed_values(spark, sf):
    allowed = DRIVER_CONTRACTS["invoices"]["allowed_values"]["status"]
    return contracts.allowed_value_issues("invoices", raw(spark, sf)["invoices"], "status", "invoice_id", allowed)


def q_contract_foreign_key(spark, sf):
    return contracts.foreign_key_issues(
        "product_events",
        raw(spark, sf)["product_events"],
        "user_id",
        "event_id",
        suppliers(spark, sf),
        "s_suppkey",
        "suppliers",
    )


def q_contract_issues(spark, sf):
    return _issues(spark, sf)


def q_contract_issue_breakdown(spark, sf):
    return contracts.issue_breakdown(_issues(spark, sf))


def q_clean_customers(spark, sf):
    return silver(spark, sf)["customers"]


def q_clean_orphans(spark, sf):
    return clean.drop_orphans(raw(spark, sf)["product_events"], suppliers(spark, sf), "user_id", "s_suppkey")


def q_clean_subscriptions(spark, sf):
    return silver(spark, sf)["subscriptions"]


def q_clean_invoices(spark, sf):
    return silver(spark, sf)["invoices"]


def q_clean_invoices_dedup(spark, sf):
    r = raw(spark, sf)
    return clean.clean_invoices(r["invoices"], r["customers"].select("customer_id"), dedup=True)


def q_clean_events(spark, sf):
    return silver(spark, sf)["product_events"]


def q_clean_tickets(spark, sf):
    return silver(spark, sf)["support_tickets"]


def q_rejected_rows(spark, sf):
    r = raw(spark, sf)
    return clean.rejected_rows("invoices", r["invoices"], r["customers"].select("customer_id"), dedup=True)


def planted(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """The raw tables with repeats, unknown customers and bad amounts planted in them."""
    return views.with_defects(raw(spark, sf))


def q_planted_clean_customers(spark, sf):
    return cleaned(planted(spark, sf))["customers"]


def q_planted_clean_subscriptions(spark, sf):
    return cleaned(planted(spark, sf))["subscriptions"]


def q_planted_clean_invoices(spark, sf):
    return cleaned(planted(spark, sf))["invoices"]


def q_planted_clean_events(spark, sf):
    return cleaned(planted(spark, sf))["product_events"]


def q_planted_clean_tickets(spark, sf):
    return cleaned(planted(spark, sf))["support_tickets"]


REJECT_KEYS = {
    "customers": "customer_id",
    "subscriptions": "subscription_id",
    "invoices": "invoice_id",
    "product_events": "event_id",
    "support_tickets": "ticket_id",
}


def q_planted_rejected_rows(spark, sf):
    """C7 for all five tables: every rejected row by its key, with the reason."""
    r = planted(spark, sf)
    keys = r["customers"].select("customer_id")
    parts = [
        clean.rejected_rows(name, r[name], keys).select(
            F.lit(name).alias("table_name"), F.col(key).cast("string").alias("row_key"), "reject_reason"
        )
        for name, key in REJECT_KEYS.items()
    ]
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found


def q_planted_quality_summary(spark, sf):
    tables = {**planted(spark, sf), "suppliers": suppliers(spark, sf)}
    return quality.quality_summary_from_flags(tables, DRIVER_CONTRACTS)


def text_amounts(invoices: DataFrame) -> DataFrame:
    """Invoices whose amount is text: three decimals, exponents, blanks and words that are no numbers."""
    plain = F.col("amount").cast("string")
    kinds = [
        F.concat(plain, F.lit("5")), F.lit("1e3"), F.lit("1d"), F.lit("NaN"), F.lit("-0.004"),
        F.concat(F.lit(" "), plain, F.lit(" ")), F.lit("0.004"), F.lit("inf"),
    ]
    text = plain
    for i, kind in enumerate(kinds):
        text = F.when(F.col("invoice_id") % 11 == i, kind).otherwise(text)
    return invoices.withColumn("amount", text)


def q_contract_numeric_text(spark, sf):
    """K7 and K8 over amounts that have to be parsed."""
    rows = text_amounts(raw(spark, sf)["invoices"])
    return contracts.numeric_issues("invoices", rows, "amount", "invoice_id", 0, inclusive_min=False)


def q_mart_mrr_text(spark, sf):
    """A1 over parsed amounts: digits beyond cents count in the sums, which alone are rounded."""
    r = raw(spark, sf)
    return marts.mart_mrr(clean.clean_invoices(text_amounts(r["invoices"]), r["customers"].select("customer_id")))


def q_data_quality_summary(spark, sf):
    return _summary(spark, sf)


def q_quality_overall(spark, sf):
    return quality.overall_quality(_summary(spark, sf))


def q_quality_failures(spark, sf):
    return quality.quality_failures(_summary(spark, sf), QUALITY_THRESHOLD)


def q_incremental_new_rows(spark, sf):
    incoming = raw(spark, sf)["subscriptions"]
    stored = incoming.filter(F.col("start_date") < F.lit(STORED_BEFORE).cast("date"))
    return warehouse.new_rows(incoming, stored, "subscription_id")


def q_incremental_small_drop(spark, sf):
    """S6 and J3 with a drop of few keys: the last day's subscriptions land after all others, with the day before once more."""
    subscriptions = silver(spark, sf)["subscriptions"]
    last = F.lit(subscriptions.agg(F.max("start_date")).first()[0])
    earlier = F.coalesce(F.col("start_date") < last, F.lit(True))
    root = scratch_path(spark, "small-drop")
    warehouse.write_table(spark, root, "fact_subscriptions", subscriptions.where(earlier))
    drop = subscriptions.where(F.col("start_date") >= F.date_sub(last, 1))
    warehouse.load(spark, {"fact_subscriptions": drop}, root, "incremental")
    return warehouse.read_table(spark, root, "fact_subscriptions")


def q_csv_ingest(spark, sf):
    """Customers with awkward text written as CSV and read as a raw table."""
    i, name = F.col("customer_id"), F.col("customer_name")
    awkward = (
        F.when(i % 11 == 0, F.lit(""))
        .when(i % 5 == 0, F.concat(F.lit('"'), name, F.lit('", Ltd')))
        .when(i % 5 == 1, F.lit("NA"))
        .when(i % 5 == 2, F.concat(F.lit(" "), name, F.lit(" ")))
        .otherwise(F.concat(name, F.lit(", é")))
    )
    segment = F.when(i % 7 == 0, F.lit("null")).otherwise(F.col("segment"))
    rows = raw(spark, sf)["customers"].withColumns({"customer_name": awkward, "segment": segment})
    columns = DRIVER_CONTRACTS["customers"]["required_columns"]
    path = scratch_path(spark, "csv-ingest") + "/customers.csv"
    rows.select(*[F.col(c).cast("string") for c in columns]).write.options(**export.CSV_OPTIONS).csv(path)
    return ingest.read_raw_tables(spark, {"customers": path}, DRIVER_CONTRACTS)["customers"].select(*columns)


def q_jsonl_ingest(spark, sf):
    """Product events written as JSON lines, numbers among them, and read as they stand."""
    columns = ["event_id", "customer_id", "user_id", "feature", "event_type"]
    rows = raw(spark, sf)["product_events"].select(
        *columns,
        (F.col("event_id") % 100).cast("decimal(10,2)").alias("price"),
        F.concat("event_type", F.lit('\n"'), "feature", F.lit("\\ é")).alias("note"),
    )
    path = scratch_path(spark, "jsonl-ingest") + "/product_events.jsonl"
    rows.write.json(path)
    contract = {"product_events": {"required_columns": columns, "extra_columns": ["price", "note"]}}
    found = ingest.read_raw_tables(spark, {"product_events": path}, contract)["product_events"]
    return found.select(*columns, "price", "note")


def q_billing_schedule(spark, sf):
    return billing.billing_schedule(silver(spark, sf)["subscriptions"], HORIZON)


def q_billing_gap(spark, sf):
    s = silver(spark, sf)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return billing.billing_gap(billing.billing_schedule(s["subscriptions"], HORIZON, partitions), s["invoices"])


def q_parquet_roundtrip(spark, sf):
    """Silver invoices written as a month-partitioned warehouse table and read back."""
    root = scratch_path(spark, "warehouse")
    warehouse.write_table(spark, root, "fact_invoices", silver(spark, sf)["invoices"])
    return warehouse.read_table(spark, root, "fact_invoices")


def q_export_roundtrip(spark, sf):
    """The health mart exported as sorted CSV and read back with its schema."""
    health = _health(silver(spark, sf))
    root = scratch_path(spark, "exports")
    paths = export.export_marts({"mart_customer_health": health}, root)
    return export.read_export(spark, paths["mart_customer_health"], health.schema)


def _export_with_position(spark, sf, name: str, build) -> DataFrame:
    """A bounded mart (one row per month or feature) exported, read back, with the place of each row in its file."""
    mart = build(spark, sf)
    paths = export.export_marts({name: mart}, scratch_path(spark, "export-order"))
    placed = export.read_export(spark, paths[name], mart.schema).select(
        "*",
        F.col("_metadata.file_name").alias("_ingest_file"),
        F.col("_metadata.file_block_start").alias("_ingest_offset"),
        F.monotonically_increasing_id().alias("_ingest_row"),
    )
    place = F.row_number().over(Window.orderBy("_ingest_file", "_ingest_offset", "_ingest_row"))
    return placed.select(*mart.columns, place.alias("position"))


def q_export_mart_mrr(spark, sf):
    """S9 and O1."""
    return _export_with_position(spark, sf, "mart_mrr", q_mart_mrr)


def q_export_mart_churn(spark, sf):
    """S9 and O2."""
    return _export_with_position(spark, sf, "mart_churn", q_mart_churn)


def q_export_mart_feature_adoption(spark, sf):
    """S9 and O3."""
    return _export_with_position(spark, sf, "mart_feature_adoption", q_mart_feature_adoption)


def q_export_mart_customer_health(spark, sf):
    """The mart is written by many tasks; a row's place is its place in its file after the rows of the files before."""
    mart = _health(silver(spark, sf))
    paths = export.export_marts({"mart_customer_health": mart}, scratch_path(spark, "export-order"))
    rows = export.read_export(spark, paths["mart_customer_health"], mart.schema).select(
        "*",
        F.col("_metadata.file_name").alias("_file"),
        F.col("_metadata.file_block_start").alias("_offset"),
        F.monotonically_increasing_id().alias("_row"),
    )
    own = F.row_number().over(Window.partitionBy("_file").orderBy("_offset", "_row"))
    files = rows.groupBy("_file").agg(F.count(F.lit(1)).alias("_n"))
    # One row for each file.
    files = files.select("_file", (F.sum("_n").over(Window.orderBy("_file")) - F.col("_n")).alias("_before"))
    placed = rows.withColumn("_place", own).join(files, "_file")
    return placed.select(*mart.columns, (F.col("_before") + F.col("_place")).cast("int").alias("position"))


def q_feature_adoption_monthly(spark, sf):
    """A3b from stored sketches: days loaded in two drops, rolled up to months, beside exact counts."""
    events = silver(spark, sf)["product_events"]
    root = scratch_path(spark, "sketches")
    odd = F.col("event_id") % 2 == 1
    warehouse.write_table(spark, root, "feature_sketches", marts.adoption_sketches(events.where(odd)))
    warehouse.append_rows(spark, root, "feature_sketches", marts.adoption_sketches(events.where(~odd)))
    month = F.trunc("day", "month").alias("month")
    rolled = marts.adoption_from_sketches(warehouse.read_table(spark, root, "feature_sketches"), month).select(
        F.col("month").alias("m"), F.col("feature").alias("f"), F.col("events").alias("e"),
        F.col("active_users").alias("u"), F.col("active_customers").alias("c"),
    )
    exact = events.groupBy(F.trunc(F.to_date("event_time"), "month").alias("month"), "feature").agg(
        F.count(F.lit(1)).alias("events"),
        F.count_distinct("user_id").alias("active_users"),
        F.count_distinct("customer_id").alias("active_customers"),
    )
    same = F.col("month").eqNullSafe(F.col("m")) & F.col("feature").eqNullSafe(F.col("f")) & (F.col("e") == F.col("events"))
    error = 3 * 1.04 / 2 ** (marts.LG_K / 2)
    near = lambda estimate, count: F.abs(F.col(estimate) - F.col(count)) <= error * F.col(count)
    return exact.join(rolled, same).select(
        *exact.columns, near("u", "active_users").alias("users_near"), near("c", "active_customers").alias("customers_near")
    )


def q_mart_mrr_refresh(spark, sf):
    """A1 kept up to date: built, then only the months of a later load built again."""
    invoices = silver(spark, sf)["invoices"]
    root = scratch_path(spark, "refresh")
    later = (F.col("invoice_month") >= F.lit(STORED_BEFORE).cast("date")) & (F.col("invoice_id") % 2 == 0)
    warehouse.write_table(spark, root, "fact_invoices", invoices.where(~F.coalesce(later, F.lit(False))))
    warehouse.refresh(spark, root, "mart_mrr", "fact_invoices", "invoice_month", marts.mart_mrr)
    warehouse.append_rows(spark, root, "fact_invoices", invoices.where(later))
    warehouse.refresh(spark, root, "mart_mrr", "fact_invoices", "invoice_month", marts.mart_mrr)
    return warehouse.read_table(spark, root, "mart_mrr")


def q_export_executive_overview(spark, sf):
    """S9."""
    return _export_with_position(spark, sf, "executive_overview", q_executive_overview)


def q_mrr_mismatch(spark, sf):
    """H3 where the two sides differ: the export lacks the months from ``STORED_BEFORE`` on."""
    mrr = marts.mart_mrr(silver(spark, sf)["invoices"])
    return quality.mrr_reconciliation(mrr.where(F.col("invoice_month") < F.lit(STORED_BEFORE).cast("date")), mrr)


def q_mrr_reconciliation(spark, sf):
    """H3 over a real export: mart_mrr written as CSV, read back, compared with the stored table."""
    mrr = marts.mart_mrr(silver(spark, sf)["invoices"])
    root = scratch_path(spark, "reconcile")
    warehouse.write_table(spark, root, "mart_mrr", mrr)
    stored = warehouse.read_table(spark, root, "mart_mrr")
    paths = export.export_marts({"mart_mrr": stored}, root + "/exports")
    exported = export.read_export(spark, paths["mart_mrr"], stored.schema)
    return quality.mrr_reconciliation(exported, stored)


def q_stream_feature_adoption(spark, sf):
    """The events table read as a file stream, adoption per event-time day."""
    schema = views.table(spark, sf, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    out = scratch_path(spark, "stream-adoption")
    query = stream_adoption.write_updates(
        stream_adoption.stream_feature_adoption(views.product_events_of(stream)), f"{out}/table", f"{out}/checkpoint"
    )
    query.awaitTermination()
    latest = stream_adoption.latest_adoption(spark, f"{out}/table")
    day = F.to_date(F.col("event_time"))
    exact = views.product_events(spark, sf).groupBy(day.alias("day"), F.col("feature").alias("f")).agg(
        F.count_distinct("user_id").alias("users"), F.count_distinct("customer_id").alias("customers")
    )
    same = (F.to_date("window_start") == F.col("day")) & F.col("feature").eqNullSafe(F.col("f"))
    return latest.join(exact, same).select(
        "window_start",
        "window_end",
        "feature",
        "events",
        F.col("users").alias("exact_users"),
        F.col("customers").alias("exact_customers"),
        _near("active_users", "users").alias("users_near"),
        _near("active_customers", "customers").alias("customers_near"),
    )


STREAM_COLUMNS = {
    "customers": DRIVER_CONTRACTS["customers"]["required_columns"],
    "subscriptions": DRIVER_CONTRACTS["subscriptions"]["required_columns"],
}


def q_stream_incremental_load(spark, sf):
    """Customers and subscriptions land as CSV files in two drops (orders
    before ``STORED_BEFORE`` first), each drop is loaded by the streaming
    incremental load; the result is the streamed silver subscriptions."""
    base = scratch_path(spark, "stream-load")
    r = raw(spark, sf)
    landing = {name: f"{base}/landing/{name}" for name in STREAM_COLUMNS}
    contracts_ = {name: {"required_columns": cols} for name, cols in STREAM_COLUMNS.items()}
    early = F.col("start_date") < F.lit(STORED_BEFORE).cast("date")
    drops = [
        {"customers": r["customers"], "subscriptions": r["subscriptions"].filter(early)},
        {"subscriptions": r["subscriptions"].filter(~early | F.col("start_date").isNull())},
    ]
    for i, drop in enumerate(drops):
        for name, df in drop.items():
            cols = STREAM_COLUMNS[name]
            df.select(*[F.col(c).cast("string") for c in cols]).write.option("header", True).csv(
                f"{landing[name]}/drop-{i:04d}"
            )
        stream_loading.stream_load(
            spark, {n: f"{landing[n]}/drop-*" for n in landing}, f"{base}/warehouse", f"{base}/checkpoint", contracts_
        )
    stored = warehouse.read_table(spark, f"{base}/warehouse", "fact_subscriptions")
    # Parsed from text, money has ten decimals; these amounts have two.
    return stored.withColumn("mrr", F.col("mrr").cast(MONEY))


STREAM_VALUES = {
    "customers": "segment",
    "subscriptions": "status",
    "invoices": "status",
    "product_events": "feature",
    "support_tickets": "opened_date",
}


def q_stream_planted(spark, sf):
    """T1 over all five tables, JSON lines among them, in two drops.

    The first drop lacks every fifth customer, whose rows are parked; the
    second brings them and the planted rows: repeats, bad amounts, rows of
    unknown customers.  One row per streamed silver row.
    """
    base = scratch_path(spark, "stream-planted")
    plain = raw(spark, sf)
    late = F.col("customer_id") % 5 == 0
    drops = [
        {**plain, "customers": plain["customers"].where(~late)},
        {**views.defect_rows(plain), "customers": plain["customers"].where(late)},
    ]
    contracts_ = {}
    landing = {}
    for name, df in plain.items():
        columns = [c for c in df.columns if not c.startswith("_ingest_")]
        contracts_[name] = {"required_columns": columns}
        suffix = ".jsonl" if name == "product_events" else ""
        landing[name] = f"{base}/landing/drop-*/{name}{suffix}"
    for i, drop in enumerate(drops):
        for name, df in drop.items():
            text = df.select(*[F.col(c).cast("string") for c in contracts_[name]["required_columns"]])
            path = landing[name].replace("*", f"{i:04d}")
            if path.endswith("jsonl"):
                text.write.json(path)
            else:
                text.write.options(**export.CSV_OPTIONS).csv(path)
        stream_loading.stream_load(spark, landing, f"{base}/warehouse", f"{base}/checkpoint", contracts_)
    parts = [
        warehouse.read_table(spark, f"{base}/warehouse", clean.SILVER_NAMES[name]).select(
            F.lit(name).alias("table_name"),
            F.col(key).alias("row_key"),
            "customer_id",
            F.col(STREAM_VALUES[name]).cast("string").alias("value"),
        )
        for name, key in REJECT_KEYS.items()
    ]
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "mart_mrr": q_mart_mrr,
    "mart_mrr_paid": q_mart_mrr_paid,
    "mart_churn": q_mart_churn,
    "mart_feature_adoption": q_mart_feature_adoption,
    "feature_adoption_approx": q_feature_adoption_approx,
    "feature_adoption_monthly": q_feature_adoption_monthly,
    "mart_mrr_refresh": q_mart_mrr_refresh,
    "export_mart_customer_health": q_export_mart_customer_health,
    "customer_health": q_customer_health,
    "customer_health_parity": q_customer_health_parity,
    "executive_overview": q_executive_overview,
    "health_top25": q_health_top25,
    "health_segments": q_health_segments,
    "contract_id_format": q_contract_id_format,
    "contract_duplicate_key": q_contract_duplicate_key,
    "contract_invalid_date": q_contract_invalid_date,
    "contract_date_range": q_contract_date_range,
    "contract_numeric": q_contract_numeric,
    "contract_allowed_values": q_contract_allowed_values,
    "contract_foreign_key": q_contract_foreign_key,
    "contract_issues": q_contract_issues,
    "contract_issue_breakdown": q_contract_issue_breakdown,
    "clean_customers": q_clean_customers,
    "clean_orphans": q_clean_orphans,
    "clean_subscriptions": q_clean_subscriptions,
    "clean_invoices": q_clean_invoices,
    "clean_invoices_dedup": q_clean_invoices_dedup,
    "clean_events": q_clean_events,
    "clean_tickets": q_clean_tickets,
    "rejected_rows": q_rejected_rows,
    "planted_clean_customers": q_planted_clean_customers,
    "planted_clean_subscriptions": q_planted_clean_subscriptions,
    "planted_clean_invoices": q_planted_clean_invoices,
    "planted_clean_events": q_planted_clean_events,
    "planted_clean_tickets": q_planted_clean_tickets,
    "planted_rejected_rows": q_planted_rejected_rows,
    "planted_quality_summary": q_planted_quality_summary,
    "contract_numeric_text": q_contract_numeric_text,
    "mart_mrr_text": q_mart_mrr_text,
    "data_quality_summary": q_data_quality_summary,
    "quality_overall": q_quality_overall,
    "quality_failures": q_quality_failures,
    "incremental_new_rows": q_incremental_new_rows,
    "incremental_small_drop": q_incremental_small_drop,
    "csv_ingest": q_csv_ingest,
    "jsonl_ingest": q_jsonl_ingest,
    "billing_schedule": q_billing_schedule,
    "billing_gap": q_billing_gap,
    "parquet_roundtrip": q_parquet_roundtrip,
    "export_roundtrip": q_export_roundtrip,
    "export_mart_mrr": q_export_mart_mrr,
    "export_mart_churn": q_export_mart_churn,
    "export_mart_feature_adoption": q_export_mart_feature_adoption,
    "export_executive_overview": q_export_executive_overview,
    "mrr_reconciliation": q_mrr_reconciliation,
    "mrr_mismatch": q_mrr_mismatch,
    "stream_feature_adoption": q_stream_feature_adoption,
    "stream_incremental_load": q_stream_incremental_load,
    "stream_planted": q_stream_planted,
}
