"""Plan-shape checks: the properties the design relies on at scale."""

from __future__ import annotations

from ledgerline.operators import clean, contracts, marts
from ledgerline.plans import driver
from ledgerline.sources import driver_views as views

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_keep_first_is_partial_aggregate_not_window(spark):
    plan = _plan(clean.keep_first(views.invoices(spark, SF), "invoice_id"))
    assert "partial_min(" in plan
    assert "Window" not in plan


def test_filters_and_columns_reach_the_scan(spark):
    plan = _plan(views.product_events(spark, SF))
    assert "PushedFilters: [Not(EqualNullSafe(event_type,error))]" in plan
    mrr = _plan(driver.q_mart_mrr(spark, SF))
    lineitem_schema = [line for line in mrr.split("\n") if "lineitem" in line and "ReadSchema" in line]
    assert lineitem_schema, mrr
    for column in ("l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_tax", "l_linestatus"):
        assert all(column not in line for line in lineitem_schema)


def test_overview_has_no_cross_join_or_expand(spark):
    plan = _plan(driver.q_executive_overview(spark, SF))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "Expand"):
        assert node not in plan


def test_health_aggregates_before_joining(spark):
    s = driver.silver(spark, SF)
    plan = _plan(marts.customer_health(s["customers"], s["invoices"], s["product_events"], s["support_tickets"]))
    # Each child is partially aggregated per customer before any exchange to the join.
    assert plan.count("partial_sum") >= 1
    assert plan.count("partial_count") >= 2
    assert "CartesianProduct" not in plan


def test_duplicate_rows_spread_over_chunks(spark):
    plan = _plan(contracts.duplicate_key_issues("invoices", views.invoices(spark, SF), "invoice_id"))
    assert "_chunk" in plan and "hashpartitioning(row_reference" in plan


def test_raw_equals_clean_plus_rejected(spark):
    r = driver.raw(spark, SF)
    keys = r["customers"].select("customer_id")
    raw_n = r["invoices"].count()
    kept = clean.clean_invoices(r["invoices"], keys, dedup=True).count()
    rejected = clean.rejected_rows("invoices", r["invoices"], keys, dedup=True).count()
    assert raw_n == kept + rejected
    for name, cleaner in (
        ("subscriptions", clean.clean_subscriptions),
        ("product_events", clean.clean_events),
        ("support_tickets", clean.clean_tickets),
    ):
        total = r[name].count()
        assert total == cleaner(r[name], keys).count() + clean.rejected_rows(name, r[name], keys).count(), name


def test_driver_results_equal_under_200_partitions(spark):
    before = sorted(tuple(x) for x in driver.q_customer_health(spark, SF).collect())
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        after = sorted(tuple(x) for x in driver.q_customer_health(spark, SF).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert before == after


def test_dedup_output_keeps_key_partitioning(spark):
    """The health join reads customers straight off the dedup aggregate: one
    shuffle on customer_id per input (customers, invoices, events, tickets),
    no second shuffle of the deduplicated customers."""
    import re

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # the large-table shape
    try:
        plan = _plan(driver.q_customer_health(spark, SF))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(re.findall(r"Exchange hashpartitioning\(customer_id#\d+L?, \d+\)", plan)) == 4, plan


def test_partitioned_write_rebalances_months(spark, workdir):
    """Month-partitioned facts are rebalanced on the month before writing, so
    a month is not written as one small file by every task."""
    import glob
    import os

    from ledgerline.sources import warehouse

    invoices = driver.silver(spark, SF)["invoices"]
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        warehouse.write_table(spark, workdir, "fact_invoices", invoices.repartition(8))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    (path,) = warehouse.current(spark, workdir, "fact_invoices")["paths"]
    months = glob.glob(os.path.join(path, "invoice_month=*"))
    assert months
    files = [len(glob.glob(os.path.join(m, "*.parquet"))) for m in months]
    assert max(files) == 1, files
    assert warehouse.read_table(spark, workdir, "fact_invoices").count() == invoices.count()


def test_parent_keys_deduplicated_before_semi_and_anti_joins(spark):
    """A parent key repeated across many rows reaches the join once per task,
    not once per row: the parent side is a partial aggregate on the key."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df in (driver.q_clean_orphans(spark, SF), driver.q_contract_foreign_key(spark, SF)):
            plan = _plan(df)
            assert "HashAggregate(keys=[_parent_key" in plan, plan
        assert "HashAggregate(keys=[_stored_key" in _plan(driver.q_incremental_new_rows(spark, SF))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_key_set_deduplicates_only_above_broadcast_threshold(spark):
    from ledgerline.functions.joins import key_set, size_conf

    assert size_conf("10485760b") == size_conf("10MB") == 10 * 1024 * 1024
    assert size_conf("-1") == -1
    keys = views.table(spark, SF, "supplier").select("s_suppkey")
    assert "HashAggregate" not in _plan(key_set(keys))  # small: broadcast, repeats held once
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "HashAggregate(keys=[s_suppkey" in _plan(key_set(keys))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_small_probe_narrows_a_large_key_set_without_shuffling_it(spark):
    """A small batch against a large key set: the keys are narrowed by a
    broadcast semi join over the key column (no exchange of the keys), and
    the rows are the same as on the other paths."""
    from pyspark.sql import functions as F

    from ledgerline.functions.joins import key_set
    from ledgerline.sources import warehouse

    stored = spark.range(0, 200_000).select(F.col("id").cast("string").alias("id"), F.lit(1).alias("v"))
    # Built from range so the batch has size statistics, as file-backed batches do.
    pick = F.col("id").cast("int") + 1
    incoming = spark.range(4).select(
        F.element_at(F.array(F.lit("5"), F.lit("199999"), F.lit("x"), F.lit(None).cast("string")), pick).alias("id"),
        F.element_at(F.array(F.lit(2), F.lit(2), F.lit(3), F.lit(4)), pick).alias("v"),
    )
    expected = sorted(map(tuple, warehouse.new_rows(incoming, stored, "id").collect()), key=repr)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(64 * 1024))  # store over it, batch under it
    try:
        narrowed = key_set(stored.select("id"), incoming.select("id"))
        plan = _plan(narrowed)
        assert "BroadcastHashJoin" in plan and "LeftSemi" in plan and "Exchange hashpartitioning" not in plan, plan
        got = sorted(map(tuple, warehouse.new_rows(incoming, stored, "id").collect()), key=repr)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == expected == sorted([("x", 3), (None, 4)], key=repr)
