"""Billing schedule: the months each subscription should be invoiced for.

Per subscription (silver: first copy, known customer, mrr > 0): one row per
calendar month from the start month to the earlier of the horizon and the
end month, inclusive, with amount = mrr.  None when the end precedes the
start.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TOTAL = T.DecimalType(38, 2)


def billing_schedule(subscriptions: DataFrame, horizon: str = "2025-12-01", partitions: int | None = None) -> DataFrame:
    """B1: ``explode(sequence(first month, last month, 1 month))`` per row.

    ``sequence`` with an explicit step raises on inverted bounds, so it is
    only built when start <= end; ``explode`` of null yields no rows.  The
    fan-out per row is bounded by the horizon, so rows stay where they are
    (no shuffle).

    An aggregate by customer and month holds many months for each row that a
    task reads.  ``partitions`` deals the rows by customer before they fan
    out, over that many tasks, which Spark does not merge by their size
    before the fan-out; each holds its share of the customers only.
    """
    if partitions:
        subscriptions = subscriptions.repartition(partitions, "customer_id")
    limit = F.trunc(F.lit(horizon).cast("date"), "month")
    first = F.trunc(F.col("start_date"), "month")
    last = F.least(limit, F.coalesce(F.trunc(F.col("end_date"), "month"), limit))
    months = F.when(first <= last, F.sequence(first, last, F.expr("INTERVAL 1 MONTH")))
    return subscriptions.select(
        "subscription_id",
        "customer_id",
        F.explode(months).alias("billing_month"),
        F.col("mrr").alias("amount"),
    )


def billing_gap(schedule: DataFrame, invoices: DataFrame) -> DataFrame:
    """B2: scheduled vs paid amounts per customer and month, where they differ.

    Both sides are aggregated to (customer, month) first, so the full outer
    join sees at most one row per key on each side.
    """
    scheduled = schedule.groupBy("customer_id", "billing_month").agg(F.sum("amount").alias("_scheduled"))
    paid = (
        invoices.filter(F.col("status") == "paid")
        .groupBy("customer_id", F.col("invoice_month").alias("billing_month"))
        .agg(F.sum("amount").alias("_invoiced"))
    )
    joined = scheduled.join(paid, ["customer_id", "billing_month"], "full_outer")
    sched = F.coalesce(F.col("_scheduled"), F.lit(0)).cast(TOTAL)
    inv = F.coalesce(F.col("_invoiced"), F.lit(0)).cast(TOTAL)
    return joined.select(
        "customer_id",
        "billing_month",
        sched.alias("scheduled_amount"),
        inv.alias("invoiced_amount"),
        (sched - inv).cast(TOTAL).alias("gap_amount"),
    ).filter(F.col("gap_amount") != 0)
