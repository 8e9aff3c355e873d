"""Brute-force references for tests and the benchmark only.

``customer_health_literal`` is the reference's literal three-way left join:
every customer yields invoices x events x tickets rows before grouping.  It
emits all pairs within a customer, so it is not part of the library; it
checks the closed form ``marts.customer_health(fan_out=True)`` on small
fixtures and gives the benchmark its baseline at sf0.01.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.coerce import decimal_literal, round_half_away
from ledgerline.operators.marts import TOTAL, _paid


def customer_health_literal(
    customers: DataFrame,
    invoices: DataFrame,
    events: DataFrame,
    tickets: DataFrame,
    cap: float = 100,
    revenue_divisor: float = 100,
    event_weight: float = 0.4,
    ticket_weight: float = 2,
) -> DataFrame:
    """The literal fan-out join; its intermediate size is the per-customer
    product of child row counts (small fixtures and sf0.01 only)."""
    c = customers.select("customer_id", "customer_name", "segment").alias("c")
    i = invoices.select("customer_id", "status", "amount").alias("i")
    e = events.select("customer_id", "event_id").alias("e")
    t = tickets.select("customer_id", "ticket_id").alias("t")
    joined = (
        c.join(i, F.col("c.customer_id") == F.col("i.customer_id"), "left")
        .join(e, F.col("c.customer_id") == F.col("e.customer_id"), "left")
        .join(t, F.col("c.customer_id") == F.col("t.customer_id"), "left")
    )
    grouped = joined.groupBy("c.customer_id", "c.customer_name", "c.segment").agg(
        F.coalesce(F.sum(_paid("i.status", "i.amount")), F.lit(0)).alias("_revenue"),
        F.count_distinct("e.event_id").alias("product_events"),
        F.count_distinct("t.ticket_id").alias("support_tickets"),
    )
    revenue = F.col("_revenue").cast(TOTAL)
    raw_score = (
        revenue.cast("double") / F.lit(float(revenue_divisor))
        + F.col("product_events") * decimal_literal(event_weight)
        - F.col("support_tickets") * decimal_literal(ticket_weight)
    )
    return grouped.select(
        "customer_id",
        "customer_name",
        "segment",
        revenue.alias("revenue"),
        F.col("product_events").cast("bigint"),
        F.col("support_tickets").cast("bigint"),
        round_half_away(F.least(F.lit(float(cap)), raw_score.cast("double")), 2).alias("health_score"),
    )
