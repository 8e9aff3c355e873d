"""Gold marts over silver tables.

Money stays DECIMAL so sums are exact and independent of partitioning;
ratios and scores are DOUBLE rounded the way the reference's SQL engine
rounds doubles (``round_half_away``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.coerce import decimal_literal, round_half_away

TOTAL = T.DecimalType(38, 2)


def _paid(status: str = "status", amount: str = "amount") -> Column:
    """CASE WHEN status = 'paid' THEN amount ELSE 0 (case-sensitive: 'PAID' earns nothing)."""
    return F.when(F.col(status) == "paid", F.col(amount)).otherwise(F.lit(0))


# ----------------------------------------------------------------------------
# A1 / A1d  MRR by invoice month
# ----------------------------------------------------------------------------


def mart_mrr(invoices: DataFrame, paid_only_payers: bool = False) -> DataFrame:
    """Paid revenue, payers and revenue per payer for each raw invoice month.

    With ``paid_only_payers=False`` (the reference) ``paying_customers``
    counts customers with an invoice of any status; ``True`` counts only
    customers with a paid invoice.
    """
    payer = F.when(F.col("status") == "paid", F.col("customer_id")) if paid_only_payers else F.col("customer_id")
    grouped = invoices.groupBy("invoice_month").agg(
        F.sum(_paid()).alias("_paid"),
        F.count_distinct(payer).alias("_payers"),
    )
    return grouped.select(
        "invoice_month",
        F.round("_paid", 2).cast(TOTAL).alias("mrr"),
        F.col("_payers").cast("bigint").alias("paying_customers"),
        round_half_away(F.col("_paid").cast("double") / F.nullif(F.col("_payers"), F.lit(0)), 2).alias("arpa"),
    )


# ----------------------------------------------------------------------------
# A2  churn by month of end date
# ----------------------------------------------------------------------------


def mart_churn(subscriptions: DataFrame) -> DataFrame:
    """Cancelled subscriptions with an end date, per month of that date.

    ``churned_customers`` counts subscriptions (the reference's name is kept).
    """
    cancelled = subscriptions.filter((F.col("status") == "cancelled") & F.col("end_date").isNotNull())
    return cancelled.groupBy(F.trunc(F.col("end_date"), "month").alias("churn_month")).agg(
        F.count(F.lit(1)).alias("churned_customers"),
        F.round(F.sum("mrr"), 2).cast(TOTAL).alias("churned_mrr"),
    )


# ----------------------------------------------------------------------------
# A3 / A3b  feature adoption
# ----------------------------------------------------------------------------


def mart_feature_adoption(events: DataFrame, approx: bool = False, rsd: float = 0.05) -> DataFrame:
    """Events, distinct users and distinct customers per feature.

    ``approx=True`` swaps the exact distinct counts for HyperLogLog++ sketches
    (one partial-aggregate pass, no per-key distinct shuffle).
    """
    if approx:
        users = F.approx_count_distinct("user_id", rsd)
        customers = F.approx_count_distinct("customer_id", rsd)
    else:
        users = F.count_distinct("user_id")
        customers = F.count_distinct("customer_id")
    return events.groupBy("feature").agg(
        F.count(F.lit(1)).alias("events"),
        users.cast("bigint").alias("active_users"),
        customers.cast("bigint").alias("active_customers"),
    )


# Registers of a stored sketch: 2 to this power, with a relative standard error of about 1.04 / 2 ** (LG_K / 2).
LG_K = 12


def adoption_sketches(events: DataFrame) -> DataFrame:
    """Events and mergeable sketches of users and customers per day and feature, to be stored and appended to.

    A day may come in several loads; ``adoption_from_sketches`` merges whatever rows there are.
    """
    return events.groupBy(F.to_date("event_time").alias("day"), "feature").agg(
        F.count(F.lit(1)).alias("events"),
        F.hll_sketch_agg("user_id", LG_K).alias("users"),
        F.hll_sketch_agg("customer_id", LG_K).alias("customers"),
    )


def adoption_from_sketches(sketches: DataFrame, *period: Column) -> DataFrame:
    """Adoption per ``period`` (columns over ``day``; none: in total) and feature, without the events."""
    return sketches.groupBy(*period, "feature").agg(
        F.sum("events").cast("bigint").alias("events"),
        F.hll_sketch_estimate(F.hll_union_agg("users")).alias("active_users"),
        F.hll_sketch_estimate(F.hll_union_agg("customers")).alias("active_customers"),
    )


# ----------------------------------------------------------------------------
# A4 / J4 / J5  customer health
# ----------------------------------------------------------------------------


def customer_health(
    customers: DataFrame,
    invoices: DataFrame,
    events: DataFrame,
    tickets: DataFrame,
    fan_out: bool = False,
    cap: float = 100,
    revenue_divisor: float = 100,
    event_weight: float = 0.4,
    ticket_weight: float = 2,
) -> DataFrame:
    """Revenue, product events, support tickets and a capped score per customer.

    Each child table is aggregated per customer first (map-side partial
    aggregation, one shuffle each on ``customer_id``) and the three small
    results are left-joined to the customers; all three joins then share the
    ``customer_id`` partitioning.

    ``fan_out=True`` reproduces the reference's literal three-way left join,
    where every customer yields invoices x events x tickets rows so the paid
    sum is multiplied by ``max(1, events) * max(1, tickets)`` (row counts);
    the distinct counts are unaffected.  The closed form gives exactly that
    without materialising the product (checked against the literal join in
    ``tests/brute_force.py``).
    """
    inv = invoices.groupBy("customer_id").agg(F.sum(_paid()).alias("_paid"))
    ev = events.groupBy("customer_id").agg(
        F.count_distinct("event_id").alias("_events"),
        F.count(F.lit(1)).alias("_event_rows"),
    )
    tk = tickets.groupBy("customer_id").agg(
        F.count_distinct("ticket_id").alias("_tickets"),
        F.count(F.lit(1)).alias("_ticket_rows"),
    )
    base = customers.select("customer_id", "customer_name", "segment")
    joined = base.join(inv, "customer_id", "left").join(ev, "customer_id", "left").join(tk, "customer_id", "left")

    revenue = F.coalesce(F.col("_paid"), F.lit(0))
    if fan_out:
        revenue = (
            revenue
            * F.greatest(F.lit(1), F.coalesce(F.col("_event_rows"), F.lit(0)))
            * F.greatest(F.lit(1), F.coalesce(F.col("_ticket_rows"), F.lit(0)))
        )
    n_events = F.coalesce(F.col("_events"), F.lit(0)).cast("bigint")
    n_tickets = F.coalesce(F.col("_tickets"), F.lit(0)).cast("bigint")
    revenue = revenue.cast(TOTAL)
    raw_score = (
        revenue.cast("double") / F.lit(float(revenue_divisor))
        + n_events * decimal_literal(event_weight)
        - n_tickets * decimal_literal(ticket_weight)
    )
    score = round_half_away(F.least(F.lit(float(cap)), raw_score.cast("double")), 2)
    return joined.select(
        "customer_id",
        "customer_name",
        "segment",
        revenue.alias("revenue"),
        n_events.alias("product_events"),
        n_tickets.alias("support_tickets"),
        score.alias("health_score"),
    )


# ----------------------------------------------------------------------------
# A5  executive overview
# ----------------------------------------------------------------------------


def executive_overview(
    mrr: DataFrame,
    churn: DataFrame,
    health: DataFrame,
    subscriptions: DataFrame,
    events: DataFrame,
) -> DataFrame:
    """One row of six figures.

    The reference runs six scalar sub-queries.  Here each figure's input is
    first reduced on its own (the two distinct counts become ordinary
    two-phase ``distinct`` aggregates, partial in every task), the reduced
    inputs are narrowed to one tagged shape and unioned, and a single global
    aggregate of plain sums and counts produces the row: no cross join, no
    ``Expand`` over the large inputs.  Subscriptions are read for three
    figures, events and invoices for two each.
    """

    def tagged(df: DataFrame, src: str, amount=None, score=None, count=None) -> DataFrame:
        none = F.lit(None)
        return df.select(
            F.lit(src).alias("_src"),
            (amount if amount is not None else none).cast(TOTAL).alias("_amount"),
            (score if score is not None else none).cast("double").alias("_score"),
            (count if count is not None else none).cast("bigint").alias("_count"),
        )

    active = (
        subscriptions.filter((F.col("status") == "active") & F.col("customer_id").isNotNull())
        .select("customer_id")
        .distinct()
    )
    trial = subscriptions.filter(F.col("status") == "trial").agg(F.count(F.lit(1)).alias("n"))
    users = events.filter(F.col("user_id").isNotNull()).select("user_id").distinct()
    parts = [
        tagged(mrr, "mrr", amount=F.col("mrr")),
        tagged(churn, "churn", count=F.col("churned_customers")),
        tagged(health, "health", score=F.col("health_score")),
        tagged(active, "active", count=F.lit(1)),
        tagged(trial, "trial", count=F.col("n")),
        tagged(users, "user", count=F.lit(1)),
    ]
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part)

    src = F.col("_src")

    def total(tag: str) -> Column:
        return F.coalesce(F.sum(F.when(src == tag, F.col("_count"))), F.lit(0)).cast("bigint")

    return stacked.agg(
        F.round(F.sum(F.when(src == "mrr", F.col("_amount"))), 2).cast(TOTAL).alias("annual_recurring_revenue"),
        total("active").alias("active_customers"),
        total("trial").alias("trial_customers"),
        total("churn").alias("churned_customers"),
        total("user").alias("active_users"),
        round_half_away(F.avg(F.when(src == "health", F.col("_score"))), 2).alias("average_health_score"),
    )


def build_marts(silver: dict[str, DataFrame], **health_params) -> dict[str, DataFrame]:
    """The five marts over silver tables named as in the warehouse."""
    mrr = mart_mrr(silver["fact_invoices"])
    churn = mart_churn(silver["fact_subscriptions"])
    adoption = mart_feature_adoption(silver["fact_product_events"])
    health = customer_health(
        silver["dim_customers"],
        silver["fact_invoices"],
        silver["fact_product_events"],
        silver["fact_support_tickets"],
        **health_params,
    )
    overview = executive_overview(mrr, churn, health, silver["fact_subscriptions"], silver["fact_product_events"])
    return {
        "executive_overview": overview,
        "mart_mrr": mrr,
        "mart_churn": churn,
        "mart_feature_adoption": adoption,
        "mart_customer_health": health,
    }
