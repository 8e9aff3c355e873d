"""The five source tables expressed over the driver's TPC-H-like tables.

customers        <- customer (+ nation name)
subscriptions    <- orders (+ last ship date of each order)
invoices         <- lineitem (+ customer of the order)
product_events   <- events that are not errors
support_tickets  <- events that are errors

The same definitions are written in SQL for the DuckDB oracle
(``ledgerline.plans.oracle``).  Columns prefixed ``_ingest_`` only decide
which copy of a repeated key counts as first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.coerce import MONEY

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    return c.join(n, c.c_nationkey == n.n_nationkey, "left").select(
        c.c_custkey.alias("customer_id"),
        c.c_name.alias("customer_name"),
        c.c_mktsegment.alias("segment"),
        n.n_name.alias("country"),
        c.c_acctbal.alias("acctbal"),
    )


def subscriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    last_ship = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(F.max("l_shipdate").alias("last_ship"))
    )
    status = (
        F.when(o.o_orderstatus == "F", "cancelled")
        .when(o.o_orderstatus == "O", "active")
        .when(o.o_orderstatus == "P", "trial")
    )
    return o.join(last_ship, o.o_orderkey == last_ship.l_orderkey, "left").select(
        o.o_orderkey.alias("subscription_id"),
        o.o_custkey.alias("customer_id"),
        o.o_orderpriority.alias("plan"),
        F.to_date(o.o_orderdate).alias("start_date"),
        F.when(o.o_orderstatus == "F", F.to_date("last_ship")).alias("end_date"),
        status.alias("status"),
        o.o_totalprice.cast(MONEY).alias("mrr"),
    )


def invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    status = (
        F.when(li.l_returnflag == "N", "paid")
        .when(li.l_returnflag == "A", "failed")
        .when(li.l_returnflag == "R", "refunded")
    )
    return li.join(o, li.l_orderkey == o.o_orderkey, "left").select(
        (li.l_orderkey * 10 + li.l_linenumber).alias("invoice_id"),
        o.o_custkey.alias("customer_id"),
        F.trunc(F.to_date(li.l_shipdate), "month").alias("invoice_month"),
        li.l_extendedprice.cast(MONEY).alias("amount"),
        status.alias("status"),
        li.l_partkey.alias("_ingest_partkey"),
        li.l_suppkey.alias("_ingest_suppkey"),
        li.l_quantity.alias("_ingest_quantity"),
        li.l_discount.alias("_ingest_discount"),
        li.l_tax.alias("_ingest_tax"),
        li.l_linestatus.alias("_ingest_linestatus"),
        li.l_shipdate.alias("_ingest_shipdate"),
    )


def _is_error(events: DataFrame):
    return events.event_type.eqNullSafe(F.lit("error"))


def product_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return product_events_of(table(spark, sf_dir, "events"))


def product_events_of(e: DataFrame) -> DataFrame:
    """The product-event projection of an events DataFrame (batch or stream)."""
    k = F.get_json_object(e.props, "$.k").try_cast("bigint")
    return e.filter(~_is_error(e)).select(
        e.event_id,
        F.expr("user_id div 3").alias("customer_id"),
        e.user_id,
        e.ts.alias("event_time"),
        F.concat(F.lit("F"), (k % 5).cast("string")).alias("feature"),
        e.event_type,
    )


def support_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.filter(_is_error(e)).select(
        e.event_id.alias("ticket_id"),
        F.expr("user_id div 3").alias("customer_id"),
        F.to_date(e.ts).alias("opened_date"),
    )


# Defects planted beside the rows of each table: copies of the rows that meet
# a condition, with some columns replaced.  Conditions and values are written
# so that Spark and the DuckDB oracle read them alike.
DEFECTS: dict[str, list[tuple[str, dict[str, str]]]] = {
    "customers": [("customer_id % 41 = 0", {"customer_name": "concat(customer_name, ' again')", "acctbal": "-acctbal"})],
    "subscriptions": [
        ("subscription_id % 37 = 0", {"mrr": "CAST(-mrr AS DECIMAL(18,2))"}),
        ("subscription_id % 41 = 0", {"status": "'trial'"}),
        ("subscription_id % 29 = 0", {"subscription_id": "-subscription_id", "customer_id": "-customer_id"}),
        ("subscription_id % 31 = 0", {"subscription_id": "-subscription_id", "mrr": "CAST(0 AS DECIMAL(18,2))"}),
    ],
    "invoices": [
        ("invoice_id % 43 = 0", {"amount": "CAST(-amount AS DECIMAL(18,2))"}),
        ("invoice_id % 31 = 0", {"customer_id": "-customer_id"}),
    ],
    "product_events": [
        ("event_id % 47 = 0", {"feature": "'F9'"}),
        ("event_id % 53 = 0", {"customer_id": "-1 - customer_id"}),
    ],
    "support_tickets": [
        ("ticket_id % 7 = 0", {"opened_date": "CAST(opened_date + INTERVAL 1 DAY AS DATE)"}),
        ("ticket_id % 11 = 0", {"customer_id": "-1 - customer_id"}),
    ],
}


def with_defects(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The tables with the rows of ``DEFECTS`` added."""
    added = defect_rows(tables)
    return {name: df.unionByName(added[name]) for name, df in tables.items()}


def defect_rows(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The rows of ``DEFECTS`` alone, all of a table in one pass over it."""
    out = {}
    for name, df in tables.items():
        copies = [
            F.when(F.expr(condition), F.struct(*[F.expr(values.get(c, c)).cast(df.schema[c].dataType).alias(c) for c in df.columns]))
            for condition, values in DEFECTS[name]
        ]
        out[name] = df.select(F.explode(F.array_compact(F.array(*copies))).alias("_copy")).select("_copy.*")
    return out


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The five raw tables in the reference's registry order."""
    return {
        "customers": customers(spark, sf_dir),
        "subscriptions": subscriptions(spark, sf_dir),
        "invoices": invoices(spark, sf_dir),
        "product_events": product_events(spark, sf_dir),
        "support_tickets": support_tickets(spark, sf_dir),
    }
