"""Cleaning raw tables into silver tables.

Cleaning is independent of the contract findings: a row with a bad id or an
unlisted status is reported and still loaded.  What cleaning removes:

* repeated keys, keeping the first copy in raw order (customers,
  subscriptions, events, tickets).  The repeat test looks at the whole raw
  table *before* any filter, so when the first copy is invalid the valid
  later copy is dropped as well;
* rows whose customer is not among the (deduplicated) customers;
* subscriptions with ``mrr <= 0`` and invoices with ``amount <= 0``
  (unparsable numbers count as not positive, and so do positive ones that
  silver money cannot hold: they are rejected, never loaded as null or zero).

"First copy" is the smallest row in ingest order per key.  It is an aggregate with a
map-side partial step, so a key that holds a third of the table is reduced
inside every task before the shuffle instead of landing whole in one task,
as a window would.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.coerce import as_date, as_money, as_number, as_text, as_timestamp
from ledgerline.functions.joins import key_set
from ledgerline.functions.order import CORRUPT, INGEST_COLUMNS, column, data_columns, ingest_order
from ledgerline.functions.replicate import replicate

# Silver column types per table: (dates, timestamps, money).
SILVER_TYPES = {
    "customers": (["signup_date"], [], []),
    "subscriptions": (["start_date", "end_date"], [], ["mrr"]),
    "invoices": (["invoice_month"], [], ["amount"]),
    "product_events": ([], ["event_time"], []),
    "support_tickets": (["opened_date"], [], []),
}

SILVER_NAMES = {
    "customers": "dim_customers",
    "subscriptions": "fact_subscriptions",
    "invoices": "fact_invoices",
    "product_events": "fact_product_events",
    "support_tickets": "fact_support_tickets",
}

DATE_FORMATS = ("yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss[.SSSSSS]", "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]")


def keep_first(df: DataFrame, key: str, order: list[str] | None = None) -> DataFrame:
    """One row per key, the one with the smallest ``order``.

    Null keys form one group, so a second null key is a repeat.  The key
    is the grouping column itself, so the result stays hash-partitioned on
    it and a later join or aggregate on the key reuses that shuffle.  Every
    column is shuffled once: the order columns lead the struct whose minimum
    is taken, the others follow (and settle ties of a partial order).
    """
    order = [c for c in (order or ingest_order(df)) if c != key]
    rest = [c for c in df.columns if c != key and c not in order]
    if not order and not rest:
        return df.select(column(key)).distinct()
    row = F.struct(*[column(c) for c in order + rest])
    if any(isinstance(df.schema[c].dataType, (T.MapType, T.VariantType)) for c in rest):
        # These types have no order, so they cannot be part of the minimum.
        first = df.groupBy(column(key)).agg(F.min_by(row, F.struct(*[column(c) for c in order])).alias("_first"))
    else:
        first = df.groupBy(column(key)).agg(F.min(row).alias("_first"))
    return first.select(*[column(key) if c == key else F.col("_first").getField(c).alias(c) for c in df.columns])


def _key_condition(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> tuple[Column, Column]:
    child_type = child.schema[child_key].dataType
    parent_type = parent.schema[parent_key].dataType
    if child_type != parent_type:
        return as_text(column(child_key), child_type), as_text(column(parent_key), parent_type)
    return column(child_key), column(parent_key)


def drop_orphans(
    df: DataFrame, parent: DataFrame, child_key: str = "customer_id", parent_key: str | None = None
) -> DataFrame:
    """Keep rows whose ``child_key`` occurs among the parent's keys.

    A null-safe semi join (a null child key is kept only when the parent has
    a null key).  The planner broadcasts the parent keys if their estimated
    size is under the broadcast threshold.  A small child against many parent
    keys first narrows the keys to those it holds; otherwise the join
    sort-merges, and the keys are deduplicated map-side first so a hot
    parent key cannot pile up in one task (``key_set``).
    """
    parent_key = parent_key or child_key
    child_value, parent_value = _key_condition(df, child_key, parent, parent_key)
    probe = df.withColumn("_child_key", child_value)
    keys = key_set(parent.select(parent_value.alias("_parent_key")), probe.select("_child_key"))
    kept = probe.join(keys, probe["_child_key"].eqNullSafe(keys["_parent_key"]), "left_semi")
    return kept.drop("_child_key")


def _positive(df: DataFrame, name: str) -> Column:
    """Positive as it is stored in silver."""
    return F.coalesce(as_money(column(name), df.schema[name].dataType) > 0, F.lit(False))


def to_silver(name: str, df: DataFrame, contract: Mapping[str, Any] | None = None) -> DataFrame:
    """Typed silver columns; ingest bookkeeping and the text of malformed JSON
    lines dropped.  A ``format`` that the contract gives for a date column is
    tried before the usual ones."""
    given = {c: (spec or {}).get("format") for c, spec in ((contract or {}).get("date_columns") or {}).items()}
    dates, stamps, money = SILVER_TYPES.get(name, ([], [], []))
    cols = []
    for c in data_columns(df):
        if c == CORRUPT:
            continue
        dtype = df.schema[c].dataType
        formats = (given[c], *DATE_FORMATS) if given.get(c) else DATE_FORMATS
        if c in dates:
            cols.append(as_date(column(c), dtype, formats).alias(c))
        elif c in stamps:
            if isinstance(dtype, (T.TimestampNTZType,)):
                cols.append(column(c))
            else:
                cols.append(as_timestamp(column(c), dtype, formats).cast("timestamp_ntz").alias(c))
        elif c in money:
            cols.append(as_money(column(c), dtype).alias(c))
        else:
            cols.append(column(c))
    return df.select(*cols)


# ----------------------------------------------------------------------------
# Cleaning plans over raw columns (kept raw so the rejected rows are their
# exact complement); ``clean_*`` add the silver typing.
# ----------------------------------------------------------------------------


def _kept_customers(raw: DataFrame, order: list[str] | None = None) -> DataFrame:
    return keep_first(raw, "customer_id", order)


def _kept_subscriptions(raw: DataFrame, customers: DataFrame, order: list[str] | None = None) -> DataFrame:
    first = keep_first(raw, "subscription_id", order)
    return drop_orphans(first.filter(_positive(first, "mrr")), customers)


def _kept_invoices(
    raw: DataFrame, customers: DataFrame, dedup: bool = False, order: list[str] | None = None
) -> DataFrame:
    rows = keep_first(raw, "invoice_id", order) if dedup else raw
    return drop_orphans(rows.filter(_positive(rows, "amount")), customers)


def _kept_by_key(raw: DataFrame, customers: DataFrame, key: str, order: list[str] | None = None) -> DataFrame:
    return drop_orphans(keep_first(raw, key, order), customers)


def clean_customers(raw: DataFrame, order: list[str] | None = None, contract: Mapping[str, Any] | None = None) -> DataFrame:
    """Customers with repeated ids removed (bad ids and dates stay)."""
    return to_silver("customers", _kept_customers(raw, order), contract)


def clean_subscriptions(raw: DataFrame, customers: DataFrame, order: list[str] | None = None, contract: Mapping[str, Any] | None = None) -> DataFrame:
    """First copy of each subscription, if it has a known customer and mrr > 0."""
    return to_silver("subscriptions", _kept_subscriptions(raw, customers, order), contract)


def clean_invoices(
    raw: DataFrame, customers: DataFrame, dedup: bool = False, order: list[str] | None = None, contract: Mapping[str, Any] | None = None
) -> DataFrame:
    """C4: invoices of known customers with amount > 0; no dedup unless asked."""
    return to_silver("invoices", _kept_invoices(raw, customers, dedup, order), contract)


def clean_events(raw: DataFrame, customers: DataFrame, order: list[str] | None = None, contract: Mapping[str, Any] | None = None) -> DataFrame:
    """First copy of each event of a known customer."""
    return to_silver("product_events", _kept_by_key(raw, customers, "event_id", order), contract)


def clean_tickets(raw: DataFrame, customers: DataFrame, order: list[str] | None = None, contract: Mapping[str, Any] | None = None) -> DataFrame:
    """First copy of each ticket of a known customer."""
    return to_silver("support_tickets", _kept_by_key(raw, customers, "ticket_id", order), contract)


def clean_tables(raw: dict[str, DataFrame], contracts: Mapping[str, Any] | None = None) -> dict[str, DataFrame]:
    """All silver tables keyed by their warehouse names (dim_plans included).

    The orphan filter only needs the set of customer keys, which is the same
    before and after customer dedup, so children are filtered against the
    raw customer keys and do not wait for (or recompute) the dedup aggregate.
    """
    from ledgerline.sources.tables import dim_plans

    customer_keys = raw["customers"].select("customer_id")
    spark = raw["customers"].sparkSession
    rules = contracts or {}
    return {
        "dim_customers": clean_customers(raw["customers"], contract=rules.get("customers")),
        "dim_plans": dim_plans(spark),
        "fact_subscriptions": clean_subscriptions(raw["subscriptions"], customer_keys, contract=rules.get("subscriptions")),
        "fact_invoices": clean_invoices(raw["invoices"], customer_keys, contract=rules.get("invoices")),
        "fact_product_events": clean_events(raw["product_events"], customer_keys, contract=rules.get("product_events")),
        "fact_support_tickets": clean_tickets(raw["support_tickets"], customer_keys, contract=rules.get("support_tickets")),
    }


#: The key whose first copy is kept; invoices only where asked.
KEYS = {
    "customers": "customer_id",
    "subscriptions": "subscription_id",
    "invoices": "invoice_id",
    "product_events": "event_id",
    "support_tickets": "ticket_id",
}
_AMOUNTS = {"subscriptions": "mrr", "invoices": "amount"}


def with_parent_flag(df: DataFrame, flag: str, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """``df`` with ``flag``: its ``child_key`` is not among the parent's keys (null-safe, as ``drop_orphans``)."""
    child_value, parent_value = _key_condition(df, child_key, parent, parent_key)
    known = parent.select(parent_value.alias("_parent_key")).distinct().withColumn("_known", F.lit(True))
    rows = df.withColumn("_child_key", child_value)
    rows = rows.join(known, rows["_child_key"].eqNullSafe(known["_parent_key"]), "left")
    return rows.withColumn(flag, F.col("_known").isNull()).drop("_child_key", "_parent_key", "_known")


def with_validity(name: str, raw: DataFrame, customers: DataFrame | None = None) -> DataFrame:
    """``raw`` with ``_missing`` (no such customer) and ``_valid`` (passes the row rules and has its customer)."""
    if name not in KEYS:
        raise ValueError(f"no cleaning rule for table {name!r}")
    amount = _AMOUNTS.get(name)
    if customers is not None and name != "customers":
        rows = with_parent_flag(raw, "_missing", customers, "customer_id", "customer_id")
    else:
        rows = raw.withColumn("_missing", F.lit(False))
    return rows.withColumn("_valid", ~F.col("_missing") & (_positive(raw, amount) if amount else F.lit(True)))


def first_order(name: str, raw: DataFrame, order: list[str] | None = None) -> Column:
    """What is smallest in the first copy of a key."""
    by = _identity(raw, order) or [c for c in [*(order or []), *ingest_order(raw)] if c != KEYS[name]]
    by = list(dict.fromkeys(by))
    return F.struct(*[column(c) for c in by]) if by else F.struct(F.lit(0).alias("_none"))


def flagged_rows(
    name: str,
    raw: DataFrame,
    customers: DataFrame | None = None,
    dedup: bool | None = None,
    order: list[str] | None = None,
) -> DataFrame:
    """``raw`` with what cleaning says of each row: ``_missing`` (no such customer), ``_valid`` (passes the row rules and
    has its customer), ``_repeated`` (its key occurs more than once) and ``_first`` (it is the copy that dedup looks at).

    Rows are shuffled once at most, for the customers, and not at all where their
    keys are broadcast: the first copy of a key is found over the order columns
    alone, and only keys that occur more than once are joined back.  Without
    order columns identical copies are all marked first.
    """
    rows, key = with_validity(name, raw, customers), KEYS.get(name)
    if not (dedup if name == "invoices" else True):
        return rows.withColumn("_repeated", F.lit(False)).withColumn("_first", F.lit(True))
    own = first_order(name, raw, order)
    repeats = raw.groupBy(column(key).alias("_key")).agg(F.min(own).alias("_least"), F.count(F.lit(1)).alias("_n"))
    repeats = repeats.where("_n > 1").drop("_n")
    return (
        rows.join(repeats, rows[f"`{key}`"].eqNullSafe(repeats["_key"]), "left")
        .withColumn("_repeated", F.col("_least").isNotNull())
        .withColumn("_first", ~F.col("_repeated") | own.eqNullSafe(F.col("_least")))
        .drop("_key", "_least")
    )


def _identity(raw: DataFrame, order: list[str] | None) -> list[str]:
    """The order columns up to those that together name a row; none where the rows were not ingested from files."""
    by = order or ingest_order(raw)
    if not set(INGEST_COLUMNS) <= set(by):
        return []
    return by[: max(by.index(c) for c in INGEST_COLUMNS) + 1]


def rejected_rows(
    name: str,
    raw: DataFrame,
    customers: DataFrame | None = None,
    dedup: bool | None = None,
    order: list[str] | None = None,
) -> DataFrame:
    """Raw rows that cleaning drops, each with a reason.

    Those are the flagged rows that are not valid or not the first copy of their
    key.  Rows of ingested files are told apart by their place; elsewhere one
    of several identical first copies is kept, so the copies of such rows
    (only they) are counted and all but one re-expanded in bounded chunks.  Reason, first that
    applies: ``missing_customer``, ``not_storable`` (a positive mrr / amount
    that silver money cannot hold), ``not_positive``, ``duplicate_key``.
    """
    rows = flagged_rows(name, raw, customers, dedup, order)
    amount = _AMOUNTS.get(name)
    reason = F.lit("duplicate_key")
    if amount:
        number = as_number(column(amount), raw.schema[amount].dataType)
        held = F.when(F.coalesce(number > 0, F.lit(False)), F.lit("not_storable")).otherwise(F.lit("not_positive"))
        reason = F.when(~_positive(raw, amount), held).otherwise(reason)
    reason = F.when(F.col("_missing"), F.lit("missing_customer")).otherwise(reason)
    kept = F.col("_valid") & F.col("_first")
    cols = [column(c) for c in raw.columns]
    if _identity(raw, order):
        rejected = rows.where(~kept)
    else:
        copies = rows.where(~kept | F.col("_repeated")).groupBy(*cols, "_missing", "_valid", "_first").agg(F.count(F.lit(1)).alias("_n"))
        rejected = replicate(copies.withColumn("_r", F.col("_n") - kept.cast("int")).drop("_n").where("_r > 0"), "_r")
    return rejected.select(*[column(c) for c in data_columns(raw)], reason.alias("reject_reason"))
