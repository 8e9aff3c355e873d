"""Operator-level tests: coercion edge cases, ordering, skew handling, invariants."""

from __future__ import annotations

import os
import random
from decimal import Decimal

import duckdb
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.coerce import as_number, as_timestamp, null_tokens_to_null, round_half_away
from ledgerline.operators import billing, clean, contracts, marts, reports
from ledgerline.sources import driver_views as views
from ledgerline.sources.ingest import read_csv
from tests import brute_force

STR = T.StringType()


def _strings(spark, rows, cols):
    return spark.createDataFrame(rows, T.StructType([T.StructField(c, STR) for c in cols]))


def test_numeric_text_rules(spark):
    values = ["49", " 5 ", "1e3", "inf", "-inf", "1d", "5f", "1,000", "1_000", "0x10", "abc", None, "NaN", "-0.5"]
    df = _strings(spark, [(v,) for v in values], ["v"])
    got = [r["n"] for r in df.select(as_number(F.col("v"), STR).alias("n")).collect()]
    expected = [49.0, 5.0, 1000.0, float("inf"), float("-inf"), None, None, None, None, None, None, None, None, -0.5]
    assert got == expected


def test_null_tokens(spark):
    df = _strings(spark, [("NA",), ("n/a",), ("",), ("x",), ("None",), ("#N/A",)], ["v"])
    got = [r["v"] for r in df.select(null_tokens_to_null(F.col("v")).alias("v")).collect()]
    assert got == [None, None, None, "x", None, None]


def test_date_rules_midnight_and_strict_format(spark):
    rows = [("a", "2025-12-31"), ("b", "2025-12-31 10:00:00"), ("c", "2024"), ("d", "2023-12-31"), ("e", None)]
    df = _strings(spark, rows, ["id", "d"])
    issues = contracts.date_issues("t", df, "d", "id", "2024-01-01", "2025-12-31").collect()
    got = sorted((r["row_reference"], r["issue_type"]) for r in issues)
    assert got == [
        ("b", "date_above_max"),
        ("c", "invalid_date"),
        ("d", "date_below_min"),
        ("e", "invalid_date"),
    ]
    parsed = df.select(as_timestamp(F.col("d"), STR, "yyyy-MM-dd").alias("p")).collect()
    assert parsed[2]["p"] is None


def test_numeric_issue_bounds(spark):
    df = _strings(spark, [("a", "0"), ("b", "-1"), ("c", "x"), ("d", "3")], ["id", "v"])
    strict = sorted(
        (r["row_reference"], r["issue_type"], r["issue_detail"])
        for r in contracts.numeric_issues("t", df, "v", "id", 0, inclusive_min=False).collect()
    )
    assert strict == [
        ("a", "numeric_below_min", "Minimum 0.0"),
        ("b", "numeric_below_min", "Minimum 0.0"),
        ("c", "invalid_numeric", "Not numeric"),
    ]
    inclusive = {r["row_reference"] for r in contracts.numeric_issues("t", df, "v", "id", 0).collect()}
    assert inclusive == {"b", "c"}


def test_pattern_anchored_at_start_only(spark):
    df = _strings(spark, [("C-1234",), ("C-1234x",), ("xC-1234",), (None,)], ["k"])
    flagged = {r["row_reference"] for r in contracts.id_format_issues("t", df, "k", r"C-\d{4}").collect()}
    assert flagged == {"xC-1234", None}


def test_allowed_values_case_insensitive_null_invalid(spark):
    df = _strings(spark, [("1", "PAID"), ("2", "Paid "), ("3", None), ("4", "failed")], ["id", "s"])
    flagged = {r["row_reference"] for r in contracts.allowed_value_issues("t", df, "s", "id", ["paid", "Failed"]).collect()}
    assert flagged == {"2", "3"}


def test_duplicate_hot_key_is_chunked(spark):
    rows = [("hot",)] * 23 + [("a",), ("a",), ("b",)]
    df = _strings(spark, rows, ["k"])
    issues = contracts.duplicate_key_issues("t", df, "k", chunk_rows=5).collect()
    counts = {}
    for r in issues:
        counts[r["row_reference"]] = counts.get(r["row_reference"], 0) + 1
    assert counts == {"hot": 22, "a": 1}


def test_foreign_key_null_safe(spark):
    child = _strings(spark, [("1", "p1"), ("2", None), ("3", "zz")], ["id", "fk"])
    parent = _strings(spark, [("p1",)], ["pk"])
    missing = {r["row_reference"] for r in contracts.foreign_key_issues("c", child, "fk", "id", parent, "pk", "p").collect()}
    assert missing == {"2", "3"}
    parent_with_null = _strings(spark, [("p1",), (None,)], ["pk"])
    missing = {
        r["row_reference"]
        for r in contracts.foreign_key_issues("c", child, "fk", "id", parent_with_null, "pk", "p").collect()
    }
    assert missing == {"3"}


def test_keep_first_follows_file_order(spark, workdir):
    # One-row file a.csv, large file b.csv: ids alone would not give file order.
    a = os.path.join(workdir, "in", "a.csv")
    b = os.path.join(workdir, "in", "b.csv")
    os.makedirs(os.path.dirname(a))
    with open(a, "w") as fh:
        fh.write("k,v\nkey,first\n")
    with open(b, "w") as fh:
        fh.write("k,v\n" + "".join(f"key,later{i}\n" for i in range(2000)))
    raw = read_csv(spark, os.path.join(workdir, "in"))
    first = clean.keep_first(raw, "k").collect()
    assert [r["v"] for r in first] == ["first"]


def test_dedup_before_filter(spark):
    raw = _strings(
        spark,
        [("S-1", "C-1", "-10", "0"), ("S-1", "C-1", "49", "1"), ("S-2", "C-1", "49", "2")],
        ["subscription_id", "customer_id", "mrr", "_ingest_row"],
    )
    customers = _strings(spark, [("C-1",)], ["customer_id"])
    kept = clean.clean_subscriptions(raw, customers).collect()
    assert [r["subscription_id"] for r in kept] == ["S-2"]
    assert kept[0]["mrr"] == Decimal("49.00")
    rejected = sorted(
        (r["subscription_id"], r["mrr"], r["reject_reason"])
        for r in clean.rejected_rows("subscriptions", raw, customers).collect()
    )
    assert rejected == [("S-1", "-10", "not_positive"), ("S-1", "49", "duplicate_key")]


def test_results_independent_of_partitioning(spark):
    rows = [(f"I-{i % 37}", f"C-{i % 11}", f"2025-{1 + i % 12:02d}-01", f"{(i * 7) % 500 + 0.25}", ["paid", "failed"][i % 2]) for i in range(400)]
    raw = _strings(spark, rows, ["invoice_id", "customer_id", "invoice_month", "amount", "status"])
    customers = _strings(spark, [(f"C-{i}",) for i in range(11)], ["customer_id"])
    results = []
    for parts in (1, 4, 17):
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        shuffled = raw.repartition(parts)
        inv = clean.clean_invoices(shuffled, customers, dedup=True)
        results.append(sorted(tuple(r) for r in marts.mart_mrr(inv).collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert results[0] == results[1] == results[2]


def test_round_half_away_matches_duckdb(spark):
    rng = random.Random(7)
    values = [round(rng.uniform(-1000, 1000), 3) for _ in range(3000)]
    values += [1.005, 2.675, 0.125, -0.125, 1.0049999999999999, 149.335, 0.0, -2.5e-3]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    ours = [r["r"] for r in df.select(round_half_away(F.col("v"), 2).alias("r")).collect()]
    con = duckdb.connect()
    theirs = [con.execute("SELECT ROUND(?::DOUBLE, 2)", [v]).fetchone()[0] for v in values]
    assert ours == theirs


def test_fan_out_closed_form_equals_literal(spark):
    customers = _strings(spark, [("C1", "n1", "s"), ("C2", "n2", "s"), ("C3", "n3", "t")], ["customer_id", "customer_name", "segment"])
    invoices = spark.createDataFrame(
        [("C1", "paid", Decimal("10.50")), ("C1", "failed", Decimal("3.00")), ("C2", "paid", Decimal("7.25"))],
        "customer_id string, status string, amount decimal(18,2)",
    )
    events = _strings(spark, [("C1", "e1"), ("C1", "e2"), ("C1", "e3"), ("C3", "e4")], ["customer_id", "event_id"])
    tickets = _strings(spark, [("C1", "t1"), ("C1", "t2"), ("C2", "t3")], ["customer_id", "ticket_id"])
    closed = sorted(tuple(r) for r in marts.customer_health(customers, invoices, events, tickets, fan_out=True).collect())
    literal = sorted(tuple(r) for r in brute_force.customer_health_literal(customers, invoices, events, tickets).collect())
    assert closed == literal
    assert closed[0][3] == Decimal("63.00")  # 10.50 x 3 events x 2 tickets


def test_billing_schedule_bounds(spark):
    subs = spark.createDataFrame(
        [
            ("S1", "C1", "2025-01-15", None, Decimal("10")),
            ("S2", "C1", "2025-05-01", "2025-03-01", Decimal("10")),
            ("S3", "C1", "2025-11-30", "2026-04-01", Decimal("10")),
        ],
        "subscription_id string, customer_id string, start_date string, end_date string, mrr decimal(18,2)",
    ).select(
        "subscription_id", "customer_id", F.to_date("start_date").alias("start_date"), F.to_date("end_date").alias("end_date"), "mrr"
    )
    rows = billing.billing_schedule(subs, "2025-12-01").collect()
    per = {}
    for r in rows:
        per.setdefault(r["subscription_id"], []).append(str(r["billing_month"]))
    assert len(per["S1"]) == 12 and per["S1"][0] == "2025-01-01"
    assert "S2" not in per
    assert per["S3"] == ["2025-11-01", "2025-12-01"]


def test_top_customers_ties_by_id(spark):
    health = spark.createDataFrame(
        [("C3", "a", 5.0), ("C1", "a", 5.0), ("C2", "b", 9.0), ("C4", "a", None)],
        "customer_id string, segment string, health_score double",
    )
    top = [r["customer_id"] for r in reports.top_customers(health, ["a"], 2).collect()]
    assert top == ["C1", "C3"]
    assert [r["segment"] for r in reports.segments(health).collect()] == ["a", "b"]


def test_replicate_splits_hot_groups(spark):
    from ledgerline.functions.replicate import replicate

    df = spark.createDataFrame([("hot", 23), ("cold", 1)], "k string, n bigint")
    out = replicate(df, "n", chunk_rows=4)
    assert out.columns == ["k"]
    got = {r["k"]: r["c"] for r in out.groupBy("k").agg(F.count("*").alias("c")).collect()}
    assert got == {"hot": 23, "cold": 1}


def test_rejected_rows_identical_copies(spark):
    raw = _strings(
        spark,
        [("I-1", "C-1", "5", "paid")] * 4 + [("I-2", "C-9", "5", "paid"), ("I-3", "C-1", "0", "paid")],
        ["invoice_id", "customer_id", "amount", "status"],
    )
    customers = _strings(spark, [("C-1",)], ["customer_id"])
    rejected = sorted(
        (r["invoice_id"], r["reject_reason"]) for r in clean.rejected_rows("invoices", raw, customers, dedup=True).collect()
    )
    assert rejected == [
        ("I-1", "duplicate_key"),
        ("I-1", "duplicate_key"),
        ("I-1", "duplicate_key"),
        ("I-2", "missing_customer"),
        ("I-3", "not_positive"),
    ]


def test_null_keys_second_is_duplicate(spark):
    df = _strings(spark, [(None, "a", "0"), (None, "b", "1"), ("K", "c", "2")], ["k", "v", "_ingest_row"])
    kept = {r["k"]: r["v"] for r in clean.keep_first(df, "k").collect()}
    assert kept == {None: "a", "K": "c"}
    issues = contracts.duplicate_key_issues("t", df, "k").collect()
    assert [(r["row_reference"], r["issue_type"]) for r in issues] == [(None, "duplicate_key")]


def test_empty_table_scores_one(spark):
    from ledgerline.operators import quality

    empty = _strings(spark, [], ["id"])
    some = _strings(spark, [("1",), ("2",)], ["id"])
    issues = spark.createDataFrame([("b", "x", "1", "id", "d")], contracts.ISSUE_SCHEMA)
    rows = {r["table_name"]: r for r in quality.quality_summary({"a": empty, "b": some}, {"a": empty, "b": some}, issues).collect()}
    assert (rows["a"]["raw_rows"], rows["a"]["quality_score"]) == (0, 1.0)
    assert (rows["b"]["validation_issues"], rows["b"]["quality_score"]) == (1, 0.5)


def test_malformed_json_line(spark, workdir):
    import pytest

    from ledgerline.sources.ingest import read_jsonl

    path = os.path.join(workdir, "bad.jsonl")
    with open(path, "w") as fh:
        fh.write('{"event_id": "E-1", "customer_id": "C-1"}\n{not json\n')
    loose = read_jsonl(spark, path, columns=["event_id", "customer_id"])
    rows = loose.collect()
    assert len(rows) == 2 and rows[1]["_corrupt_record"] == "{not json"
    with pytest.raises(Exception):
        read_jsonl(spark, path, columns=["event_id", "customer_id"], strict=True).collect()


def test_semi_and_anti_joins_same_with_and_without_key_dedup(spark):
    """Broadcast path (keys as they are) and sort-merge path (keys
    deduplicated map-side) give the same rows, with a parent key repeated
    across most parent rows and null keys on both sides."""
    from ledgerline.sources import warehouse

    parent = _strings(spark, [("hot",)] * 300 + [("p1",), (None,), ("p2",)], ["customer_id"])
    child = _strings(
        spark,
        [(f"c{i}", k) for i, k in enumerate(["hot", "p1", None, "zz", "hot", "p9", None, "p2"] * 5)],
        ["id", "customer_id"],
    )
    no_null_parent = parent.filter(F.col("customer_id").isNotNull())

    def results():
        return (
            sorted(map(tuple, clean.drop_orphans(child, parent).collect()), key=str),
            sorted(map(tuple, clean.drop_orphans(child, no_null_parent).collect()), key=str),
            sorted(
                map(
                    tuple,
                    contracts.foreign_key_issues("c", child, "customer_id", "id", parent, "customer_id", "p").collect(),
                )
            ),
            sorted(map(tuple, warehouse.new_rows(child, child.filter(F.col("id") < "c2"), "id").collect())),
        )

    broadcast = results()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = results()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert broadcast == merged
    kept, kept_no_null, missing, _ = broadcast
    assert len(kept) == 30 and len(kept_no_null) == 20
    assert {r[2] for r in missing} == {f"c{i}" for i in range(40) if i % 8 in (3, 5)}


def test_checkpoint_root_requires_shared_folder_on_a_cluster():
    """Outside local mode an unset spark.checkpoint.dir is an error, never a
    machine-local temporary folder."""
    import pytest

    from ledgerline.session import checkpoint_root

    class Conf:
        def __init__(self):
            self.values = {}

        def get(self, key, default=None):
            return self.values.get(key, default)

        def set(self, key, value):
            self.values[key] = value

    class Context:
        def __init__(self, master):
            self.master = master
            self.dir = None

        def getCheckpointDir(self):
            return self.dir

        def setCheckpointDir(self, path):
            self.dir = path

    class Session:
        def __init__(self, master):
            self.conf = Conf()
            self.sparkContext = Context(master)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(Session("yarn"))
    shared = Session("spark://head:7077")
    shared.conf.set("spark.checkpoint.dir", "hdfs:///shared/ckpt")
    assert checkpoint_root(shared) == "hdfs:///shared/ckpt"
    assert shared.sparkContext.getCheckpointDir() == "hdfs:///shared/ckpt"
    local = Session("local[4]")
    assert os.path.isdir(checkpoint_root(local))


def test_rejected_invoices_without_dedup_are_the_failing_rows(spark):
    """Without dedup every invoice stands on its own: the rejected rows are
    exactly raw minus kept (as a multiset), found in one pass."""
    from collections import Counter

    rows = [
        ("I1", "C1", "10", "paid"),
        ("I1", "C1", "10", "paid"),  # identical copy: both kept
        ("I2", "C9", "5", "paid"),  # unknown customer
        ("I3", "C1", "0", "failed"),  # not positive
        ("I4", None, "abc", "paid"),  # unknown customer and not numeric
        ("I5", "C2", "-3", "paid"),
        ("I5", "C2", "-3", "paid"),  # two identical rejected copies
    ]
    raw = _strings(spark, rows, ["invoice_id", "customer_id", "amount", "status"])
    customers = _strings(spark, [("C1",), ("C2",), ("C2",)], ["customer_id"])
    rejected = clean.rejected_rows("invoices", raw, customers).collect()
    got = Counter((r["invoice_id"], r["customer_id"], r["amount"], r["status"], r["reject_reason"]) for r in rejected)
    assert got == Counter(
        {
            ("I2", "C9", "5", "paid", "missing_customer"): 1,
            ("I3", "C1", "0", "failed", "not_positive"): 1,
            ("I4", None, "abc", "paid", "missing_customer"): 1,
            ("I5", "C2", "-3", "paid", "not_positive"): 2,
        }
    )
    kept = clean.clean_invoices(raw, customers).count()
    assert kept + len(rejected) == len(rows)


def test_extra_columns_with_dots_in_their_names(spark, workdir):
    """Contracts allow extra raw columns; a header such as ``notes.v2`` is a
    plain name, not struct access, through ingest, cleaning and loading."""
    from ledgerline.sources import warehouse

    path = os.path.join(workdir, "subs.csv")
    with open(path, "w") as f:
        f.write("subscription_id,customer_id,mrr,notes.v2\n")
        f.write("S1,C1,10,first\nS1,C1,10,first\nS2,C1,-5,neg\nS3,C9,7,orphan\nS4,C1,3,ok\n")
    raw = read_csv(spark, path)
    customers = _strings(spark, [("C1",)], ["customer_id"])
    kept = clean.clean_subscriptions(raw, customers)
    assert kept.columns == ["subscription_id", "customer_id", "mrr", "notes.v2"]
    assert sorted((r["subscription_id"], r["notes.v2"]) for r in kept.collect()) == [("S1", "first"), ("S4", "ok")]
    rejected = clean.rejected_rows("subscriptions", raw, customers).collect()
    assert sorted((r["subscription_id"], r["notes.v2"], r["reject_reason"]) for r in rejected) == [
        ("S1", "first", "duplicate_key"),
        ("S2", "neg", "not_positive"),
        ("S3", "orphan", "missing_customer"),
    ]
    root = os.path.join(workdir, "wh")
    keys = {"t": "subscription_id"}
    assert warehouse.load(spark, {"t": kept.filter(F.col("subscription_id") == "S1")}, root, "full", keys) == {"t": 1}
    assert warehouse.load(spark, {"t": kept}, root, "incremental", keys) == {"t": 1}
    assert sorted(r["notes.v2"] for r in warehouse.read_table(spark, root, "t").collect()) == ["first", "ok"]


def test_csv_quotes_and_blanks_survive_a_round_trip(spark, workdir):
    from ledgerline.sources import export, ingest

    with open(f"{workdir}/in.csv", "w") as f:
        f.write('customer_id,customer_name,segment\nC-1,"Acme ""X"", Inc",SMB\nC-2,  padded  ,NA\n')
    rows = ingest.read_csv(spark, f"{workdir}/in.csv").select("customer_id", "customer_name", "segment")
    want = [("C-1", 'Acme "X", Inc', "SMB"), ("C-2", "  padded  ", None)]
    assert sorted(map(tuple, rows.collect())) == want
    export.write_csv(rows, f"{workdir}/out.csv", bounded=True)
    back = export.read_export(spark, f"{workdir}/out.csv", rows.schema)
    assert sorted(map(tuple, back.collect())) == want


def test_silver_dates_follow_the_contract_and_keep_fractions(spark):
    from ledgerline.operators import clean

    raw = spark.createDataFrame([("C-1", "31/12/2025"), ("C-2", "2025-01-02")], "customer_id string, signup_date string")
    contract = {"date_columns": {"signup_date": {"format": "dd/MM/yyyy"}}}
    out = clean.to_silver("customers", raw, contract).orderBy("customer_id").collect()
    assert [str(r["signup_date"]) for r in out] == ["2025-12-31", "2025-01-02"]
    events = spark.createDataFrame([("E-1", "2025-01-02T10:00:00.123"), ("E-2", "2025-01-02 10:00:00")], "event_id string, event_time string")
    out = clean.to_silver("product_events", events).orderBy("event_id").collect()
    assert [str(r["event_time"]) for r in out] == ["2025-01-02 10:00:00.123000", "2025-01-02 10:00:00"]


def test_incremental_load_refuses_to_lose_a_column(spark, workdir):
    import pytest

    from ledgerline.sources import warehouse

    old = spark.createDataFrame([("C-1", "a")], "customer_id string, customer_name string")
    new = spark.createDataFrame([("C-2", "b", "EU")], "customer_id string, customer_name string, region string")
    warehouse.load(spark, {"dim_customers": old}, workdir, "full")
    with pytest.raises(ValueError, match="region"):
        warehouse.load(spark, {"dim_customers": new}, workdir, "incremental")


def test_size_settings_of_any_unit():
    from ledgerline.functions.joins import size_conf

    assert size_conf("1t") == 1 << 40 and size_conf("2GB") == 2 << 30 and size_conf("-1") == -1


def test_money_keeps_its_digits_and_nothing_is_loaded_as_null(spark):
    raw = _strings(
        spark,
        [("I1", "C1", "2025-01-01", "10.005"), ("I2", "C1", "2025-01-01", "10.005"), ("I3", "C1", "2025-01-01", "0.004"),
         ("I4", "C1", "2025-01-01", "1e17"), ("I5", "C1", "2025-01-01", "1e30"), ("I6", "C1", "2025-01-01", "inf"),
         ("I7", "C1", "2025-01-01", "0")],
        ["invoice_id", "customer_id", "invoice_month", "amount"],
    )
    customers = _strings(spark, [("C1",)], ["customer_id"])
    kept = {r["invoice_id"]: r["amount"] for r in clean.clean_invoices(raw, customers).collect()}
    assert kept == {"I1": Decimal("10.005"), "I2": Decimal("10.005"), "I3": Decimal("0.004"), "I4": Decimal(10**17)}
    rejected = {r["invoice_id"]: r["reject_reason"] for r in clean.rejected_rows("invoices", raw, customers).collect()}
    assert rejected == {"I5": "not_storable", "I6": "not_storable", "I7": "not_positive"}
    two = clean.clean_invoices(raw.where("invoice_id IN ('I1', 'I2')"), customers).withColumn("status", F.lit("paid"))
    assert [r["mrr"] for r in marts.mart_mrr(two).collect()] == [Decimal("20.01")]


def test_csv_rows_with_surplus_fields_fail_and_short_rows_do_not(spark, workdir):
    import pytest

    for name, lines in {"short": "C-1,Plain,SMB\nC-2,Cut\n", "long": "C-1,Plain,SMB\nC-2,Plain,SMB,EXTRA\n",
                        "blank": "C-2,Plain,,EXTRA\n"}.items():
        with open(f"{workdir}/{name}.csv", "w") as f:
            f.write("customer_id,customer_name,segment\n" + lines)
    short = read_csv(spark, f"{workdir}/short.csv")
    assert short.columns[:3] == ["customer_id", "customer_name", "segment"]
    assert sorted(tuple(r)[:3] for r in short.collect()) == [("C-1", "Plain", "SMB"), ("C-2", "Cut", None)]
    assert short.count() == 2 and short.select("customer_id").count() == 2
    for name in ("long", "blank"):
        with pytest.raises(Exception, match="more fields than its header"):
            read_csv(spark, f"{workdir}/{name}.csv").select("customer_id").collect()


def test_keep_first_with_columns_that_have_no_order(spark):
    raw = spark.sql("SELECT * FROM VALUES ('k', 2, map('a', 1)), ('k', 1, map('b', 2)), ('l', 1, map('c', 3)) AS t(id, _ingest_row, tags)")
    assert sorted((r["id"], r["tags"]) for r in clean.keep_first(raw, "id", ["_ingest_row"]).collect()) == [
        ("k", {"b": 2}),
        ("l", {"c": 3}),
    ]


def test_a_schedule_dealt_by_customer_has_the_same_rows(spark):
    data = [(i, i % 9 if i % 10 else None, f"2025-{1 + i % 12:02d}-05", None) for i in range(60)]
    subs = spark.createDataFrame(data, "subscription_id long, customer_id long, start_date string, end_date string").select(
        "subscription_id", "customer_id", F.to_date("start_date").alias("start_date"), F.to_date("end_date").alias("end_date"),
        F.lit(Decimal("2.50")).alias("mrr"),
    )
    dealt = billing.billing_schedule(subs, "2025-12-01", 7)
    assert sorted(map(str, dealt.collect())) == sorted(map(str, billing.billing_schedule(subs, "2025-12-01").collect()))
    # No task holds the months of another's customers, however small the input is.
    assert dealt.rdd.getNumPartitions() == 7
    held = dealt.select("customer_id", F.spark_partition_id().alias("p")).distinct().collect()
    assert len(held) == 10 and len({r["p"] for r in held}) > 1


def test_defects_are_planted_in_one_pass(spark, tmp_path):
    rows = spark.range(400).select(
        F.when(F.col("id") % 5 > 0, F.col("id")).alias("event_id"), (F.col("id") % 30).alias("customer_id"), F.lit("F1").alias("feature")
    )
    rows.unionByName(rows.limit(100)).write.parquet(f"{tmp_path}/events")
    own = spark.read.parquet(f"{tmp_path}/events")
    found = views.defect_rows({"product_events": own})["product_events"]
    want = [
        own.where(condition).select(*[F.expr(values.get(c, c)).alias(c) for c in own.columns])
        for condition, values in views.DEFECTS["product_events"]
    ]
    assert sorted(map(str, found.collect())) == sorted(map(str, want[0].unionByName(want[1]).collect())) != []
    assert found._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
