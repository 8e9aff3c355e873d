"""Streaming incremental load equals the batch pipeline; windowed adoption runs."""

from __future__ import annotations

import datetime
import os

import pytest
from pyspark.sql import functions as F

from ledgerline.plans import pipeline
from ledgerline.plans.settings import default_settings
from ledgerline.sources import warehouse
from ledgerline.streaming import adoption, state
from ledgerline.streaming import load as stream
from ledgerline.streaming.load import stream_load
from tests.fixture_data import CUSTOMERS, EVENTS, INVOICES, SUBSCRIPTIONS, TICKETS, write_events, write_fixture, write_lines

SILVER = ["dim_customers", "fact_subscriptions", "fact_invoices", "fact_product_events", "fact_support_tickets"]


def _rows(spark, root, name):
    return sorted(tuple(str(v) for v in r) for r in warehouse.read_table(spark, root, name).collect())


# "2k": the stored tables are over the broadcast threshold and the landed
# micro-batches under it, so stored and seen keys are narrowed to each
# batch's keys (and deduplicated where both sides are large); the seen-key
# tables are also compacted after every epoch.
@pytest.mark.parametrize("threshold", [None, "2k"])
def test_stream_equals_batch(spark, workdir, threshold, monkeypatch):
    if threshold:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        monkeypatch.setattr("ledgerline.streaming.load.MAX_FILES", 1)
        monkeypatch.setattr("ledgerline.streaming.state.BUCKET_KEYS", 2)
        monkeypatch.setattr("ledgerline.streaming.state.FAN_IN", 2)
    try:
        _stream_equals_batch(spark, workdir)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _stream_equals_batch(spark, workdir):
    land = {
        "customers": os.path.join(workdir, "land", "customers"),
        "subscriptions": os.path.join(workdir, "land", "subscriptions"),
        "invoices": os.path.join(workdir, "land", "invoices"),
        "product_events": os.path.join(workdir, "land", "product_events.jsonl"),
        "support_tickets": os.path.join(workdir, "land", "support_tickets"),
    }
    root = os.path.join(workdir, "wh")
    ck = os.path.join(workdir, "ck")
    # Drop 1: two customers; children whose customer is missing get parked.
    write_lines(f"{land['customers']}/part-0001.csv", CUSTOMERS[:3])
    write_lines(f"{land['subscriptions']}/part-0001.csv", SUBSCRIPTIONS[:4] + [SUBSCRIPTIONS[6]])
    write_lines(f"{land['invoices']}/part-0001.csv", INVOICES[:4])
    write_events(f"{land['product_events']}/part-0001.jsonl", EVENTS[:2])
    write_lines(f"{land['support_tickets']}/part-0001.csv", TICKETS)
    first = stream_load(spark, land, root, ck)
    assert first["dim_customers"] == 2
    # Drop 2: the rest.
    write_lines(f"{land['customers']}/part-0002.csv", [CUSTOMERS[0]] + CUSTOMERS[3:])
    write_lines(f"{land['subscriptions']}/part-0002.csv", [SUBSCRIPTIONS[0]] + SUBSCRIPTIONS[4:6] + SUBSCRIPTIONS[7:])
    write_lines(f"{land['invoices']}/part-0002.csv", [INVOICES[0]] + INVOICES[4:])
    write_events(f"{land['product_events']}/part-0002.jsonl", EVENTS[2:])
    stream_load(spark, land, root, ck)
    assert sum(stream_load(spark, land, root, ck).values()) == 0

    base = os.path.join(workdir, "batch")
    write_fixture(base)
    settings = default_settings(base)
    pipeline.run_pipeline(spark, settings, mode="full")
    for name in SILVER:
        assert _rows(spark, root, name) == _rows(spark, settings["warehouse"], name), name


def test_stream_adoption_windows(spark, workdir):
    src = os.path.join(workdir, "events")
    write_events(f"{src}/part-0001.jsonl", EVENTS)
    schema = "event_id string, customer_id string, user_id string, event_time string, feature string, event_type string"
    stream = spark.readStream.schema(schema).json(src).withColumn("event_time", F.to_timestamp("event_time"))
    out = os.path.join(workdir, "adoption")
    adoption.write_updates(adoption.stream_feature_adoption(stream), f"{out}/t", f"{out}/ck").awaitTermination()
    rows = {(str(r["window_start"])[:10], r["feature"]): r["events"] for r in adoption.latest_adoption(spark, f"{out}/t").collect()}
    assert rows == {
        ("2025-01-02", "Dashboard"): 1,
        ("2025-01-03", "Reports"): 1,
        ("2025-01-04", "Dashboard"): 1,
        ("2025-01-05", "Billing"): 1,
    }


SUBSCRIPTION = (
    "subscription_id string, customer_id string, plan string, start_date string, end_date string, status string, "
    "mrr string, _ingest_file string, _ingest_offset long, _ingest_row long"
)
CUSTOMER = (
    "customer_id string, customer_name string, segment string, country string, signup_date string, "
    "_ingest_file string, _ingest_offset long, _ingest_row long"
)


def _subscriptions(spark, ids, customer="C-1", mrr="10"):
    rows = [(i, customer, "Growth", "2025-01-01", None, "active", mrr, "f", 0, k) for k, i in enumerate(ids)]
    return spark.createDataFrame(rows, SUBSCRIPTION)


def _customers(spark, ids):
    return spark.createDataFrame([(i, "n", "SMB", "US", "2025-01-01", "g", 0, k) for k, i in enumerate(ids)], CUSTOMER)


def _failing_publish(monkeypatch, name):
    publish, calls = warehouse._publish, []

    def fail(spark, root, table, meta):
        if table == name and not calls:
            calls.append(table)
            raise RuntimeError("lost")
        return publish(spark, root, table, meta)

    monkeypatch.setattr(warehouse, "_publish", fail)


def test_a_batch_lost_before_its_pointer_has_done_nothing(spark, workdir, monkeypatch):
    stream.process_batch(spark, workdir, "customers", _customers(spark, ["C-1"]))
    stream.process_batch(spark, workdir, "subscriptions", _subscriptions(spark, ["S-1"]))
    _failing_publish(monkeypatch, "fact_subscriptions")
    batch = _subscriptions(spark, ["S-1", "S-2"]).unionByName(_subscriptions(spark, ["S-3"], customer="C-9"))
    with pytest.raises(RuntimeError, match="lost"):
        stream.process_batch(spark, workdir, "subscriptions", batch)
    assert warehouse.read_table(spark, workdir, "fact_subscriptions").count() == 1
    assert stream.process_batch(spark, workdir, "subscriptions", batch) == 1
    assert stream.process_batch(spark, workdir, "subscriptions", batch) == 0
    stream.process_batch(spark, workdir, "customers", _customers(spark, ["C-9"]))
    assert stream.retry_orphans(spark, workdir, "subscriptions") == 1
    assert stream.retry_orphans(spark, workdir, "subscriptions") == 0
    assert _rows(spark, workdir, "fact_subscriptions") == sorted(_rows(spark, workdir, "fact_subscriptions"))
    ids = [r["subscription_id"] for r in warehouse.read_table(spark, workdir, "fact_subscriptions").collect()]
    assert sorted(ids) == ["S-1", "S-2", "S-3"]


def test_rows_of_other_loads_are_met_by_the_stream(spark, workdir):
    stream.process_batch(spark, workdir, "customers", _customers(spark, ["C-1"]))
    stream.process_batch(spark, workdir, "subscriptions", _subscriptions(spark, ["S-0"], mrr="-1"))
    stored = warehouse.read_table(spark, workdir, "fact_subscriptions")
    typed = _subscriptions(spark, ["S-1"]).select(
        *[F.col(c).cast(stored.schema[c].dataType).alias(c) for c in stored.columns]
    )
    warehouse.load(spark, {"fact_subscriptions": typed}, workdir, "incremental")
    # Neither the loaded key nor the rejected one is taken; the first new one is.
    assert stream.process_batch(spark, workdir, "subscriptions", _subscriptions(spark, ["S-0", "S-1", "S-2"])) == 1
    assert stream.process_batch(spark, workdir, "subscriptions", _subscriptions(spark, ["S-1", "S-2", "S-3"])) == 1
    warehouse.load(spark, {"fact_subscriptions": typed}, workdir, "full")
    assert stream.process_batch(spark, workdir, "subscriptions", _subscriptions(spark, ["S-1", "S-2", "S-4"])) == 1


def test_key_state_deals_and_merges_runs(spark, workdir, monkeypatch):
    monkeypatch.setattr(state, "BUCKET_KEYS", 50)
    own, known = state.empty(), set()
    for epoch in range(12):
        keys = [f"k{epoch}-{i}" for i in range(30)] + ([None] if epoch == 3 else [])
        own = state.added(spark, own, spark.createDataFrame([(k,) for k in keys], "key string"), workdir)
        known |= set(keys)
    assert sum(r["rows"] for r in own["runs"]) == len(known) <= own["buckets"] * 50
    assert len(own["runs"]) <= 2 * state.FAN_IN
    probe = spark.createDataFrame([("k2-7",), ("k11-29",), (None,), ("new",)], "key string")
    found = {r[0] for r in state.matching(spark, own, probe).collect()}
    assert {"k2-7", "k11-29", None} <= found <= known and len(found) < len(known)


def test_keys_read_by_a_batch_do_not_grow_with_the_batches_before(spark, workdir, monkeypatch):
    monkeypatch.setattr(state, "BUCKET_KEYS", 200)
    monkeypatch.setattr(state, "FAN_IN", 2)
    own, read = state.empty(), []
    probe = spark.createDataFrame([("k0-1",), ("k1-5",)], "key string")
    for epoch in range(20):
        keys = spark.range(100).selectExpr(f"concat('k{epoch}-', id) AS key")
        own = state.added(spark, own, keys, workdir)
        read.append(state.matching(spark, own, probe).count())
    total = sum(r["rows"] for r in own["runs"])
    assert total == 2000
    # Two keys fall into two buckets at most, of 200 keys or so each.
    assert max(read[10:]) <= 2 * 300 and max(read[15:]) <= 1.5 * max(read[5:10])


def _adoption(spark, rows):
    schema = "window_start timestamp_ntz, window_end timestamp_ntz, feature string, events long, active_users long"
    day = lambda d: datetime.datetime(2025, 1, 1) + datetime.timedelta(days=d)
    return spark.createDataFrame([(day(d), day(d + 1), f, n, n) for d, f, n in rows], schema)


def test_epochs_read_open_windows_only_and_closed_ones_are_stored_once(spark, workdir, monkeypatch):
    path = f"{workdir}/t"
    want, opened = {}, []
    for epoch in range(12):
        # Every epoch changes its own day and the day before.
        changed = [(epoch, "a", epoch + 1), (epoch, "b", 1)] + ([(epoch - 1, "a", 100 + epoch)] if epoch else [])
        want.update({(d, f): n for d, f, n in changed})
        adoption.add_epoch(spark, path, _adoption(spark, changed), epoch, "1 day", "ck")
        meta = warehouse.current(spark, workdir, "t")
        opened.append(spark.read.parquet(meta["stream"]["open"]).count())
    # One that comes again changes nothing.
    adoption.add_epoch(spark, path, _adoption(spark, [(11, "a", 7)]), 11, "1 day", "ck")
    got = [(r["window_start"].day - 1, r["feature"], r["events"]) for r in adoption.latest_adoption(spark, path).collect()]
    assert sorted(got) == sorted((d, f, n) for (d, f), n in want.items())
    assert max(opened) <= 4 and warehouse.read_table(spark, workdir, "t").count() == len(want) - opened[-1]


def test_history_of_open_windows_is_bounded(spark, workdir, monkeypatch):
    monkeypatch.setattr(adoption, "KEPT_EPOCHS", 3)
    for epoch in range(8):
        adoption.add_epoch(spark, f"{workdir}/t", _adoption(spark, [(epoch, "a", 1)]), epoch, "1 day", "ck")
    assert len(os.listdir(os.path.join(workdir, "t", "_stream"))) == 3
    assert len([f for f in os.listdir(os.path.join(workdir, "t", "_pointers")) if f.endswith(".json")]) == 3
    assert adoption.latest_adoption(spark, f"{workdir}/t").count() == 8


def test_first_keys_are_dealt_into_their_buckets_once(spark, workdir, monkeypatch):
    monkeypatch.setattr("ledgerline.streaming.state.BUCKET_KEYS", 10)
    keys = spark.range(100).select(F.col("id").cast("string"))
    found = state.added(spark, state.empty(), keys, f"{workdir}/keys", True, 100)
    assert found["buckets"] >= 10 and [r["rows"] for r in found["runs"]] == [100]
    assert len(os.listdir(f"{workdir}/keys")) == 1
    held = state.matching(spark, found, keys.where("id < 7"))
    assert {str(i) for i in range(7)} <= {r[state.KEY] for r in held.collect()}


def test_rows_are_joined_to_their_customers_once(spark, workdir, monkeypatch):
    calls = []
    flagged = stream._with_customer
    monkeypatch.setattr(stream, "_with_customer", lambda *a: calls.append(a) or flagged(*a))
    places = {"_ingest_file": F.lit("f"), "_ingest_offset": F.lit(0), "_ingest_row": F.monotonically_increasing_id()}
    customers = spark.createDataFrame([("a", "n"), (None, "m")], "customer_id string, customer_name string").withColumns(places)
    stream.process_batch(spark, workdir, "customers", customers)
    events = spark.createDataFrame([("1", "a"), ("2", "b"), ("3", None)], "event_id string, customer_id string").withColumns(places)
    assert stream.process_batch(spark, workdir, "product_events", events) == 2 and len(calls) == 1
    assert [r["event_id"] for r in stream._parked(spark, stream._stream(spark, workdir, "product_events")).collect()] == ["2"]
    assert sorted(r[0] for r in warehouse.read_table(spark, workdir, "fact_product_events").select("event_id").collect()) == ["1", "3"]
