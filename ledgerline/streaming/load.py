"""Incremental load as Structured Streaming: landing files -> silver tables.

Each source table has a landing directory; new files are picked up by a file
stream and every micro-batch is cleaned and appended to the warehouse in
``foreachBatch``.  To give the same silver tables as the batch pipeline,
which re-reads every raw file on each run, the pointer of every silver table
also holds what its stream has to know (``state``):

* **keys**: every key that has arrived, in hash buckets.  A later copy of a key is a
  repeat even when the first copy was rejected (mrr <= 0), exactly like the
  batch "first copy in raw order, then filter" rule.
* **parked** rows: first copies whose customer was not loaded when they came.
  A batch only adds its own (of invoices, it takes those waiting along); ``retry_orphans``
  loads those whose customer has arrived since and leaves the others, so the
  parked rows are always those still waiting.

Rows, keys and parked rows of a batch become visible with one pointer: a batch
that is lost halfway has done nothing, and one that comes again finds its keys.
A batch reads the buckets of its own keys and customers, not the history.

Invoices keep the reference's rules: no dedup, only keys not yet stored are
appended (their keys are those of the stored rows).  Rows that other loads put
into a silver table are met by their keys too.  Customers stream first so their children see them.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.coerce import null_tokens_to_null
from ledgerline.functions.joins import key_set
from ledgerline.functions.order import column
from ledgerline.operators.clean import SILVER_NAMES, _positive, keep_first, to_silver, with_parent_flag
from ledgerline.plans.settings import DEFAULT_CONTRACTS
from ledgerline.sources import warehouse
from ledgerline.streaming import state


@dataclass(frozen=True)
class StreamTable:
    key: str
    dedup: bool = True
    positive: str | None = None
    needs_customer: bool = True


TABLES = {
    "customers": StreamTable("customer_id", needs_customer=False),
    "subscriptions": StreamTable("subscription_id", positive="mrr"),
    "invoices": StreamTable("invoice_id", dedup=False, positive="amount"),
    "product_events": StreamTable("event_id"),
    "support_tickets": StreamTable("ticket_id"),
}


# The directories of a silver table are merged past this many files since the last merge.
MAX_FILES = 512
# Runs of parked rows that may lie side by side.
MAX_PARKED = 64
# Marks rows without a customer; rows are joined to the customers once, and kept with it.
_WAITING = "_waiting"


def _stream(spark: SparkSession, root: str, table: str) -> dict:
    """What the pointer of the silver table holds for its stream."""
    name = SILVER_NAMES[table]
    meta = warehouse.current(spark, root, name) if warehouse.table_exists(spark, root, name) else {"paths": []}
    fresh = {"keeps_rejected": TABLES[table].dedup, "keys": None, "unindexed": meta["paths"], "parked": None}
    found = meta.get("stream") or fresh
    # A full load forgets the keys of a table without rejected ones.
    return found if found["keys"] is not None else {**found, "unindexed": meta["paths"], "keys": state.empty()}


def _folder(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{SILVER_NAMES[table]}/_stream"


def _unindexed(spark: SparkSession, root: str, table: str, stream: dict) -> DataFrame | None:
    """Keys of rows that did not come by this stream."""
    if not stream["unindexed"]:
        return None
    rows = warehouse.read_dirs(spark, root, SILVER_NAMES[table], stream["unindexed"])
    return rows.select(column(TABLES[table].key).cast("string").alias(state.KEY))


def _known_keys(spark: SparkSession, root: str, table: str, stream: dict, probe: DataFrame) -> DataFrame:
    """Keys of ``table`` (``state.KEY``) among which all those of the one-column ``probe`` that are known."""
    keys = state.matching(spark, stream["keys"], probe)
    others = _unindexed(spark, root, table, stream)
    return keys if others is None else keys.unionByName(others)


def _with_customer(spark: SparkSession, root: str, rows: DataFrame) -> DataFrame:
    """``rows`` with ``_WAITING``: whether their customer is not loaded."""
    probe = rows.select("customer_id")
    customers = _known_keys(spark, root, "customers", _stream(spark, root, "customers"), probe)
    return with_parent_flag(rows, _WAITING, key_set(customers, probe), "customer_id", state.KEY)


def _by_customer(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows whose customer is loaded, and the others."""
    return rows.where(~F.col(_WAITING)).drop(_WAITING), rows.where(_WAITING).drop(_WAITING)


def _parked(spark: SparkSession, stream: dict) -> DataFrame:
    own = stream["parked"]
    return spark.read.schema(T.StructType.fromJson(own["schema"])).parquet(*own["runs"])


def _park(rows: DataFrame, folder: str, earlier: list[str]) -> dict | None:
    path = f"{folder}/parked-{uuid.uuid4().hex}"
    runs = [*earlier, path] if warehouse.observed_write(rows, path, "errorifexists", []) else earlier
    return {"schema": json.loads(rows.schema.json()), "runs": runs} if runs else None


def _append(spark: SparkSession, root: str, table: str, stream: dict, rows: DataFrame, silver: DataFrame, parked) -> int:
    """Silver rows, the keys of ``rows`` (or of the silver rows, where only those count) and parked rows in one step."""
    spec = TABLES[table]
    if not spec.dedup:
        found = _known_keys(spark, root, table, stream, silver.select(spec.key))
        silver = warehouse.new_rows(silver, found.withColumnRenamed(state.KEY, spec.key), spec.key)

    def side() -> dict:
        keys = (rows if spec.dedup else silver).select(column(spec.key).cast("string").alias(state.KEY))
        others = _unindexed(spark, root, table, stream)
        # Kept rows are one of each key; the first keys are counted to be dealt into buckets only once.
        unique = spec.dedup and others is None
        expected = rows.count() if unique and not stream["keys"]["runs"] else 0
        keys = keys if others is None else keys.unionByName(others)
        known = state.added(spark, stream["keys"], keys, _folder(root, table), unique, expected)
        return {**stream, "keys": known, "unindexed": [], "parked": parked()}

    loaded = warehouse.append_rows(spark, root, SILVER_NAMES[table], silver, side)
    warehouse.compact(spark, root, SILVER_NAMES[table], MAX_FILES)
    return loaded


def process_batch(
    spark: SparkSession, root: str, table: str, batch: DataFrame, contract: Mapping[str, Any] | None = None
) -> int:
    """Clean one micro-batch of raw ``table`` rows and append the new silver rows."""
    spec = TABLES[table]
    stream = _stream(spark, root, table)
    rows = batch
    if spec.dedup:
        rows = keep_first(rows, spec.key)
        found = _known_keys(spark, root, table, stream, rows.select(spec.key))
        rows = warehouse.new_rows(rows, found.withColumnRenamed(state.KEY, spec.key), spec.key)
    earlier = (stream["parked"] or {"runs": []})["runs"]
    if not spec.dedup and earlier:
        # Copies of a key that load together are all kept, so those still waiting belong to the batch.
        rows, earlier = rows.unionByName(_parked(spark, stream)).dropDuplicates(), []
    if spec.needs_customer:
        rows = _with_customer(spark, root, rows)
    rows = rows.persist()
    try:
        if rows.isEmpty():
            return 0
        known = rows.filter(_positive(rows, spec.positive)) if spec.positive else rows
        parked = lambda: stream["parked"]
        if spec.needs_customer:
            known, waiting = _by_customer(known)
            parked = lambda: _park(waiting, _folder(root, table), earlier)
        return _append(spark, root, table, stream, rows, to_silver(table, known, contract), parked)
    finally:
        rows.unpersist()


def retry_orphans(spark: SparkSession, root: str, table: str, contract: Mapping[str, Any] | None = None) -> int:
    """Load parked rows whose customer has arrived since (no new files needed); the others stay parked."""
    spec = TABLES[table]
    stream = _stream(spark, root, table)
    if not stream["parked"]:
        return 0
    parked = _parked(spark, stream)
    # A batch without dedup that came again has parked its rows again.
    parked = keep_first(parked, spec.key) if spec.dedup else parked.dropDuplicates()
    parked = _with_customer(spark, root, parked).persist()
    known, waiting = _by_customer(parked)
    try:
        if known.isEmpty() and len(stream["parked"]["runs"]) <= MAX_PARKED:
            return 0
        left = lambda: _park(waiting, _folder(root, table), [])
        return _append(spark, root, table, stream, known, to_silver(table, known, contract), left)
    finally:
        parked.unpersist()


def _landing_stream(spark: SparkSession, path: str, columns: list[str], jsonl: bool, max_files: int) -> DataFrame:
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
    if jsonl:
        stream = reader.json(path)
    else:
        stream = reader.option("header", True).option("escape", '"').option("enforceSchema", False).csv(path)
        stream = stream.select(*[null_tokens_to_null(F.col(c)).alias(c) for c in columns], "_metadata")
    # The per-split row id is added per micro-batch (not allowed on a stream).
    return stream.select(
        *columns,
        F.col("_metadata.file_path").alias("_ingest_file"),
        F.col("_metadata.file_block_start").alias("_ingest_offset"),
    )


def stream_load(
    spark: SparkSession,
    landing: Mapping[str, str],
    root: str,
    checkpoint: str,
    contracts: Mapping[str, Any] = DEFAULT_CONTRACTS,
    max_files: int = 10_000,
) -> dict[str, int]:
    """Load every file that has landed since the last run, table by table.

    Each table's stream runs with ``trigger(availableNow=True)`` against its
    own checkpoint, customers first; then parked orphans are retried.
    A table's columns are its contract's ``required_columns`` and
    ``extra_columns``; a CSV file with others fails the load.
    A backlog is taken in micro-batches of ``max_files`` files, oldest first.
    Returns the rows appended per silver table in this run.
    """
    loaded: dict[str, int] = {}
    order = ["customers"] + [t for t in landing if t != "customers"]
    for table in order:
        if table not in landing:
            continue
        columns = [*contracts[table]["required_columns"], *contracts[table].get("extra_columns", [])]
        stream = _landing_stream(spark, landing[table], columns, str(landing[table]).rstrip("/").endswith("jsonl"), max_files)
        counts: list[int] = []

        def sink(batch: DataFrame, epoch: int, table: str = table, counts: list[int] = counts) -> None:
            rows = batch.withColumn("_ingest_row", F.monotonically_increasing_id())
            counts.append(process_batch(spark, root, table, rows, contracts[table]))

        query = (
            stream.writeStream.foreachBatch(sink)
            .option("checkpointLocation", f"{checkpoint.rstrip('/')}/{table}")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        if table != "customers":
            counts.append(retry_orphans(spark, root, table, contracts[table]))
        loaded[SILVER_NAMES[table]] = sum(counts)
    return loaded
