"""Feature adoption per event-time window on a stream (extension).

Exact distinct counts are not supported on streams, so users and customers
are HyperLogLog++ estimates.  Late events are accepted up to the watermark.

The stream runs in ``update`` mode through ``foreachBatch``.  An epoch merges
its changed (window, feature) rows into those of the windows that are still
open.  Windows that ended before the watermark can get no more events: their rows are
appended once to the table, the others are written as its *open* part.  Both become visible with one
pointer, which also names the epoch, so an epoch that comes again adds nothing.

An epoch therefore reads and writes the open windows only, and
``latest_adoption`` reads every closed window once, however many epochs have
changed it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ledgerline.sources import warehouse

# Directories of closed windows are merged past this many files.
MAX_FILES = 512
# Epochs whose open windows are kept for readers that still hold them.
KEPT_EPOCHS = 20
KEYS = ["window_start", "window_end", "feature"]


def stream_feature_adoption(
    events: DataFrame,
    window: str = "1 day",
    watermark: str = "1 day",
    rsd: float = 0.05,
) -> DataFrame:
    """Events, approximate users and customers per (window, feature)."""
    timed = events.withColumn("_event_ts", F.col("event_time").cast("timestamp"))
    deduped = timed.withWatermark("_event_ts", watermark).dropDuplicatesWithinWatermark(["event_id"])
    grouped = deduped.groupBy(F.window("_event_ts", window).alias("_w"), "feature").agg(
        F.count(F.lit(1)).alias("events"),
        F.approx_count_distinct("user_id", rsd).alias("active_users"),
        F.approx_count_distinct("customer_id", rsd).alias("active_customers"),
    )
    return grouped.select(
        F.col("_w.start").cast("timestamp_ntz").alias("window_start"),
        F.col("_w.end").cast("timestamp_ntz").alias("window_end"),
        "feature",
        F.col("events").cast("bigint"),
        F.col("active_users").cast("bigint"),
        F.col("active_customers").cast("bigint"),
    )


def add_epoch(spark: SparkSession, path: str, changed: DataFrame, epoch: int, watermark: str, source: str) -> None:
    """Merge one epoch's changed rows; closed windows are appended, open ones replaced.

    A later event is at or after the start of the latest window, less the watermark's delay: windows that ended by
    then are closed.
    """
    root, name = path.rstrip("/").rsplit("/", 1)
    meta = warehouse.current(spark, root, name) if warehouse.table_exists(spark, root, name) else {}
    before = meta.get("stream")
    if before and before["source"] == source and epoch <= before["epoch"]:
        return
    values = [c for c in changed.columns if c not in KEYS]
    rows = changed.withColumn("_new", F.lit(1))
    if before:
        rows = rows.unionByName(_open(spark, meta).withColumn("_new", F.lit(0)))
    latest = rows.groupBy(*KEYS).agg(F.max_by(F.struct(*values), "_new").alias("_v"))
    merged = latest.select(*KEYS, *[F.col("_v").getField(c).alias(c) for c in values]).persist()
    try:
        # One row; windows are compared with it as text of the same zone.
        horizon = merged.agg((F.max("window_start") - F.expr(f"INTERVAL {watermark}")).alias("h")).first()["h"]
        closed = F.col("window_end") <= F.lit(horizon) if horizon is not None else F.lit(False)
        folder = f"{root}/{name}/_stream/open-{uuid.uuid4().hex}"

        def side() -> dict:
            merged.where(~closed).write.parquet(folder)
            return {"epoch": epoch, "source": source, "open": folder}

        warehouse.append_rows(spark, root, name, merged.where(closed), side)
        warehouse.compact(spark, root, name, MAX_FILES)
        warehouse.vacuum(spark, root, name, KEPT_EPOCHS)
    finally:
        merged.unpersist()


def _open(spark: SparkSession, meta: dict) -> DataFrame:
    return spark.read.schema(T.StructType.fromJson(meta["schema"])).parquet(meta["stream"]["open"])


def write_updates(
    stream: DataFrame, path: str, checkpoint: str, available_now: bool = True, watermark: str = "1 day"
) -> StreamingQuery:
    """Run ``stream`` in update mode into the table at ``path``; ``watermark`` is the delay that the stream was made with.

    A new checkpoint starts a new stream and needs a new ``path``.
    """

    def sink(batch: DataFrame, epoch: int) -> None:
        add_epoch(batch.sparkSession, path, batch, epoch, watermark, checkpoint)

    writer = stream.writeStream.outputMode("update").foreachBatch(sink).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def latest_adoption(spark: SparkSession, path: str) -> DataFrame:
    """The newest row of every (window, feature) written by ``write_updates``."""
    root, name = path.rstrip("/").rsplit("/", 1)
    meta = warehouse.current(spark, root, name)
    return warehouse.read_dirs(spark, root, name, meta["paths"]).unionByName(_open(spark, meta))
