"""Keys that a stream has met, in hash buckets of bounded size.

The state is part of the pointer of the table that it belongs to, so rows and
keys become visible in one step.  It is a list of *runs*, directories
partitioned by ``_bucket``; a batch reads only the buckets its own keys
fall into.

* A bucket holds about ``BUCKET_KEYS`` keys however long the history: when
  there are more, the keys are dealt anew over twice as many buckets or more (each key
  is rewritten a bounded number of times on average).
* Runs are merged when ``FAN_IN`` of similar size have come together, so
  their number grows with the logarithm of the history.

So the keys that a batch reads depend on the number of its own keys, not on the
number of batches before it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.sources import warehouse

BUCKET_KEYS = 1 << 18
FAN_IN = 8
KEY, BUCKET = "_key", "_bucket"
_SCHEMA = T.StructType([T.StructField(KEY, T.StringType()), T.StructField(BUCKET, T.IntegerType())])


def empty() -> dict:
    return {"buckets": 1, "runs": []}


def _bucket(buckets: int):
    return F.pmod(F.xxhash64(KEY), F.lit(buckets).cast("long")).cast("int")


def _read(spark: SparkSession, runs: list[dict]) -> DataFrame:
    parts = [spark.read.schema(_SCHEMA).parquet(r["path"]) for r in runs]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _write(keys: DataFrame, path: str, buckets: int, unique: bool = False) -> dict | None:
    """One run of distinct keys (``unique``: they are already); None if there are none."""
    own = keys.select(F.col(keys.columns[0]).cast("string").alias(KEY))
    own = own if unique else own.distinct()
    rows = warehouse.observed_write(own.withColumn(BUCKET, _bucket(buckets)), path, "errorifexists", [BUCKET])
    return {"path": path, "rows": rows} if rows else None


def matching(spark: SparkSession, state: dict, probe: DataFrame) -> DataFrame:
    """The stored keys (one column, ``_key``) of all buckets that a key of ``probe``, one column, falls into."""
    runs = state["runs"]
    if not runs:
        return spark.createDataFrame([], f"{KEY} string")
    stored = _read(spark, runs)
    if state["buckets"] > 1:
        # At most one row for each bucket.
        wanted = probe.select(F.col(probe.columns[0]).cast("string").alias(KEY)).select(_bucket(state["buckets"]).alias("b"))
        stored = stored.where(F.col(BUCKET).isin([r["b"] for r in wanted.distinct().collect()]))
    return stored.select(KEY)


def _buckets(total: int, buckets: int) -> int:
    """Twice as many buckets until ``total`` keys fill them by half."""
    while buckets * BUCKET_KEYS < 2 * total:
        buckets *= 2
    return buckets


def added(
    spark: SparkSession, state: dict, keys: DataFrame, folder: str, unique: bool = False, expected: int = 0
) -> dict:
    """The state with the keys of ``keys``, one column; nothing that is stored is changed.

    ``unique`` says that no key of ``keys`` comes twice.  Without runs,
    ``expected`` keys get their buckets at once instead of being dealt anew.
    """
    fresh = lambda: f"{folder}/run-{uuid.uuid4().hex}"
    if not state["runs"] and expected > state["buckets"] * BUCKET_KEYS:
        state = {**state, "buckets": _buckets(expected, state["buckets"])}
    run = _write(keys, fresh(), state["buckets"], unique)
    runs = [*state["runs"], *([run] if run else [])]
    total = sum(r["rows"] for r in runs)
    if total > state["buckets"] * BUCKET_KEYS:
        buckets = _buckets(total, state["buckets"])
        return {"buckets": buckets, "runs": [_write(_read(spark, runs).select(KEY), fresh(), buckets)]}
    # The newest runs, as long as the one before is not much larger than all after it.
    start = max(0, len(runs) - 1)
    size = runs[start]["rows"] if runs else 0
    while start and runs[start - 1]["rows"] <= 2 * size:
        start -= 1
        size += runs[start]["rows"]
    if len(runs) - start >= FAN_IN:
        runs[start:] = [_write(_read(spark, runs[start:]).select(KEY), fresh(), state["buckets"])]
    return {"buckets": state["buckets"], "runs": runs}
