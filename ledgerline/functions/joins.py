"""The key side of semi and anti joins."""

from __future__ import annotations

import re

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UNBOUNDED = 1 << 62

_UNITS = {"": 1, "b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30, "gb": 1 << 30}
_UNITS |= {"t": 1 << 40, "tb": 1 << 40, "p": 1 << 50, "pb": 1 << 50}


def size_conf(value: str) -> int:
    """A Spark byte-size setting ("10485760b", "10MB", "-1") in bytes."""
    match = re.fullmatch(r"\s*(-?\d+)\s*([a-zA-Z]*)\s*", value)
    if not match or match.group(2).lower() not in _UNITS:
        raise ValueError(f"not a byte size: {value!r}")
    return int(match.group(1)) * _UNITS[match.group(2).lower()]


def broadcast_threshold(df: DataFrame) -> int:
    return size_conf(df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", "10MB"))


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of ``df`` (plan statistics only, no job).
    A stream, or a plan without statistics, counts as unbounded, which
    selects the sort-merge path that is safe at any size."""
    if df.isStreaming:
        return UNBOUNDED
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Py4JJavaError:
        return UNBOUNDED


def key_set(keys: DataFrame, probe: DataFrame | None = None) -> DataFrame:
    """The one-column parent key set for a null-safe semi or anti join of
    ``probe`` (one column: the child keys) against it.

    * Keys under the broadcast threshold: returned as they are.  The planner
      broadcasts them, and the broadcast hash relation holds a repeat once.
    * A large key set and a small probe (a micro-batch or a small
      incremental drop against the whole history): only keys that occur
      in the probe can matter.  They are found by a broadcast semi join of
      the keys against the probe, which is one pass over the key column
      without shuffling it.  The join itself then sees a small side, which
      AQE broadcasts at run time.
    * Both large: the join is a sort-merge join, where AQE can split a
      skewed child partition but not a hot parent key.  The keys are
      deduplicated first, with a map-side partial aggregate, so a key
      repeated across a third of the parent rows reaches the join as one
      row per task.
    """
    threshold = broadcast_threshold(keys)
    if estimated_bytes(keys) <= threshold:
        return keys
    if probe is not None and estimated_bytes(probe) <= threshold:
        k, p = keys.columns[0], probe.columns[0]
        wanted = probe.select(F.col(p).alias("_probe_key"))
        return keys.join(wanted, keys[k].eqNullSafe(wanted["_probe_key"]), "left_semi")
    return keys.distinct()
