"""Session construction and the shared scratch location.

On a cluster the shared folder comes from ``spark.checkpoint.dir``; it is only
set here when the session has none (local runs and tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

# Results depend on it (text dates and times are read in this zone), so it
# is set for every session.
SESSION_CONF = {"spark.sql.session.timeZone": "UTC"}

# Defaults for local runs (tests, tools, bench), as the plans were checked
# on local[8].  On a cluster every other setting comes from spark-submit:
# builder options would override the submitted ``--conf`` values, so these
# are only applied for an explicit local master.
LOCAL_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(
    master: str | None = None,
    app_name: str = "ledgerline",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_CONF)
    if master and master.startswith("local"):
        conf.update(LOCAL_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    When unset in a local session (tests, local runs), a private folder is
    created and registered both as the conf value and as the SparkContext
    checkpoint directory.  On a cluster a machine-local folder would not be
    shared by the executors, so an unset value is an error there.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"{CHECKPOINT_CONF} must name a folder shared by the cluster")
        root = tempfile.mkdtemp(prefix="ledgerline-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, root)
        spark.sparkContext.setCheckpointDir(root)
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location under the shared checkpoint folder."""
    return os.path.join(checkpoint_root(spark), "ledgerline", f"{name}-{uuid.uuid4().hex}")
