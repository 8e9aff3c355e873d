"""Small catalog helpers: the plan dimension, table reads, existence tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# The plan dimension (plan, monthly_price, tier).
PLANS = [
    ("Starter", 49, 1),
    ("Growth", 149, 2),
    ("Scale", 399, 3),
]

PLAN_SCHEMA = T.StructType(
    [
        T.StructField("plan", T.StringType()),
        T.StructField("monthly_price", T.IntegerType()),
        T.StructField("tier", T.IntegerType()),
    ]
)


def dim_plans(spark: SparkSession) -> DataFrame:
    """The static three-row plan dimension."""
    return spark.createDataFrame(PLANS, PLAN_SCHEMA)


def _fs_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, hpath


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence on whatever file system the path names (HDFS, S3A, local)."""
    fs, hpath = _fs_path(spark, path)
    return bool(fs.exists(hpath))
