"""Dashboard queries: top customers in chosen segments, the segment list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def top_customers(health: DataFrame, segments: list[str] | None = None, n: int = 25) -> DataFrame:
    """The ``n`` healthiest customers of ``segments`` (all when None).

    ``orderBy().limit()`` plans as TakeOrderedAndProject: each task keeps its
    own top ``n`` and only those reach the final merge.  Ties are broken by
    customer id so the result is one fixed set.
    """
    rows = health if segments is None else health.filter(F.col("segment").isin(list(segments)))
    return rows.orderBy(F.col("health_score").desc_nulls_last(), F.col("customer_id").asc_nulls_last()).limit(n)


def segments(health: DataFrame) -> DataFrame:
    """The distinct segments, sorted."""
    return health.select("segment").distinct().orderBy(F.col("segment").asc_nulls_last())
