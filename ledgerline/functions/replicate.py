"""Emit ``n`` copies of a row without putting a large ``n`` into one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.order import column

# A group's copies are produced in chunks of at most this many rows.
CHUNK_ROWS = 1_000_000


def replicate(df: DataFrame, count: str, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Each row of ``df`` repeated ``df[count]`` times (the column is dropped).

    Rows are first split into chunks of at most ``chunk_rows`` copies; the
    (small) chunk rows are hash-distributed over a fixed number of
    partitions, which AQE does not coalesce, and each chunk is expanded in
    its own task.  A row standing for a third of a 100 TB table is thus
    expanded by many tasks instead of one.
    """
    spark = df.sparkSession
    n = F.col(count).cast("bigint")
    chunks = df.select(
        "*",
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((n - 1) / chunk_rows))).alias("_chunk"),
    )
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    chunks = chunks.repartition(partitions, *[column(c) for c in df.columns if c != count], F.col("_chunk"))
    size = F.least(F.lit(chunk_rows).cast("bigint"), n - F.col("_chunk") * chunk_rows)
    keep = [column(c) for c in df.columns if c != count]
    return chunks.select(*keep, F.explode(F.sequence(F.lit(1).cast("bigint"), size)).alias("_copy")).select(*keep)
