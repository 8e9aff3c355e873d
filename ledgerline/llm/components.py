"""Connected components of an edge table by repeated contraction.

Every round each node picks one of itself and its neighbours, edges are
rewritten to the picks, and edges inside one pick disappear.  Odd rounds pick
the smallest id, which takes a star into its centre at once; even rounds pick
the smallest hash (another hash each time), which halves chains whatever the
order of their ids.  A pick is an aggregate (combined before the shuffle), so a
hub with very many edges is not gathered anywhere; the joins that rewrite edges are sort-merge joins whose hot
keys AQE splits.  Each round is written below the shared checkpoint folder.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.session import scratch_path


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back: cuts the lineage."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``; ``root`` is one node of the component.

    Repeated edges, both directions of an edge and self-loops are allowed;
    edges with a null end are ignored.  No edges: no rows.
    """
    spark = edges.sparkSession
    base = scratch_path(spark, name)

    def stage(df: DataFrame, part: str) -> DataFrame:
        path = os.path.join(base, part)
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    edges = stage(edges.where("a IS NOT NULL AND b IS NOT NULL").select("a", "b").distinct(), "edges-0")
    labels = None
    turn = 0
    while labels is None or not edges.isEmpty():
        turn += 1
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        first = F.xxhash64 if turn % 2 == 0 else lambda *_: F.lit(0)
        drawn = lambda c: F.struct(first(F.lit(turn), F.col(c)).alias("h"), F.col(c).alias("x"))  # noqa: B023, E731
        lowest = both.groupBy(F.col("a").alias("node")).agg(F.min(drawn("b")).alias("other"))
        picks = stage(lowest.select("node", F.least(drawn("node"), "other")["x"].alias("root")), f"picks-{turn}")
        if labels is None:
            labels = picks
        else:
            nxt = picks.select(F.col("node").alias("root"), F.col("root").alias("next"))
            labels = stage(
                labels.join(nxt, "root", "left").select("node", F.coalesce("next", "root").alias("root")),
                f"labels-{turn}",
            )
        to_a = picks.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        to_b = picks.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        edges = stage(
            edges.join(to_a, "a")
            .join(to_b, "b")
            .where("ra <> rb")
            .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b"))
            .distinct(),
            f"edges-{turn}",
        )
    return labels
