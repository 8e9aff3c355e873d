"""Sharding by a hierarchical weighted hash tree.

A tree has regions, racks and shards; the weight of an inner node is the sum
of its children's.  A key descends from the root: at each level every child
draws ``-ln(u) / weight`` with ``u`` from a hash of the key and the child's
path, and the smallest draw wins, so children get keys in proportion to their
weights.  A draw depends on the child's own path and weight only.  Raising a
weight therefore moves keys only into the subtrees that hold the raised leaf,
lowering it only out of them; all other draws, and the descents below them,
stay what they were.

``standard_tree(n)`` is the tree of ``n`` equal shards: the first eight in two
regions of two racks of two shards, every further shard in a region of its
own.  Going from ``n`` to ``n + 1`` shards (from eight on) adds one region and
touches no other weight, so keys move into the new shard only.

Slots number the rows of a shard without gaps.  Every task numbers its own
rows, the staged counts of (task, shard) are added up, and each row adds the
offset of its task: no shard is gathered anywhere.  Equal keys share a shard
(a null key is a key like any other) and get different slots; which of them
gets which is not defined.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.components import staged


@dataclass(frozen=True)
class Shard:
    """A leaf: its number and weight."""

    number: int
    weight: float = 1.0


@dataclass(frozen=True)
class Node:
    """A region or rack; names are unique among siblings and keep their keys when siblings come or go."""

    children: tuple[tuple[str, Node | Shard], ...]

    @property
    def weight(self) -> float:
        return sum(child.weight for _, child in self.children)


def standard_tree(n: int) -> Node:
    def rack(numbers):
        return Node(tuple((f"shard{i}", Shard(i)) for i in numbers))

    regions, base = [], min(n, 8)
    for r in range(0, base, 4):
        racks = [(f"rack{k}", rack(range(k, min(k + 2, base)))) for k in range(r, min(r + 4, base), 2)]
        regions.append((f"region{r}", Node(tuple(racks))))
    regions += [(f"region{i}", Node((("rack", rack([i])),))) for i in range(8, n)]
    return Node(tuple(regions))


def _draw(key: Column, path: str, weight: float) -> Column:
    # 53 bits of the hash as a number in (0, 1).
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(path), key), 11)
    return -F.ln((bits.cast("double") + 0.5) / float(1 << 53)) / F.lit(float(weight))


def shard_of(key: Column, tree: Node | Shard, path: str = "root") -> Column:
    """The shard number of a key; children of weight 0 get none."""
    if isinstance(tree, Shard):
        return F.lit(tree.number)
    children = [(f"{path}/{name}", child) for name, child in tree.children if child.weight > 0]
    if len(children) == 1:
        return shard_of(key, children[0][1], children[0][0])
    draws = F.array(
        *[F.struct(_draw(key, p, c.weight).alias("draw"), F.lit(i).alias("child")) for i, (p, c) in enumerate(children)]
    )
    won = F.array_min(draws)["child"]
    # Only the winner's subtree is evaluated.
    below = [shard_of(key, c, p) for p, c in children]
    return F.element_at(F.array(*below), won + 1) if all(isinstance(c, Shard) for _, c in children) else reduce(
        lambda case, x: case.when(won == x[0], x[1]), enumerate(below[1:], 1), F.when(won == 0, below[0])
    )


def with_slots(rows: DataFrame, shard: str = "shard", slot: str = "slot") -> DataFrame:
    """``rows`` with a gapless number from 0 within each shard."""
    kept = rows.columns
    schema = T.StructType([*rows.schema.fields, T.StructField("__task", T.IntegerType()), T.StructField("__nth", T.LongType())])

    def number(batches):
        task, seen = TaskContext.get().partitionId(), {}
        for batch in batches:
            own = np.asarray(batch[shard])
            nth = np.empty(len(own), dtype=np.int64)
            for s in np.unique(own).tolist():
                at = np.flatnonzero(own == s)
                nth[at] = seen.get(s, 0) + np.arange(len(at))
                seen[s] = seen.get(s, 0) + len(at)
            columns = [*batch.columns, pa.array(np.full(len(own), task, dtype=np.int32)), pa.array(nth)]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    numbered = staged(rows.mapInArrow(number, schema), "shard-rows")
    sizes = numbered.groupBy("__task", shard).agg(F.count("*").alias("__n"))
    before = Window.partitionBy(shard).orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__task", shard, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"))
    return numbered.join(offsets, ["__task", shard]).select(*kept, (F.col("__offset") + F.col("__nth")).alias(slot))


def assign(documents: DataFrame, n: int) -> DataFrame:
    """``(doc_id, size, text_crc32, shard, grown_shard, slot)`` for ``documents(doc_id, text)``.

    ``size`` is the UTF-8 length of the text plus one; a null text is empty.
    """
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = documents.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        shard_of(F.col("doc_id"), standard_tree(n)).alias("shard"),
        shard_of(F.col("doc_id"), standard_tree(n + 1)).alias("grown_shard"),
    )
    return with_slots(rows)


def write_shards(documents: DataFrame, path: str, tree: Node, key: str = "doc_id") -> None:
    """Write ``documents`` as one Parquet folder ``shard=<number>`` for each shard."""
    documents.withColumn("shard", shard_of(F.col(key), tree)).write.partitionBy("shard").parquet(path)
