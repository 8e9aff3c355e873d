"""Chat formatting with collapse of cumulative snapshots.

Logs often hold a conversation several times, each time with more turns.  A
conversation is dropped when it is a prefix of a longer one, and of equal
conversations the one with the smallest id stays.

Every turn gets a rolling hash of the conversation up to it: the running sum
of hashes of (position, role, text), kept twice with different seeds as exact
decimals.  A conversation's last hash, together with its length, occurs among
the inner turns of another conversation exactly when it is a prefix of that
one, so one anti-join finds the maximal conversations.

A conversation may hold any share of the rows.  Turns are dealt out by range
of (conversation, turn), each task sums its own part of a conversation, and
only conversations that cross a range border get offsets, at most one for each
border.  Rendering gathers at most ``PART_TURNS`` turns: a longer conversation
comes in several parts, which put together in order are the whole of it.

Nulls and edge cases: turns are ordered by turn number (null first), then
role, then hash; exact repeats of a row count once; a null text or role differs
from an empty one when conversations are compared, and is rendered as an empty
text or the role ``unknown``; rows with a null ``conv_id`` form one
conversation; marker openings ``<|`` inside a text are rendered as ``< |``.
Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.components import staged

PART_TURNS = 256


def _hash(seed: int, *columns: Column) -> Column:
    # xxhash64 skips nulls; the flags keep null and empty apart.
    flags = [c.isNull() for c in columns]
    return F.xxhash64(F.lit(seed), *flags, *columns)


def _offsets(blocks: DataFrame, values: list[str]) -> DataFrame:
    """Sums of ``values`` over a conversation's earlier blocks, for its second and later blocks."""
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = [F.sum(v).over(earlier).alias(f"before_{v}") for v in values]
    return blocks.select("conv_id", "block", *sums).where(F.col(f"before_{values[0]}").isNotNull())


def _shifted(rows: DataFrame, totals: list[Column], values: list[str]) -> DataFrame:
    """``rows`` with running ``values`` of blocks turned into those of conversations."""
    blocks = rows.groupBy("conv_id", "block").agg(*totals)
    before = _offsets(blocks, values).withColumnsRenamed({"conv_id": "conv_0", "block": "block_0"})
    same = F.col("block").eqNullSafe(F.col("block_0")) & F.col("conv_id").eqNullSafe(F.col("conv_0"))
    moved = rows.join(before, same, "left").drop("conv_0", "block_0")
    added = {v: F.col(v) + F.coalesce(F.col(f"before_{v}"), F.lit(0)) for v in values}
    return moved.withColumns(added).drop(*[f"before_{v}" for v in values])


def turn_prefixes(conversations: DataFrame) -> DataFrame:
    """``(conv_id, pos, prefix_1, prefix_2, row_1, row_2)`` for every distinct turn.

    ``pos`` counts from 1; the prefix hashes cover the turns up to it; the row
    hashes name the row in ``conversations``.
    """
    key = [F.col(c) for c in ("conv_id", "turn", "role", "text")]
    slim = conversations.select(
        "conv_id", "turn", "role",
        _hash(1, *key[2:]).alias("turn_1"), _hash(2, *key[2:]).alias("turn_2"),
        _hash(3, *key).alias("row_1"), _hash(4, *key).alias("row_2"),
    )
    order = ["turn", "role", "turn_1", "turn_2"]
    dealt = slim.repartitionByRange("conv_id", *order).withColumn("block", F.spark_partition_id())
    dealt = staged(dealt, "chat-turns")
    within = Window.partitionBy("block", "conv_id").orderBy(*order)
    again = (F.lag("row_1").over(within) == F.col("row_1")) & (F.lag("row_2").over(within) == F.col("row_2"))
    turns = dealt.withColumn("again", F.coalesce(again, F.lit(False))).where(~F.col("again")).drop("again")
    turns = turns.withColumn("pos", F.row_number().over(within).cast("long"))
    turns = _shifted(turns, [F.count("*").alias("pos")], ["pos"])
    for i in (1, 2):
        turns = turns.withColumn(f"prefix_{i}", F.xxhash64(F.lit(i), "pos", "turn_1", "turn_2").cast("decimal(38,0)"))
    turns = staged(turns, "chat-positions")
    sums = ["prefix_1", "prefix_2"]
    within = Window.partitionBy("block", "conv_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    running = turns.withColumns({s: F.sum(s).over(within).cast("decimal(38,0)") for s in sums})
    # The last running sum of a block is its total.
    totals = [F.max_by(s, "pos").alias(s) for s in sums]
    whole = _shifted(running, totals, sums)
    return staged(whole.select("conv_id", "pos", *sums, "row_1", "row_2"), "chat-prefixes")


def maximal(prefixes: DataFrame) -> DataFrame:
    """``(conv_id, n_turns, copies)`` of the conversations that are no prefix of another and first of their equals."""
    key = ["n_turns", "prefix_1", "prefix_2"]
    lengths = prefixes.groupBy("conv_id").agg(F.max("pos").alias("n_turns"))
    lengths = lengths.withColumnRenamed("conv_id", "conv_0")
    sized = prefixes.join(lengths, F.col("conv_id").eqNullSafe(F.col("conv_0"))).drop("conv_0")
    last = sized.where("pos = n_turns").groupBy(*key).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("copies"))
    inner = sized.where("pos < n_turns").select(F.col("pos").alias("n_turns"), "prefix_1", "prefix_2").distinct()
    return last.join(inner, key, "left_anti").select("conv_id", "n_turns", "copies")


def rendered_turn(role: Column, text: Column) -> Column:
    body = F.replace(F.coalesce(text, F.lit("")), F.lit("<|"), F.lit("< |"))
    return F.concat(F.lit("<|im_start|>"), F.coalesce(role, F.lit("unknown")), F.lit("\n"), body, F.lit("<|im_end|>\n"))


def format_conversations(conversations: DataFrame, part_turns: int = PART_TURNS) -> DataFrame:
    """``(conv_id, part, n_turns, copies, text)`` of the maximal conversations.

    ``part`` counts from 0 (conversations of up to ``part_turns`` turns have
    part 0 only), ``n_turns`` is the length of the whole conversation and
    ``copies`` the number of conversations equal to it, itself included.
    """
    prefixes = turn_prefixes(conversations)
    kept = maximal(prefixes).withColumnRenamed("conv_id", "conv_0")
    turns = prefixes.join(kept, F.col("conv_id").eqNullSafe(F.col("conv_0"))).select(
        "conv_id", "pos", "n_turns", "copies", "row_1", "row_2"
    )
    key = [F.col(c) for c in ("conv_id", "turn", "role", "text")]
    texts = conversations.select(
        _hash(3, *key).alias("row_1"), _hash(4, *key).alias("row_2"), rendered_turn(F.col("role"), F.col("text")).alias("text")
    ).dropDuplicates(["row_1", "row_2"])
    lines = turns.join(texts, ["row_1", "row_2"])
    part = F.floor((F.col("pos") - 1) / part_turns).cast("long")
    return (
        lines.groupBy("conv_id", part.alias("part"), "n_turns", "copies")
        .agg(F.array_sort(F.collect_list(F.struct("pos", "text"))).alias("turns"))
        .select("conv_id", "part", "n_turns", "copies", F.concat_ws("", F.col("turns.text")).alias("text"))
    )
