"""A Merkle manifest of a table: leaves by source, trees of threes, and a proof for every row.

``H`` is the lowercase hex SHA-256 of its inputs, one after the other, digests
taken as hex text.  A leaf is the H of the fields of a row (``-`` for null,
otherwise byte count, ``:`` and value).  Leaves of a source ascend by id; every
three consecutive nodes (the last run may be shorter) become their H until one
is left, the subroot.  Subroots, by source, give the root in the same way.

1. Leaf hashes are made where the texts are read, so no text is shuffled.  Rows are
   numbered through a range partitioning by source and id, without gathering a
   source anywhere.
2. Levels are built one by one and written as parent-linked rows ``(id,
   parent, before, after)``: a node's siblings in its run, and the node that
   the run becomes.
3. A recursive query climbs from every leaf: each step joins the node reached,
   appends its siblings and folds the hash.  All rows of a source reach the
   same few upper nodes, so a node above ``spread`` leaves is stored once for every
   ``spread`` of them, and a row asks for one of these copies.  ``spread`` grows
   with the square root of the table, as does the largest group.
4. One aggregate puts the siblings of a leaf in order.

The recursion has no row limit, which the session's
``spark.sql.cteRecursionRowLimit`` (a million rows) would set; it is lifted
while the climb is written and then put back.

Nulls and edge cases: a null source is a source of its own, the first; a null
id comes first in its source and is never tampered with; rows with one source
and id are ordered by their leaf, and repeated rows are leaves of their own.  A
lone row is leaf, subroot and root, and its proof is the H of nothing.  An
empty table gives an empty table.  A column that is missing counts as null;
further columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.components import staged

ARITY = 3
#: Node ids: first leaf times this, plus the level (levels of the tree over sources from ``TOP`` on).
LEVELS, TOP = 128, 64
ROW_LIMIT = "spark.sql.cteRecursionRowLimit"

CLIMB = """
    WITH RECURSIVE climb(leaf_no, node, copies, level, siblings, hash) MAX RECURSION LEVEL 127 AS (
        SELECT leaf_no, parent, parent_copies, 0, concat(before, after), {fold}
        FROM {leaves}
        UNION ALL
        SELECT c.leaf_no, n.parent, n.parent_copies, c.level + 1, concat(n.before, n.after), {step}
        FROM climb c JOIN {nodes} n ON n.id = c.node AND n.copy = c.leaf_no % c.copies
    )
    SELECT leaf_no, level, siblings, CASE WHEN node = {root} THEN hash END AS folded FROM climb
"""


def leaf(fields: list[Column]) -> Column:
    """H of a row's fields."""
    text = lambda c: c.cast("string")
    size = lambda c: F.octet_length(text(c)).cast("string")
    return F.sha2(
        F.concat(*(F.coalesce(F.concat(size(c), F.lit(":"), text(c)), F.lit("-")) for c in fields)).cast("binary"), 256
    )


def numbered(rows: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """``rows`` with ``no`` (from 0, by group and order), ``first`` and ``size`` (least ``no`` and rows of the group).

    Ranges of rows are sorted, each counts its groups, and the counts before
    a range are added up over the small table of ranges and groups.
    """
    ranges = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    ranges = staged(
        ranges.withColumn("part", F.spark_partition_id()).withColumn("mark", F.monotonically_increasing_id()), name
    )
    # A group has one run in a range.
    runs = ranges.groupBy("part", group).agg(F.count("*").alias("n"), F.min("mark").alias("mark_0"))
    sums = runs.groupBy("part").agg(F.sum("n").alias("n"))
    # One row for each range of the partitioning.
    sums = sums.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    start = F.col("before") + F.col("mark_0") - F.min("mark_0").over(Window.partitionBy("part"))
    runs = runs.join(sums, "part").select("part", group, "n", "mark_0", start.alias("run_0"))
    own = Window.partitionBy(group)
    runs = staged(
        runs.select(
            F.col("part").alias("p"), F.col(group).alias("g"), "mark_0", "run_0", F.min("run_0").over(own).alias("first"),
            F.sum("n").over(own).alias("size"),
        ),
        f"{name}-runs",
    )
    return ranges.join(runs, (F.col("part") == F.col("p")) & F.col(group).eqNullSafe(F.col("g"))).select(
        *rows.columns, (F.col("run_0") + F.col("mark") - F.col("mark_0")).alias("no"), "first", "size"
    )


def joined(members: Column | str, form: str = "binary") -> Column:
    """The digests of an array of nodes, one after the other."""
    text = F.array_join(F.transform(members, lambda x: F.hex(x["hash"])), "")
    return F.unhex(text) if form == "binary" else text


def _up(size: Column) -> Column:
    return F.call_function("div", size + (ARITY - 1), F.lit(ARITY))


def _copies(leaves: Column, spread: int) -> Column:
    return F.call_function("div", leaves + (spread - 1), F.lit(spread))


def levels(base: DataFrame, code: int, name: str) -> tuple[list[DataFrame], DataFrame]:
    """The node rows of every level of the trees of ``base``, and the node that is left of each.

    ``base(tree, pos, size, id, first, leaves, hash, other)`` are the lowest
    nodes, ``other`` what is folded in place of a leaf's hash; ``code`` is the
    level that ids of the first level above them get.
    """
    linked, tops, level = [], [], base
    while True:
        tops.append(level.where("size = 1"))
        several = level.where("size > 1")
        if several.isEmpty():
            break
        member = F.struct("pos", "id", "first", "leaves", "hash", "other")
        runs = several.groupBy("tree", F.expr(f"pos div {ARITY}").alias("run")).agg(
            F.max("size").alias("size"), F.array_sort(F.collect_list(member)).alias("m")
        )
        runs = staged(
            runs.select(
                "tree",
                F.col("run").alias("pos"),
                _up(F.col("size")).alias("size"),
                (F.col("m")[0]["first"] * LEVELS + code).alias("id"),
                F.col("m")[0]["first"].alias("first"),
                F.aggregate("m", F.lit(0).cast("long"), lambda s, x: s + x["leaves"]).alias("leaves"),
                F.unhex(F.sha2(F.lower(joined("m", "hex")).cast("binary"), 256)).alias("hash"),
                "m",
            ),
            f"{name}-{code}",
        )
        each = runs.select(
            F.col("id").alias("parent"), F.col("leaves").alias("parent_leaves"), F.posexplode("m").alias("at", "x"), "m"
        )
        linked.append(
            each.select(
                F.col("x.id").alias("id"),
                F.col("x.leaves").alias("leaves"),
                "parent",
                "parent_leaves",
                F.col("x.other").alias("other"),
                joined(F.slice("m", F.lit(1), F.col("at"))).alias("before"),
                joined(F.slice("m", F.col("at") + 2, F.lit(ARITY))).alias("after"),
            )
        )
        level = runs.select("tree", "pos", "size", "id", "first", "leaves", "hash", F.lit(None).cast("binary").alias("other"))
        code += 1
    return linked, reduce(DataFrame.unionByName, tops)


def manifest(rows: DataFrame, fields: list[str], id: str, source: str, tampered: dict[str, Column]) -> DataFrame:
    """``(id, leaf, subroot, root, proof_sha256, folded_root, verified)`` for every row.

    ``tampered`` says which columns are read otherwise when a row is checked; the folded root is made from
    them, the leaves and siblings are those of the rows as they are.
    """
    spark = rows.sparkSession
    null = F.lit(None).cast("string")
    rows = rows.select(*(F.col(c) if c in rows.columns else null.alias(c) for c in dict.fromkeys([*fields, id, source])))
    changed = [tampered.get(c, F.col(c)) for c in fields]
    leaves = rows.select(
        F.col(source).alias("source"),
        F.col(id).alias("id"),
        F.unhex(leaf([F.col(c) for c in fields])).alias("hash"),
        F.unhex(leaf(changed)).alias("other"),
    )
    # Rows that are alike in all of this may change places.
    leaves = staged(leaves.withColumn("tie", F.monotonically_increasing_id()), "merkle-hashed")
    leaves = numbered(leaves, "source", ["id", "hash", "tie"], "merkle-leaves")
    leaves = staged(leaves.select("no", F.col("id").alias("row_id"), "hash", "other", "first", "size"), "merkle-numbered")
    n = leaves.count()
    spread = max(64, int(n**0.5) // 4)
    base = leaves.select(
        F.col("first").alias("tree"),
        (F.col("no") - F.col("first")).alias("pos"),
        "size",
        (F.col("no") * LEVELS).alias("id"),
        F.col("no").alias("first"),
        F.lit(1).cast("long").alias("leaves"),
        "hash",
        "other",
    )
    linked, subroots = levels(base, 1, "merkle-level")
    # A source of one row keeps its leaf, with what is folded in place of it.
    subroots = staged(subroots.select("tree", "id", "leaves", "hash", "other"), "merkle-subroots")
    ranked = numbered(
        subroots.select(F.lit(0).alias("all"), "tree", "id", "leaves", "hash", "other"), "all", ["tree"], "merkle-sources"
    )
    over, roots = levels(
        ranked.select(
            F.lit(0).cast("long").alias("tree"), F.col("no").alias("pos"), "size", "id", F.col("tree").alias("first"), "leaves", "hash",
            "other",
        ),
        TOP,
        "merkle-level",
    )
    nodes = reduce(DataFrame.unionByName, [*linked, *over]) if linked or over else None
    top = roots.select("id", "hash").first()
    root = F.lit(bytes(top["hash"]).hex()) if top else null
    own = leaves.select(
        "no", "row_id", "hash", "other", F.col("first").alias("f"), _copies(F.col("size"), spread).alias("copies")
    )
    spread_roots = subroots.select(
        F.col("tree").alias("f"), F.col("hash").alias("subroot"),
        F.explode(F.sequence(F.lit(0).cast("long"), _copies(F.col("leaves"), spread) - 1)).alias("copy"),
    )
    own = own.withColumn("copy", F.col("no") % F.col("copies")).join(spread_roots, ["f", "copy"])
    whole = own.select(
        F.col("no").alias("leaf_no"), "row_id", "hash", "subroot", F.lit(-1).alias("level"),
        F.lit(None).cast("binary").alias("siblings"), F.when(F.lit(n == 1), F.col("other")).alias("folded"),
    )
    if nodes is not None:
        stored = nodes.select(
            "id", "parent", _copies(F.col("parent_leaves"), spread).alias("parent_copies"), "before", "after", "leaves", "other"
        )
        is_leaf = F.col("id") % LEVELS == 0
        inner = stored.where(~is_leaf).select(
            "*", F.explode(F.sequence(F.lit(0).cast("long"), _copies(F.col("leaves"), spread) - 1)).alias("copy")
        )
        inner = staged(inner.drop("leaves", "other"), "merkle-nodes")
        first = stored.where(is_leaf).select(
            F.expr(f"id div {LEVELS}").alias("leaf_no"), "parent", "parent_copies", "before", "after", "other"
        )
        fold = "unhex(sha2(cast(lower(hex(concat({0}before, {1}, {0}after))) AS binary), 256))"
        limit = spark.conf.get(ROW_LIMIT, None)
        spark.conf.set(ROW_LIMIT, "-1")
        try:
            query = CLIMB.replace("{fold}", fold.format("", "other")).replace("{step}", fold.format("n.", "c.hash"))
            steps = spark.sql(query.replace("{root}", str(top["id"])), leaves=first, nodes=inner)
            steps = staged(steps, "merkle-climb")
        finally:
            if limit is None:
                spark.conf.unset(ROW_LIMIT)
            else:
                spark.conf.set(ROW_LIMIT, limit)
        whole = whole.unionByName(steps, allowMissingColumns=True)
    found = whole.groupBy("leaf_no").agg(
        F.max("row_id").alias("row_id"),
        F.max("hash").alias("hash"),
        F.max("subroot").alias("subroot"),
        F.collect_list(F.when(F.col("level") >= 0, F.struct("level", "siblings"))).alias("s"),
        F.max("folded").alias("folded"),
    )
    proof = F.array_join(F.transform(F.array_sort("s"), lambda x: F.hex(x["siblings"])), "")
    folded = F.lower(F.hex("folded"))
    return found.select(
        F.col("row_id").alias(id),
        F.lower(F.hex("hash")).alias("leaf"),
        F.lower(F.hex("subroot")).alias("subroot"),
        root.alias("root"),
        F.sha2(F.lower(proof).cast("binary"), 256).alias("proof_sha256"),
        folded.alias("folded_root"),
        (folded == root).alias("verified"),
    )
