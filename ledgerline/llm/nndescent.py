"""Approximate nearest neighbours: NN-descent graph, greedy graph search.

Build
    Equal vectors are one node (its id is the smallest vec_id).  Nodes are dealt
    to shards by hash; a shard's vectors and neighbour lists are packed arrays.
    A first graph comes from neighbours in two orders by random hyperplanes.
    Then, for a few rounds, every node gathers its neighbours and the nearest
    ``REVERSE`` of the nodes that list it, all pairs of these are compared, and
    a pair is sent to whichever end it improves (neighbours of neighbours are
    neighbours).  Messages travel between shards by shuffles; vectors are sent
    once for each pair of shards, and improvements are cut to the best ``K`` of
    a node before they are sent, which loses nothing that the receiver would
    keep; links back to a hub are cut to the nearest ``REVERSE`` likewise.  A hub's
    reverse list is the one thing cut short; its other links are still followed
    from their other ends.

Search
    Every query walks the graph from a few entry nodes (and its own node if the
    index holds it), expanding the ``WIDTH`` nearest unexpanded nodes of its
    beam of ``EF`` nodes per round, until none is left.  Distances are Euclidean in
    double precision on the original vectors.  Queries and shards exchange
    messages by shuffles; the state of a query is as large as what it visited.
    The entry nodes are broadcast, and a shard that many queries ask answers in
    groups of about ``QUESTIONS``, each with the shard's rows.

Nulls and edge cases: rows with a null id, and vectors that are null, zero,
of another length than most, or hold null or non-finite components, take no
part, neither as query nor as candidate.  A repeated row counts once.  Equal
distances are ordered by vec_id; of equal vectors all that can be among the
``top`` are returned.  Fewer candidates than ``top``: all that are found.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.components import staged

K = 32
REVERSE = 32
ROUNDS = 4
EF = 512
WIDTH = 96
ENTRIES = 16
CHUNK = 128
QUERIES_PER_BUCKET = 32
QUESTIONS = 4096
SHARD_BYTES = 2 << 20

# Packed arrays between shards; what x, y, z and w hold depends on the kind.
MESSAGE = "shard int, kind int, x binary, y binary, z binary, w binary"
NAMES = ["shard", "kind", "x", "y", "z", "w"]
GRAPH, UPDATES, REQUEST, REPLY, LISTS, VECTORS = range(6)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.int64).view(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shard_of(nodes: np.ndarray, shards: int) -> np.ndarray:
    return (_mixed(nodes) % np.uint64(shards)).astype(np.int32)


def _table(rows: list[tuple]) -> pa.Table:
    kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 4]
    columns = list(zip(*rows)) if rows else [[]] * 6
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=NAMES)


def _row(shard: int, kind: int, *parts: np.ndarray) -> tuple:
    packed = [np.ascontiguousarray(p).tobytes() for p in parts]
    return (int(shard), kind, *packed, *[b""] * (4 - len(packed)))


def _rows(table: pa.Table, kind: int) -> list[dict]:
    own = table.filter(pa.compute.equal(table["kind"], kind))
    return own.to_pylist()


def _i8(x: bytes) -> np.ndarray:
    return np.frombuffer(x, dtype="<i8")


def _f4(x: bytes) -> np.ndarray:
    return np.frombuffer(x, dtype="<f4")


def best(a: np.ndarray, c: np.ndarray, d: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every ``a`` the ``k`` distinct ``c`` with the smallest ``d``, in that order."""
    order = np.lexsort((d, c, a))
    a, c, d = a[order], c[order], d[order]
    new = np.ones(len(a), dtype=bool)
    new[1:] = (a[1:] != a[:-1]) | (c[1:] != c[:-1])
    a, c, d = a[new], c[new], d[new]
    order = np.lexsort((c, d, a))
    a, c, d = a[order], c[order], d[order]
    starts = np.flatnonzero(np.concatenate(([True], a[1:] != a[:-1]))) if len(a) else np.zeros(0, int)
    rank = np.arange(len(a)) - np.repeat(starts, np.diff(np.append(starts, len(a))))
    return a[rank < k], c[rank < k], d[rank < k]


def _updates(a: np.ndarray, c: np.ndarray, d: np.ndarray, shards: int, k: int) -> list[tuple]:
    """Messages that offer ``c`` at ``d`` to ``a``, cut to the best ``k``; lists of each ``a`` in turn."""
    a, c, d = best(a, c, d, k)
    to = shard_of(a, shards)
    out = []
    order = np.argsort(to, kind="stable")
    for part in np.split(order, np.flatnonzero(np.diff(to[order])) + 1):
        if len(part):
            own, counts = np.unique(a[part], return_counts=True)
            out.append(_row(to[part[0]], UPDATES, own, counts.astype("<i4"), c[part], d[part].astype("<f4")))
    return out


def _offers(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    a, c, d = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.float32)]
    for r in _rows(table, UPDATES):
        a.append(np.repeat(_i8(r["x"]), np.frombuffer(r["y"], dtype="<i4")))
        c.append(_i8(r["z"]))
        d.append(_f4(r["w"]))
    return np.concatenate(a), np.concatenate(c), np.concatenate(d)


def _merge(k: int):
    """The graph of a shard from its graph so far and offers."""

    def merge(table: pa.Table) -> pa.Table:
        (own,) = _rows(table, GRAPH)
        nodes, nbrs, dists = _i8(own["x"]), _i8(own["y"]), _f4(own["z"])
        a, c, d = _offers(table)
        known = nbrs >= 0
        a = np.concatenate((a, np.repeat(nodes, k)[known]))
        c, d = np.concatenate((c, nbrs[known])), np.concatenate((d, dists[known]))
        a, c, d = best(a, c, d, k)
        row = np.searchsorted(nodes, a)
        first = np.searchsorted(row, np.arange(len(nodes)))
        col = np.arange(len(a)) - first[row]
        nbrs, dists = np.full((len(nodes), k), -1, dtype="<i8"), np.full((len(nodes), k), np.inf, dtype="<f4")
        nbrs[row, col], dists[row, col] = c, d
        return _table([_row(own["shard"], GRAPH, nodes, nbrs, dists)])

    return merge


def _reverse(shards: int, k: int, reverse: int):
    """Every edge as an offer to its other end, of a shard's to one node the ``reverse`` nearest."""

    def send(batches):
        for batch in batches:
            for r in batch.to_pylist():
                nodes, nbrs, dists = _i8(r["x"]), _i8(r["y"]), _f4(r["z"])
                known = nbrs >= 0
                out = _updates(nbrs[known], np.repeat(nodes, k)[known], dists[known], shards, reverse)
                yield from _table(out).to_batches()

    return send


def _gather(shards: int, k: int, reverse: int):
    """Lists of each node's neighbours both ways, and requests for the vectors in them."""

    def gather(table: pa.Table) -> pa.Table:
        (own,) = _rows(table, GRAPH)
        nodes, nbrs = _i8(own["x"]), _i8(own["y"]).reshape(-1, k)
        a, c, _ = best(*_offers(table), reverse)
        row = np.searchsorted(nodes, a)
        first = np.searchsorted(row, np.arange(len(nodes)))
        lists = np.full((len(nodes), k + reverse), -1, dtype="<i8")
        lists[:, :k] = nbrs
        lists[row, k + np.arange(len(a)) - first[row]] = c
        out = [_row(own["shard"], LISTS, nodes, lists)]
        wanted = np.unique(lists[lists >= 0])
        to = shard_of(wanted, shards)
        for s in np.unique(to).tolist():
            out.append(_row(s, REQUEST, wanted[to == s], np.array([own["shard"]], dtype="<i4")))
        return _table(out)

    return gather


def _reply(dims: int, k: int):
    """Vectors and farthest listed distances of requested nodes."""

    def reply(table: pa.Table) -> pa.Table:
        (vectors,), (graph,) = _rows(table, VECTORS), _rows(table, GRAPH)
        nodes, vecs = _i8(vectors["x"]), np.frombuffer(vectors["y"], dtype="<f8").reshape(-1, dims)
        limit = _f4(graph["z"]).reshape(-1, k)[:, -1]
        out = []
        for r in _rows(table, REQUEST):
            at = np.searchsorted(nodes, _i8(r["x"]))
            to = int(np.frombuffer(r["y"], dtype="<i4")[0])
            out.append(_row(to, REPLY, _i8(r["x"]), vecs[at].astype("<f4"), limit[at]))
        return _table(out)

    return reply


def _compare(dims: int, shards: int, k: int):
    """All pairs in each list, as offers to the ends that they improve."""

    def compare(table: pa.Table) -> pa.Table:
        replies = _rows(table, REPLY)
        ids = np.concatenate([_i8(r["x"]) for r in replies] or [np.zeros(0, np.int64)])
        order = np.argsort(ids)
        ids = ids[order]
        vecs = np.concatenate([_f4(r["y"]).reshape(-1, dims) for r in replies] or [np.zeros((0, dims), "f4")])[order]
        limit = np.concatenate([_f4(r["z"]) for r in replies] or [np.zeros(0, "f4")])[order]
        squares = np.einsum("ij,ij->i", vecs, vecs)
        held: list[tuple] = []
        size = 0
        for r in _rows(table, LISTS):
            lists = _i8(r["y"]).reshape(len(_i8(r["x"])), -1)
            at = np.searchsorted(ids, lists).clip(0, max(len(ids) - 1, 0))
            for i in range(0, len(lists), 128):
                own, ok = at[i : i + 128], lists[i : i + 128] >= 0
                if not ok.any():
                    continue
                x = vecs[own]
                d = squares[own][:, :, None] + squares[own][:, None, :] - 2 * (x @ x.transpose(0, 2, 1))
                better = d < limit[own][:, :, None] ** 2
                better &= ok[:, :, None] & ok[:, None, :] & (own[:, :, None] != own[:, None, :])
                b, p, q = np.nonzero(better)
                held.append((own[b, p], own[b, q], np.sqrt(np.maximum(d[b, p, q], 0))))
                size += len(b)
                if size > 3_000_000:
                    held = [best(*(np.concatenate(c) for c in zip(*held)), k)]
                    size = len(held[0][0])
        if not held:
            return _table([])
        a, c, d = (np.concatenate(x) for x in zip(*held))
        return _table(_updates(ids[a], ids[c], d, shards, k))

    return compare


def _by_shard(rows: DataFrame, function) -> DataFrame:
    return rows.groupBy("shard").applyInArrow(function, MESSAGE)


@dataclass
class Index:
    """Staged tables of one index."""

    dims: int
    shards: int
    members: DataFrame
    vectors: DataFrame
    lists: DataFrame
    entries: list[int]


def clean(embeddings: DataFrame) -> tuple[DataFrame, int]:
    """``(vec_id, vec)`` of the usable rows, packed as doubles, and their length."""
    own = embeddings.where("vec_id IS NOT NULL AND embedding IS NOT NULL").select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("e")
    )
    own = own.where("size(e) > 0")
    sizes = own.groupBy(F.size("e").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    dims = sizes[0]["n"] if sizes else 1

    def pack(batches):
        for batch in batches:
            lists = batch["e"]
            ids, packed = [], []
            for i, x in zip(batch["vec_id"].to_pylist(), lists):
                values = x.values
                if len(values) == dims and not values.null_count:
                    v = values.to_numpy(zero_copy_only=False).astype("<f8") + 0.0
                    if np.isfinite(v).all() and v.any():
                        ids.append(i)
                        packed.append(v.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(packed, pa.binary())], ["vec_id", "vec"])

    return own.mapInArrow(pack, "vec_id long, vec binary").dropDuplicates(["vec_id", "vec"]), dims


def _starting_offers(vectors: DataFrame, dims: int, shards: int, k: int, seed: int) -> DataFrame:
    """Nearest neighbours within runs of ``CHUNK`` nodes in an order by random hyperplanes."""
    planes = np.random.default_rng(seed).standard_normal((dims, 24))

    def code(batches):
        for batch in batches:
            for r in batch.to_pylist():
                nodes, vecs = _i8(r["x"]), np.frombuffer(r["y"], dtype="<f8").reshape(-1, dims)
                bits = (vecs @ planes > 0) @ (1 << np.arange(23, -1, -1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bits), pa.array(nodes), pa.array([v.tobytes() for v in vecs.astype("<f4")], pa.binary())],
                    ["code", "node", "vec"],
                )

    def near(batches):
        nodes, vecs = np.zeros(0, np.int64), np.zeros((0, dims), "f4")

        def run(nodes, vecs):
            squares = np.einsum("ij,ij->i", vecs, vecs)
            d = np.maximum(squares[:, None] + squares[None, :] - 2 * vecs @ vecs.T, 0)
            np.fill_diagonal(d, np.inf)
            some = min(k, len(nodes) - 1)
            at = np.argpartition(d, some - 1, axis=1)[:, :some] if some else np.zeros((len(nodes), 0), int)
            own = np.repeat(np.arange(len(nodes)), some)
            return _updates(nodes[own], nodes[at.ravel()], np.sqrt(d[own, at.ravel()]), shards, k)

        for batch in batches:
            nodes = np.concatenate((nodes, np.asarray(batch["node"])))
            more = np.frombuffer(b"".join(batch["vec"].to_pylist()), dtype="<f4").reshape(-1, dims)
            vecs = np.concatenate((vecs, more))
            while len(nodes) >= 2 * CHUNK:
                yield from _table(run(nodes[:CHUNK], vecs[:CHUNK])).to_batches()
                nodes, vecs = nodes[CHUNK:], vecs[CHUNK:]
        if len(nodes):
            yield from _table(run(nodes, vecs)).to_batches()

    coded = vectors.mapInArrow(code, "code long, node long, vec binary")
    return coded.repartitionByRange("code", "node").sortWithinPartitions("code", "node").mapInArrow(near, MESSAGE)


def build(embeddings: DataFrame, k: int = K, reverse: int = REVERSE, rounds: int = ROUNDS, top: int = 10) -> Index:
    """Index ``embeddings(vec_id, embedding)`` for searches of up to ``top`` neighbours."""
    own, dims = clean(embeddings)
    ranked = own.withColumn("r", F.row_number().over(Window.partitionBy("vec").orderBy("vec_id"))).where(F.col("r") <= top + 1)
    members = ranked.groupBy("vec").agg(F.min("vec_id").alias("node"), F.array_sort(F.collect_list("vec_id")).alias("ids"))
    members = staged(members.select("node", "ids", "vec"), "nn-members")
    n = members.count()
    per_shard = max(256, min(4096, SHARD_BYTES // (8 * dims)))
    shards = max(1, -(-n // per_shard))

    def pack(batches):
        for batch in batches:
            nodes = np.asarray(batch["node"])
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard_of(nodes, shards)), batch["node"], batch["vec"]], ["shard", "node", "vec"]
            )

    def together(table: pa.Table) -> pa.Table:
        # A vector that is met under two ids of its own would be two nodes; ids are unique here.
        order = np.argsort(table["node"].to_numpy(), kind="stable")
        nodes = table["node"].to_numpy()[order]
        vecs = np.frombuffer(b"".join(table["vec"].to_pylist()), dtype="<f8").reshape(-1, dims)[order]
        new = np.ones(len(nodes), dtype=bool)
        new[1:] = nodes[1:] != nodes[:-1]
        nodes, vecs = nodes[new], vecs[new]
        empty = np.full((len(nodes), k), -1, dtype="<i8"), np.full((len(nodes), k), np.inf, dtype="<f4")
        shard = table["shard"][0].as_py()
        return _table([_row(shard, VECTORS, nodes, vecs), _row(shard, GRAPH, nodes, *empty)])

    packed = members.mapInArrow(pack, "shard int, node long, vec binary").groupBy("shard").applyInArrow(together, MESSAGE)
    packed = staged(packed, "nn-vectors")
    vectors = packed.where(F.col("kind") == VECTORS)
    graph = packed.where(F.col("kind") == GRAPH)
    offers = graph
    for seed in (1, 2):
        offers = offers.unionByName(_starting_offers(vectors, dims, shards, k, seed))
    graph = staged(_by_shard(offers, _merge(k)), "nn-graph")
    for turn in range(rounds + 1):
        both = graph.unionByName(graph.mapInArrow(_reverse(shards, k, reverse), MESSAGE))
        lists = staged(_by_shard(both, _gather(shards, k, reverse)), "nn-lists")
        if turn == rounds:
            break
        asked = lists.where(F.col("kind") == REQUEST).unionByName(vectors).unionByName(graph)
        replies = _by_shard(asked, _reply(dims, k))
        offers = _by_shard(lists.where(F.col("kind") == LISTS).unionByName(replies), _compare(dims, shards, k))
        graph = staged(_by_shard(graph.unionByName(offers), _merge(k)), "nn-graph")
    first = members.select("node", F.xxhash64("node").alias("h")).orderBy("h", "node").limit(ENTRIES).collect()
    return Index(dims, shards, members, vectors, lists.where(F.col("kind") == LISTS), [r["node"] for r in first])


# State of queries (kind 0), answers of shards (kind 1) and questions to shards (kind 2).
TALK = "bucket int, kind int, shard int, query long, x binary, y binary, z binary, w binary"
TALK_NAMES = ["bucket", "kind", "shard", "query", "x", "y", "z", "w"]
STATE, ANSWER, QUESTION = range(3)


def _talk(rows: list[tuple]) -> pa.Table:
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), *[pa.binary()] * 4]
    columns = list(zip(*rows)) if rows else [[]] * 8
    return pa.table([pa.array(c, t) for c, t in zip(columns, kinds)], names=TALK_NAMES)


def _questions(bucket: int, query: int, vec: bytes, ids: np.ndarray, limit: float, shards: int) -> list[tuple]:
    to = shard_of(ids, shards)
    return [
        (bucket, QUESTION, s, query, vec, ids[to == s].tobytes(), np.array([limit]).tobytes(), b"")
        for s in np.unique(to).tolist()
    ]


def _entry_rows(index: Index, list_size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, vectors and lists of the entry nodes, by id."""
    entries, dims = np.sort(np.array(index.entries, dtype=np.int64)), index.dims

    def take(batches):
        for batch in batches:
            for r in batch.to_pylist():
                nodes = _i8(r["x"])
                at = np.flatnonzero(np.isin(nodes, entries))
                if r["kind"] == VECTORS:
                    own = np.frombuffer(r["y"], dtype="<f8").reshape(-1, dims)
                else:
                    own = _i8(r["y"]).reshape(-1, list_size)
                rows = [_row(r["shard"], r["kind"], nodes[i : i + 1], own[i]) for i in at.tolist()]
                yield from _table(rows).to_batches()

    busy = sorted(set(shard_of(entries, index.shards).tolist()))
    rows = index.vectors.unionByName(index.lists).where(F.col("shard").isin(busy)).mapInArrow(take, MESSAGE).collect()
    own = {(r["kind"], int(_i8(r["x"])[0])): r["y"] for r in rows}
    vecs = [np.frombuffer(own[VECTORS, i], dtype="<f8") for i in entries.tolist()]
    lists = [_i8(own[LISTS, i]) for i in entries.tolist()]
    return entries, np.array(vecs).reshape(-1, dims), np.array(lists, dtype="<i8").reshape(-1, list_size)


def _answer(dims: int, width: int):
    """Distances of the nodes asked for, and the lists of the nearest ones below the limit."""

    def answer(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        vectors = next(r for r in rows if r["kind"] == VECTORS + 10)
        nodes, vecs = _i8(vectors["x"]), np.frombuffer(vectors["y"], dtype="<f8").reshape(-1, dims)
        own = next(r for r in rows if r["kind"] == LISTS + 10)
        lists = _i8(own["y"]).reshape(len(nodes), -1)
        out = []
        for r in rows:
            if r["kind"] == QUESTION:
                ids = _i8(r["y"])
                at = np.searchsorted(nodes, ids)
                d = np.sqrt(((vecs[at] - np.frombuffer(r["x"], dtype="<f8")) ** 2).sum(axis=1))
                near = np.argsort(d, kind="stable")[:width]
                near = near[d[near] <= np.frombuffer(r["z"], dtype="<f8")[0]]
                out.append(
                    (r["bucket"], ANSWER, 0, r["query"], ids.tobytes(), d.tobytes(), near.astype("<i8").tobytes(), lists[at[near]].tobytes())
                )
        return _talk(out)

    return answer


def _step(shards: int, ef: int, width: int, list_size: int):
    """Answers into beams; the next questions."""

    def step(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        answers: dict[int, list] = {}
        for r in rows:
            if r["kind"] == ANSWER:
                answers.setdefault(r["query"], []).append(r)
        out = []
        for r in rows:
            if r["kind"] != STATE:
                continue
            query = r["query"]
            # Beam: ids, distances, and whether each has been expanded; then all ids ever asked for.
            beam = np.frombuffer(r["y"], dtype=[("id", "<i8"), ("d", "<f8"), ("done", "<i8")])
            seen = _i8(r["z"])
            lists: dict[int, np.ndarray] = {}
            parts = [beam]
            for a in answers.get(query, ()):
                ids, d = _i8(a["x"]), np.frombuffer(a["y"], dtype="<f8")
                fresh = np.zeros(len(ids), dtype=beam.dtype)
                fresh["id"], fresh["d"] = ids, d
                parts.append(fresh)
                for i, own in zip(ids[_i8(a["z"])].tolist(), _i8(a["w"]).reshape(-1, list_size)):
                    lists[i] = own
            beam = np.concatenate(parts)
            # The expanded copy of a node that was asked for again comes first.
            beam = beam[np.lexsort((-beam["done"], beam["id"], beam["d"]))]
            new = np.ones(len(beam), dtype=bool)
            new[1:] = beam["id"][1:] != beam["id"][:-1]
            beam = beam[new][:ef].copy()
            limit = float(beam["d"][-1]) if len(beam) == ef else np.inf
            asked = [np.zeros(0, np.int64)]
            again = [np.zeros(0, np.int64)]
            for at in np.flatnonzero(beam["done"] == 0)[:width].tolist():
                node = int(beam["id"][at])
                if node in lists:
                    beam["done"][at] = 1
                    asked.append(lists[node])
                else:
                    again.append(np.array([node]))
            asked = np.setdiff1d(np.concatenate(asked), seen)
            asked = asked[asked >= 0]
            seen = np.union1d(seen, asked)
            out.append((r["bucket"], STATE, 0, query, r["x"], beam.tobytes(), seen.astype("<i8").tobytes(), b""))
            ids = np.concatenate((asked, *again)).astype("<i8")
            if len(ids):
                out += _questions(r["bucket"], query, r["x"], ids, limit, shards)
        return _talk(out)

    return step


def search(
    index: Index, queries: DataFrame, top: int = 10, ef: int = EF, width: int = WIDTH, reverse: int = REVERSE, k: int = K
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``top`` nearest found for each of ``queries(query_id, vec)``.

    ``vec`` is packed as by ``clean``.  Candidates with the query's own id are
    left out.
    """
    shards = index.shards
    # At most ENTRIES nodes.
    shared = queries.sparkSession.sparkContext.broadcast(_entry_rows(index, k + reverse))
    queries = staged(queries.join(index.members.select("vec", "node"), "vec", "left").select("query_id", "vec", "node"), "nn-queries")
    buckets = max(1, -(-queries.count() // QUERIES_PER_BUCKET))

    def begin(batches):
        entries, vecs, lists = shared.value
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                bucket = int(_mixed(np.array([r["query_id"]]))[0] % np.uint64(buckets))
                own = [] if r["node"] is None else [r["node"]]
                own = np.setdiff1d(np.array(own, dtype=np.int64), entries)
                ids = np.union1d(entries, own).astype("<i8")
                out.append((bucket, STATE, 0, r["query_id"], r["vec"], b"", ids.tobytes(), b""))
                d = np.sqrt(((vecs - np.frombuffer(r["vec"], dtype="<f8")) ** 2).sum(axis=1))
                near = np.argsort(d, kind="stable")[:width].astype("<i8")
                out.append((bucket, ANSWER, 0, r["query_id"], entries.tobytes(), d.tobytes(), near.tobytes(), lists[near].tobytes()))
                if len(own):
                    out += _questions(bucket, r["query_id"], r["vec"], own, np.inf, shards)
            yield from _talk(out).to_batches()

    talk = staged(queries.mapInArrow(begin, TALK), "nn-search")
    # The shards' own rows, in the columns of the conversation.
    held = index.vectors.unionByName(index.lists).select(
        F.lit(0).alias("bucket"), (F.col("kind") + 10).alias("kind"), "shard", F.lit(0).cast("long").alias("query"), "x", "y", "z", "w"
    )
    first = True
    while first or not talk.where(F.col("kind") == QUESTION).isEmpty():
        first = False
        asked = talk.where(F.col("kind") == QUESTION)
        # Shards that nobody asks have nothing to answer; one row for each other, far fewer than vectors.
        busy = F.broadcast(asked.groupBy("shard").agg(F.ceil(F.count("*") / QUESTIONS).cast("int").alias("salts")))
        drawn = asked.join(busy, "shard").withColumn("salt", F.pmod(F.xxhash64("query"), F.col("salts")).cast("int"))
        copies = held.join(busy, "shard").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
        answers = drawn.select(*TALK_NAMES, "salt").unionByName(copies.select(*TALK_NAMES, "salt"))
        answers = answers.groupBy("shard", "salt").applyInArrow(_answer(index.dims, width), TALK)
        talk = talk.where(F.col("kind") != QUESTION).unionByName(answers)
        talk = staged(talk.groupBy("bucket").applyInArrow(_step(shards, ef, width, k + reverse), TALK), "nn-search")

    def results(batches):
        for batch in batches:
            query, node, score = [], [], []
            for r in batch.to_pylist():
                beam = np.frombuffer(r["y"], dtype=[("id", "<i8"), ("d", "<f8"), ("done", "<i8")])[: top + 1]
                query += [r["query"]] * len(beam)
                node += beam["id"].tolist()
                score += beam["d"].tolist()
            arrays = [pa.array(query, pa.int64()), pa.array(node, pa.int64()), pa.array(score, pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, ["query_id", "node", "score"])

    found = talk.where(F.col("kind") == STATE).mapInArrow(results, "query_id long, node long, score double")
    found = found.join(index.members.select("node", "ids"), "node")
    found = found.select("query_id", "score", F.explode("ids").alias("vec_id")).where("vec_id <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")


def self_search(embeddings: DataFrame, every: int = 100, top: int = 10) -> DataFrame:
    """The neighbours of the rows whose ``vec_id`` is divisible by ``every``, among all rows."""
    index = build(embeddings, top=top)
    own, _ = clean(embeddings)
    queries = own.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "vec")
    return search(index, queries.dropDuplicates(["query_id"]), top=top)
