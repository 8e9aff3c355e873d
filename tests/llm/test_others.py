"""Conversations, neighbours and the pipeline against brute force."""

from __future__ import annotations

import random
import re

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerline.llm import chat, decontaminate, nndescent, queries, secrets, simhash
from tests.llm import fixtures

# Chats


def brute_chats(rows, part_turns):
    talks: dict = {}
    for conv, turn, role, text in set(rows):
        talks.setdefault(conv, []).append((turn is not None, turn or 0, role is not None, role or "", text))
    lists = {c: tuple((r if known else None, t) for _, _, known, r, t in sorted(x, key=lambda y: y[:4])) for c, x in talks.items()}
    out = []
    for own in set(lists.values()):
        if any(len(x) > len(own) and x[: len(own)] == own for x in lists.values()):
            continue
        ids = [c for c, x in lists.items() if x == own]
        first = min((c for c in ids if c is not None), default=None)
        for part in range(0, len(own), part_turns):
            text = "".join(
                f"<|im_start|>{'unknown' if r is None else r}\n{(t or '').replace('<|', '< |')}<|im_end|>\n"
                for r, t in own[part : part + part_turns]
            )
            out.append((first, part // part_turns, len(own), len(ids), text))
    return sorted(out, key=str)


def awkward_chats():
    rng = random.Random(2)
    rows = []
    for c in range(40):
        base = c % 12
        own = random.Random(base)
        for t in range(rng.randint(1, 8)):
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", f"{own.random()} <|im_end|>"))
    rows += rows[:5]
    rows += [(50, 0, "user", None), (51, 0, "user", ""), (51, 1, "assistant", "x"), (52, None, None, "y"), (52, 3, "user", "z")]
    rows += [(None, 0, "user", "none"), (None, 1, "user", "of these")]
    rows += [(60, t, "user", f"long {t}") for t in range(700)] + [(61, t, "user", f"long {t}") for t in range(300)]
    return rows


def test_chats_equal_brute_force(spark):
    rows = awkward_chats()
    frame = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, pos int")
    for partitions in ("1", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        try:
            got = sorted((tuple(r) for r in chat.format_conversations(frame, part_turns=64).collect()), key=str)
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "4")
        assert got == brute_chats(rows, 64)


def test_chat_plan_has_no_python(spark, capsys):
    frame = spark.createDataFrame(awkward_chats(), "conv_id long, turn long, role string, text string")
    chat.format_conversations(frame).explain("formatted")
    plan = capsys.readouterr().out
    assert not re.search("ArrowEval|BatchEvalPython|MapIn|FlatMap|WindowInPandas", plan)


# Neighbours


def vectors(n, dims=16, seed=0):
    return np.random.default_rng(seed).standard_normal((n, dims)).astype("f4")


def exact(ids, x, query, top):
    d = np.sqrt(((x.astype("f8") - x[query].astype("f8")) ** 2).sum(axis=1))
    order = [i for i in np.lexsort((ids, d)) if ids[i] != ids[query]][:top]
    return [(int(ids[i]), float(d[i])) for i in order]


def test_neighbours_reach_the_recall_and_order_ties(spark):
    x = vectors(1500)
    x[1000:1300] = x[7]
    ids = np.arange(1500)
    data = [(int(i), v.tolist(), 0) for i, v in zip(ids, x)]
    bad = [(5000, None, 0), (5100, [0.0] * 16, 0), (5200, [float("nan")] + [1.0] * 15, 0), (5300, [1.0, None] + [1.0] * 14, 0),
           (5400, [1.0] * 3, 0), (None, [1.0] * 16, 0), (5500, [float("inf")] * 16, 0), data[200]]
    frame = spark.createDataFrame(data + bad, "vec_id long, embedding array<float>, rank int")
    found: dict = {}
    for r in nndescent.self_search(frame).collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert sorted(found) == list(range(0, 1500, 100))
    hit = 0
    for query, own in found.items():
        own.sort()
        want = exact(ids, x, query, 10)
        assert [r for r, _, _ in own] == list(range(1, 11))
        hit += len({v for _, v, _ in own} & {v for v, _ in want})
        if 1000 <= query < 1300:
            assert [(v, s) for _, v, s in own] == want
    assert hit >= 0.9 * 10 * len(found)


def test_fewer_candidates_than_asked(spark):
    frame = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (100, [1.0, 1.0])], "vec_id long, embedding array<float>")
    out = [tuple(r) for r in nndescent.self_search(frame).orderBy("query_id", "rank").collect()]
    assert [r[:3] for r in out] == [(0, 1, 100), (0, 2, 1), (100, 1, 0), (100, 2, 1)]
    alone = spark.createDataFrame([(0, [1.0, 0.0])], "vec_id long, embedding array<float>")
    assert nndescent.self_search(alone).count() == 0


def test_no_group_holds_a_row_of_every_query_or_link(spark, monkeypatch):
    x = vectors(600)
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    index = nndescent.build(frame)
    own, _ = nndescent.clean(frame)
    asked = own.where("vec_id % 5 = 0").select(F.col("vec_id").alias("query_id"), "vec")
    want = sorted(map(tuple, nndescent.search(index, asked).collect()))
    largest = spark.sparkContext.accumulator(0)
    whole = nndescent._answer

    def watched(*own):
        answer = whole(*own)

        def count(table):
            largest.add(int((np.asarray(table["kind"]) == nndescent.QUESTION).sum() > 40))
            return answer(table)

        return count

    monkeypatch.setattr(nndescent, "_answer", watched)
    monkeypatch.setattr(nndescent, "QUESTIONS", 10, raising=False)
    assert sorted(map(tuple, nndescent.search(index, asked).collect())) == want
    assert len(want) == 1200 and largest.value == 0
    # Links to a hub are cut where they are sent, to those that its shard would keep.
    nodes, hub = np.arange(100, dtype="<i8"), np.zeros(100, dtype="<i8")
    row = nndescent._row(0, nndescent.GRAPH, nodes, hub, np.linspace(1, 2, 100).astype("<f4"))
    (sent,) = nndescent._reverse(1, 1, 32)(nndescent._table([row]).to_batches())
    _, sources, _ = nndescent._offers(pa.Table.from_batches([sent]))
    assert sources.tolist() == list(range(32))


# Pipeline

SECRET = fixtures.sentence(random.Random(99), 60) + ' token = "0123456789abcdef01234567"'


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sf"))
    rows = [(i, t, "en", "s", len(t or ""), 0.0, "x") for i, t in fixtures.texts()]
    passage = " ".join(fixtures.texts()[8][1].split()[5:20])
    rows += [(200, "calm " + passage + " end", "en", "s", 9, 0.0, "x"), (201, SECRET, "en", "s", 9, 0.0, "x")]
    spark.createDataFrame(rows, fixtures.SCHEMA).write.parquet(f"{path}/documents.parquet")
    fixtures.labels(spark).write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages_apply_their_decisions(spark, store):
    docs = spark.read.parquet(f"{store}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "simhash_dedup", "decontaminate", "secrets", "pieces"]
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, store).cache()
        if name != "pieces":
            assert out.columns == columns
        ids = {r["doc_id"] for r in out.select("doc_id").collect()}
        before = {r["doc_id"] for r in docs.select("doc_id").collect()}
        if name == "quality":
            assert set(range(60)) <= ids and not set(range(60, 90)) & ids
        if name == "simhash_dedup":
            assert 3 in ids and not {100, 102, 103, 130} & ids
            assert out.count() == out.dropDuplicates(["doc_id"]).count()
        if name == "decontaminate":
            assert before - ids == {8, 200}
        if name == "secrets":
            assert before == ids
            assert out.where("doc_id = 201").first()["text"] == SECRET[: SECRET.index("token")] + '[REDACTED]"'
        docs = out
    assert docs.columns == ["doc_id", "n_tokens", "ids"] and docs.where("n_tokens < 2").count() == 0


def test_run_equals_the_stages_one_by_one(spark, store):
    docs = spark.read.parquet(f"{store}/documents.parquet")
    model = queries.quality_model(docs, spark.read.parquet(f"{store}/labels.parquet"))
    kept = docs.where(corpus_pipeline.quality.score(F.col("text"), model) >= queries.PREDICT_FROM)
    kept = simhash.keep_one(kept)
    kept = decontaminate.remove_contaminated(kept, spark.read.parquet(f"{store}/benchmark.parquet"))
    want = corpus_pipeline.pieces_stage(spark, secrets.redact_documents(kept), store)
    key = lambda r: str(tuple(r))
    assert sorted(corpus_pipeline.run(spark, store).collect(), key=key) == sorted(want.collect(), key=key)


def test_stages_take_an_empty_table(spark, store):
    docs = fixtures.empty(spark)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, store)
    assert docs.count() == 0


# SQL


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_oracle_sql(spark, name):
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for table in ("documents", "conversations", "labels", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    got = queries.QUERIES[name](spark, folder)
    want = con.sql(queries.ORACLE[name])
    order = [want.columns.index(c) for c in got.columns]
    assert sorted(tuple(map(str, r)) for r in got.collect()) == sorted(tuple(str(r[i]) for i in order) for r in want.fetchall())
