"""One thin query for each operator of this package, with its oracle where SQL can express it.

Every query takes ``(spark, sf_dir)``, reads its whole table and returns the
full result of its operator in the columns of its contract.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import (
    align, bloom_lm, chat, decontaminate, manifest, nndescent, pieces, quality, secrets, shards, simhash, token_counts, toxicity,
)

PIECE_MODEL = "piece_bpe_32k.model"
BYTE_MODEL = "byte_bpe_50k.json"
MOST_TOKENS = 4096
PREDICT_FROM = 0.3


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def quality_model(documents: DataFrame, labels: DataFrame) -> quality.Model:
    train = fold(F.col("doc_id"), 5) != 0
    return quality.fit(
        documents.select("doc_id", "text").where(train), quality.trusted(labels.where(train)).select("doc_id")
    )


def op1_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_model(documents, _table(spark, sf_dir, "labels"))
    return documents.select(
        "doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), quality.score(F.col("text"), model).alias("score")
    ).withColumn("predicted", (F.col("score") >= PREDICT_FROM).cast("int"))


def op2_snapshot_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_conversations(_table(spark, sf_dir, "conversations"))


def op3_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nndescent.self_search(_table(spark, sf_dir, "embeddings"), every=100, top=10)


def op4_covering_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.components(_table(spark, sf_dir, "documents").select("doc_id", "text"), size=4, radius=4)
    return found.select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def op5_bloom_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = fold(F.col("doc_id"), 10)
    found = bloom_lm.score(_table(spark, sf_dir, "documents"), training=part != 0, tuning=part == 1)
    return found.select(
        "doc_id", (~F.col("training")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op6_ordinal_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = fold(F.col("doc_id"), 5) == 0
    labels = _table(spark, sf_dir, "labels").where(~held_out)
    # A grade above 0 is the same as the label toxic, so one count of words serves both.
    found = toxicity.associated(toxicity.worded(documents.where(~held_out), labels))
    training = toxicity.labelled(documents.where(~held_out), labels)
    model = toxicity.fit(toxicity.graded(training, found), found)
    found = documents.select("doc_id", held_out.alias("held_out"), toxicity.severity(F.col("text"), model).alias("s"))
    return found.select(
        "doc_id",
        "held_out",
        F.col("s.expected").alias("expected_severity"),
        F.round("s.expected").cast("int").alias("severity"),
        F.col("s.at_least")[0].alias("score"),
        (F.col("s.at_least")[0] >= 0.5).cast("int").alias("toxic"),
    )


def op7_hash_tree_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = shards.assign(_table(spark, sf_dir, "documents"), n=8)
    return found.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op8_offset_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(PIECE_MODEL)
    found = pieces.encode(_table(spark, sf_dir, "documents").select("doc_id", "text"), path, decoded="decoded")
    return found.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
        F.sha2(F.concat("begins", "ends"), 256).alias("spans_sha256"),
    )


def op9_wu_manber(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.annotate(documents, _table(spark, sf_dir, "benchmark"), window=10)
    return found.select(
        "doc_id",
        "matches.n_words",
        F.size("matches.hits").cast("long").alias("n_hit"),
        F.size("matches.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("matches.items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("matches.hits") > 0).alias("contaminated"),
    )


def op10_zstd_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _table(spark, sf_dir, "documents").select("doc_id", secrets.find_secrets(F.col("text")).alias("s"))
    count = lambda kind: F.size(F.filter("s", lambda x: x["kind"] == kind)).cast("long")
    text = lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))
    base = F.filter("s", lambda x: x["kind"] != "novel")
    return found.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(F.array_join(F.transform(base, text), ",").cast("binary"), 256).alias("base_sha256"),
        F.array_join(F.transform("s", text), ",").alias("spans"),
    )


def op11_byte_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = public_tokenizers.path(BYTE_MODEL), public_tokenizers.path(PIECE_MODEL)
    return align.align(_table(spark, sf_dir, "documents").select("doc_id", "text"), *paths)


def op12_piece_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = token_counts.count_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path(PIECE_MODEL))
    return found.withColumn("over_limit", F.col("n_tokens") > MOST_TOKENS)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A null id has no checksum, so it is not even.
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    tampered = {"text": F.when(even, F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))}
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    return manifest.manifest(_table(spark, sf_dir, "documents"), fields, "doc_id", "source", tampered)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pu_quality": op1_pu_quality,
    "op2_snapshot_chat": op2_snapshot_chat,
    "op3_nn_descent": op3_nn_descent,
    "op4_covering_simhash": op4_covering_simhash,
    "op5_bloom_lm": op5_bloom_lm,
    "op6_ordinal_toxicity": op6_ordinal_toxicity,
    "op7_hash_tree_shards": op7_hash_tree_shards,
    "op8_offset_pieces": op8_offset_pieces,
    "op9_wu_manber": op9_wu_manber,
    "op10_zstd_secrets": op10_zstd_secrets,
    "op11_byte_alignment": op11_byte_alignment,
    "op12_piece_counts": op12_piece_counts,
    "op13_merkle_manifest": op13_merkle_manifest,
}

def _sql_words(table: str) -> str:
    """Rows of a table with the words of their texts as a list."""
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    words = f"regexp_extract_all({lower}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    return f"SELECT *, row_number() OVER () AS rid, {words} AS l FROM {table}"


ORACLE: dict[str, str] = {
    # Conversations as lists of turns; a list that begins a longer one is dropped, equal ones are counted.
    "op2_snapshot_chat": """
        WITH turns AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations),
        lists AS (
            SELECT conv_id, list({'role': role, 'text': text} ORDER BY turn, role, text) AS l
            FROM turns GROUP BY conv_id
        ),
        alone AS (SELECT l, len(l) AS n_turns, min(conv_id) AS conv_id, count(*) AS copies FROM lists GROUP BY l),
        inner_prefixes AS (
            SELECT DISTINCT l[1:k] AS p
            FROM (SELECT l, unnest(range(1, n_turns)) AS k FROM alone)
        ),
        kept AS (SELECT * FROM alone WHERE l NOT IN (SELECT p FROM inner_prefixes)),
        ordered AS (
            SELECT t.conv_id, k.n_turns, k.copies, t.role, t.text,
                   row_number() OVER (PARTITION BY t.conv_id ORDER BY t.turn, t.role, t.text) - 1 AS pos
            FROM turns t JOIN kept k USING (conv_id)
        )
        SELECT conv_id, pos // 256 AS part, n_turns, copies,
               string_agg('<|im_start|>' || coalesce(role, 'unknown') || chr(10)
                          || replace(coalesce(text, ''), '<|', '< |') || '<|im_end|>' || chr(10),
                          '' ORDER BY pos) AS text
        FROM ordered GROUP BY conv_id, pos // 256, n_turns, copies
    """,
    # Every run of a window's length in every document, joined to the windows as text.
    "op9_wu_manber": f"""
        WITH item_words AS ({_sql_words("benchmark")}),
        starts AS (
            SELECT item_id, l, least(10, len(l)) AS m, unnest(range(1, len(l) - least(10, len(l)) + 2)) AS i
            FROM item_words WHERE len(l) > 0
        ),
        windows AS (SELECT DISTINCT item_id, m, array_to_string(l[i:i + m - 1], ' ') AS w FROM starts),
        docs AS MATERIALIZED ({_sql_words("documents")}),
        runs AS (
            SELECT rid, l, m, unnest(range(1, len(l) - m + 2)) AS i
            FROM docs JOIN (SELECT DISTINCT m FROM windows) ON len(l) >= m
        ),
        found AS (
            SELECT r.rid, r.i, r.m, w.item_id
            FROM runs r JOIN windows w ON w.m = r.m AND w.w = array_to_string(r.l[r.i:r.i + r.m - 1], ' ')
        ),
        hits AS (
            SELECT rid, count(DISTINCT p) AS n_hit
            FROM (SELECT rid, unnest(range(i, i + m)) AS p FROM found) GROUP BY rid
        ),
        items AS (
            SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
            FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS item FROM found WHERE item_id IS NOT NULL)
            GROUP BY rid
        )
        SELECT doc_id, CAST(len(l) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
               coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AS contaminated
        FROM docs LEFT JOIN hits USING (rid) LEFT JOIN items USING (rid)
    """,
}
