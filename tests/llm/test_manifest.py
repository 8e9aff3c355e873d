"""The Merkle manifest against plain Python."""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from ledgerline.llm import manifest, queries
from tests.llm import fixtures

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (*row[:4], text)))


def brute_manifest(rows):
    paths: dict = defaultdict(list)

    def up(nodes):
        while len(nodes) > 1:
            runs = [nodes[k : k + 3] for k in range(0, len(nodes), 3)]
            for run in runs:
                for m, (_, below) in enumerate(run):
                    for i in below:
                        paths[i].append(([x for x, _ in run[:m]], [x for x, _ in run[m + 1 :]]))
            nodes = [(h(*(x for x, _ in run)), [i for _, below in run for i in below]) for run in runs]
        return nodes[0]

    order = lambda i: (rows[i][0] is not None, rows[i][0] or 0, leaf(rows[i], rows[i][4]))
    by_source: dict = defaultdict(list)
    for i, row in enumerate(rows):
        by_source[row[1]].append(i)
    tops, sub = [], {}
    for source in sorted(by_source, key=lambda s: (s is not None, (s or "").encode())):
        tops.append(up([(leaf(rows[i], rows[i][4]), [i]) for i in sorted(by_source[source], key=order)]))
        sub.update({i: tops[-1][0] for i in by_source[source]})
    root = up(tops)[0] if tops else None
    out = []
    for i, row in enumerate(rows):
        text = row[4]
        if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0 and text is not None:
            text = text.replace("\n", "")
        folded = leaf(row, text)
        for before, after in paths[i]:
            folded = h(*before, folded, *after)
        proof = h(*(x for before, after in paths[i] for x in (*before, *after)))
        out.append((row[0], leaf(row, row[4]), sub[i], root, proof, folded, folded == root))
    return sorted(out, key=str)


def table(rows):
    return [(*r, 1, "x") for r in rows]


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, level int, hash string"


def awkward():
    names = [None, "", "b", "a", "é", "Z", "z"]
    rows = [(i, names[0 if i % 3 else i % len(names)], "en" if i % 2 else None, len(t or ""), t) for i, t in fixtures.texts()
            if i is not None]
    rows += [(i, "hot", None, None, f"line {i}\nnext" if i % 2 else "no break") for i in range(1000, 1700)]
    rows += [(None, "b", None, 1, "x\n"), (None, None, None, None, None), (7, "b", "en", 3, "a\nb"), (7, "b", "en", 3, "a\nb"), (7, "b", "de", 3, "\n")]
    rows += [(2000 + i, f"own {i}", "en", 1, "\n") for i in range(30)]
    return rows


@pytest.mark.parametrize("rows", [awkward(), awkward()[:1], [(5, "s", None, 2, "\n")], awkward()[70:79]])
def test_manifest_equals_plain_python(spark, tmp_path, rows):
    path = str(tmp_path)
    spark.createDataFrame(table(rows), SCHEMA).write.parquet(f"{path}/documents.parquet")
    limit = spark.conf.get(manifest.ROW_LIMIT)
    for partitions in ("5", "1")[: 1 + (len(rows) < 10)]:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        try:
            found = queries.op13_merkle_manifest(spark, path)
            got = sorted((tuple(r) for r in found.collect()), key=str)
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "4")
        assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
        assert got == brute_manifest(rows)
    assert spark.conf.get(manifest.ROW_LIMIT) == limit


def test_every_change_of_a_field_is_found(spark):
    rows = [(i, "s", "en", 1, f"t{i}") for i in range(20)]
    frame = spark.createDataFrame(table(rows), SCHEMA)
    assert manifest.manifest(frame, FIELDS, "doc_id", "source", {}).where("not verified").count() == 0
    for field, kind in (("lang", "string"), ("n_chars", "long"), ("text", "string")):
        one = {field: F.when(F.col("doc_id") == 11, F.lit(None).cast(kind)).otherwise(F.col(field))}
        bad = manifest.manifest(frame, FIELDS, "doc_id", "source", one).where("not verified").collect()
        assert [r["doc_id"] for r in bad] == [11]


def test_missing_columns_count_as_null_and_empty_tables_pass(spark):
    rows = [(1, None, None, None, "a"), (2, None, None, None, None)]
    frame = spark.createDataFrame(table(rows), SCHEMA)
    whole = manifest.manifest(frame, FIELDS, "doc_id", "source", {})
    less = manifest.manifest(frame.select("doc_id", "text"), FIELDS, "doc_id", "source", {})
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, less.collect()))
    assert manifest.manifest(frame.where("false"), FIELDS, "doc_id", "source", {}).count() == 0
