"""Raw sources: CSV and JSON-lines files read as all-string bronze tables.

Each bronze row carries where it came from, which fixes "first copy" order
without a single-task sort:

* ``_ingest_file``   - the file path (``_metadata.file_path``),
* ``_ingest_offset`` - start of the split inside the file,
* ``_ingest_row``    - ``monotonically_increasing_id()``, rising within a split.

``(file, offset, row)`` is file order across any number of splits.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.coerce import null_tokens_to_null
from ledgerline.functions.order import CORRUPT, column
from ledgerline.operators.contracts import check_required_columns

# Holds the text of a row with a wrong number of fields while it is read.
BAD_ROW = "_bad_csv_row"


def _with_ingest_order(df: DataFrame) -> DataFrame:
    return df.select(
        "*",
        F.col("_metadata.file_path").alias("_ingest_file"),
        F.col("_metadata.file_block_start").alias("_ingest_offset"),
        F.monotonically_increasing_id().alias("_ingest_row"),
    )


def read_csv(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """Header row, every column a string, missing-value tokens as null,
    a quote inside a quoted field written twice.

    The columns are those of the header, so a missing column is noticed.  A
    row with fewer fields has nulls in the rest; a row with more fields than
    the header fails the read, as its surplus values would be lost.
    """
    reader = (
        spark.read.option("header", True).option("multiLine", multiline).option("escape", '"').option("mode", "PERMISSIVE")
    )
    names = reader.option("inferSchema", False).csv(path).columns
    if not names:
        return _with_ingest_order(reader.csv(path))
    fields = [T.StructField(c, T.StringType()) for c in names]
    # With pruned columns the parser would not count a row's fields.
    df = (
        reader.schema(T.StructType([*fields, T.StructField(BAD_ROW, T.StringType())]))
        .option("columnNameOfCorruptRecord", BAD_ROW)
        .option("columnPruning", False)
        .csv(path)
    )
    df = df.where(~_has_surplus(F.col(BAD_ROW), column(names[-1]), len(names)))
    df = df.select(*[null_tokens_to_null(column(c)).alias(c) for c in names], "_metadata")
    return _with_ingest_order(df).drop("_metadata")


def _has_surplus(bad: Column, last: Column, width: int) -> Column:
    """False, or an error naming the row, for the text of a row with a wrong number of
    fields.  A short row ends before its ``last`` column; others are parsed once more."""
    wider = ", ".join(f"c{i} string" for i in range(width + 1))
    more = last.isNotNull() | F.from_csv(bad, wider, {"escape": '"'})[f"c{width}"].isNotNull()
    error = F.raise_error(F.concat(F.lit("CSV row has more fields than its header: "), bad))
    return F.when(bad.isNotNull() & more, error.cast("boolean")).otherwise(F.lit(False))


def read_jsonl(
    spark: SparkSession,
    path: str,
    columns: list[str] | None = None,
    strict: bool = False,
) -> DataFrame:
    """One JSON object per line.

    With ``columns`` the listed fields are read as strings (no inference
    pass over the data); otherwise one pass finds the field names.  Values
    are taken as they are written (``1.10`` stays ``1.10``).  ``strict=True``
    fails on a malformed line, as the reference does; by default such a line
    keeps its text in ``_corrupt_record``, a column that silver never gets.
    """
    reader = spark.read.option("mode", "FAILFAST" if strict else "PERMISSIVE").option("primitivesAsString", True)
    if columns:
        fields = [T.StructField(c, T.StringType()) for c in columns]
        if not strict:
            fields.append(T.StructField(CORRUPT, T.StringType()))
        df = reader.schema(T.StructType(fields)).json(path)
    else:
        df = reader.json(path)
        df = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])
    return _with_ingest_order(df)


def read_raw_tables(
    spark: SparkSession,
    raw_files: Mapping[str, str],
    contracts: Mapping[str, Any] | None = None,
    options: Mapping[str, Mapping[str, bool]] | None = None,
) -> dict[str, DataFrame]:
    """S3: every configured raw file, in configuration order.

    A ``.jsonl`` suffix selects the JSON reader.  When ``contracts`` are
    given, JSON columns are ordered contract-first and every table's
    required columns are checked (K1) before anything runs.  A JSON table
    whose contract lists ``extra_columns`` (an empty list will do) is read
    with exactly its required and extra columns, which saves the pass that
    finds the field names.  ``options`` holds ``multiline`` (CSV) or
    ``strict`` (JSON) for a table.
    """
    tables: dict[str, DataFrame] = {}
    for name, path in raw_files.items():
        contract = (contracts or {}).get(name) or {}
        if str(path).endswith(".jsonl"):
            required, extra = contract.get("required_columns", []), contract.get("extra_columns")
            listed = None if extra is None else [*required, *extra]
            df = read_jsonl(spark, str(path), listed, **(options or {}).get(name, {}))
            # Inference sorts fields by name; contract columns come first, in contract order.
            first = [c for c in contract.get("required_columns", []) if c in df.columns]
            tables[name] = df.select(*first, *[c for c in df.columns if c not in first])
        else:
            tables[name] = read_csv(spark, str(path), **(options or {}).get(name, {}))
        if contract:
            check_required_columns(name, tables[name], contract)
    return tables
