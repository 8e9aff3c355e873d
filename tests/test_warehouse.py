"""Warehouse versions: failed writes stay invisible, reruns append nothing."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ledgerline.sources import warehouse


def _ids(df):
    return sorted(r["id"] for r in df.collect())


def test_failed_full_load_keeps_previous_version(spark, workdir):
    first = spark.range(10).select(F.col("id").cast("string").alias("id"))
    assert warehouse.write_table(spark, workdir, "t", first) == 10
    failing = spark.range(20).select(
        F.when(F.col("id") == 13, F.raise_error(F.lit("lost in the middle of the write")))
        .otherwise(F.col("id").cast("string"))
        .alias("id")
    )
    with pytest.raises(Exception, match="lost in the middle"):
        warehouse.load(spark, {"t": failing}, workdir, "full")
    assert _ids(warehouse.read_table(spark, workdir, "t")) == sorted(str(i) for i in range(10))


def test_incremental_rerun_appends_only_new_keys(spark, workdir):
    stored = spark.createDataFrame([("a", 1), ("b", 2)], "id string, v int")
    warehouse.write_table(spark, workdir, "t", stored)
    incoming = spark.createDataFrame([("a", 99), ("c", 3), ("c", 3), (None, 4)], "id string, v int")
    keys = {"t": "id"}
    assert warehouse.load(spark, {"t": incoming}, workdir, "incremental", keys) == {"t": 3}
    # A retried run sees every key stored already and appends nothing.
    assert warehouse.load(spark, {"t": incoming}, workdir, "incremental", keys) == {"t": 0}
    rows = sorted(map(tuple, warehouse.read_table(spark, workdir, "t").collect()), key=repr)
    assert rows == sorted([("a", 1), ("b", 2), ("c", 3), ("c", 3), (None, 4)], key=repr)


def test_compaction_rewrites_many_small_appends_as_a_new_version(spark, workdir):
    warehouse.write_table(spark, workdir, "keys", spark.range(0, 10).selectExpr("cast(id as string) AS k"))
    for i in range(1, 6):
        batch = spark.range(i * 10, i * 10 + 10, numPartitions=3).selectExpr("cast(id as string) AS k")
        warehouse.append_rows(spark, workdir, "keys", batch)
    before = warehouse.current(spark, workdir, "keys")["paths"]
    files = warehouse.data_files(spark, workdir, "keys")
    assert files > 6
    assert not warehouse.compact(spark, workdir, "keys", max_files=files)  # within the bound: nothing to do
    assert warehouse.compact(spark, workdir, "keys", max_files=6)
    after = warehouse.current(spark, workdir, "keys")["paths"]
    assert len(after) == 1 and after[0] not in before
    assert warehouse.data_files(spark, workdir, "keys") < files
    assert _ids(warehouse.read_table(spark, workdir, "keys").withColumnRenamed("k", "id")) == sorted(
        str(i) for i in range(60)
    )
    # The old version is left as it was for any reader still holding it.
    assert _ids(spark.read.parquet(*before).withColumnRenamed("k", "id")) == sorted(str(i) for i in range(60))


def test_compaction_keeps_month_partitions(spark, workdir):
    import glob
    import os

    def month_rows(start):
        return spark.range(start, start + 12, numPartitions=4).selectExpr(
            "cast(id as string) AS invoice_id", "add_months(date'2025-01-01', cast(id % 3 as int)) AS invoice_month"
        )

    warehouse.write_table(spark, workdir, "fact_invoices", month_rows(0))
    for start in (12, 24, 36):
        warehouse.append_rows(spark, workdir, "fact_invoices", month_rows(start))
    assert warehouse.compact(spark, workdir, "fact_invoices", max_files=3)
    (path,) = warehouse.current(spark, workdir, "fact_invoices")["paths"]
    assert len(glob.glob(os.path.join(path, "invoice_month=*"))) == 3
    stored = warehouse.read_table(spark, workdir, "fact_invoices")
    assert stored.columns == ["invoice_id", "invoice_month"]
    assert sorted(int(r["invoice_id"]) for r in stored.collect()) == list(range(48))


def test_compaction_writes_no_more_as_history_grows(spark, workdir):
    import glob
    import os

    def size(path):
        return sum(os.path.getsize(p) for p in glob.glob(os.path.join(path, "*.parquet")))

    warehouse.write_table(spark, workdir, "keys", spark.range(0, 50_000, numPartitions=4).selectExpr("cast(id as string) AS k"))
    written = []
    for i in range(1, 5):
        for j in range(3):
            start = 50_000 + i * 1000 + j * 100
            batch = spark.range(start, start + 100, numPartitions=2).selectExpr("cast(id as string) AS k")
            warehouse.append_rows(spark, workdir, "keys", batch)
        assert warehouse.compact(spark, workdir, "keys", max_files=3)
        assert not warehouse.compact(spark, workdir, "keys", max_files=0)  # closed: never rewritten again
        written.append(size(warehouse.current(spark, workdir, "keys")["paths"][-1]))
    assert max(written[1:]) < written[0] / 10
    assert warehouse.read_table(spark, workdir, "keys").distinct().count() == 50_000 + 4 * 300


def test_readers_see_all_of_an_append_or_nothing(spark, workdir):
    rows = lambda a, b: spark.range(a, b, numPartitions=4).select(F.col("id").cast("string").alias("id"))
    warehouse.write_table(spark, workdir, "t", rows(0, 10))
    held = warehouse.read_table(spark, workdir, "t")
    lost = F.when(F.col("id") == "27", F.raise_error(F.lit("lost in the middle"))).otherwise(F.col("id"))
    with pytest.raises(Exception, match="lost in the middle"):
        warehouse.append_rows(spark, workdir, "t", rows(10, 30).select(lost.alias("id")))
    # Files of finished tasks may lie there, but no reader meets them.
    assert warehouse.read_table(spark, workdir, "t").count() == 10 == held.count()
    assert warehouse.append_rows(spark, workdir, "t", rows(10, 30)) == 20
    assert warehouse.read_table(spark, workdir, "t").count() == 30 and held.count() == 10


def test_appends_keep_month_partitions_and_prune_them(spark, workdir):
    def month_rows(start):
        return spark.range(start, start + 12, numPartitions=4).selectExpr(
            "cast(id as string) AS invoice_id", "add_months(date'2025-01-01', cast(id % 3 as int)) AS invoice_month"
        )

    for start in (0, 12, 24):
        warehouse.append_rows(spark, workdir, "fact_invoices", month_rows(start))
    stored = warehouse.read_table(spark, workdir, "fact_invoices")
    assert stored.columns == ["invoice_id", "invoice_month"] and stored.count() == 36
    one = stored.where("invoice_month = date'2025-02-01'")
    assert one.count() == 12 and one.select(F.input_file_name()).distinct().count() == 3


def test_vacuum_keeps_what_kept_pointers_name(spark, workdir):
    for i in range(5):
        warehouse.write_table(spark, workdir, "t", spark.range(i * 10, i * 10 + 10))
    warehouse.append_rows(spark, workdir, "t", spark.range(50, 55))
    with pytest.raises(ValueError):
        warehouse.vacuum(spark, workdir, "t", keep=0)
    assert warehouse.vacuum(spark, workdir, "t", keep=2) == 4
    assert warehouse.vacuum(spark, workdir, "t", keep=2) == 0
    assert warehouse.read_table(spark, workdir, "t").count() == 15
    assert warehouse.vacuum(spark, workdir, "none", keep=2) == 0


def test_refresh_builds_only_months_that_a_load_touched(spark, workdir):
    def rows(months, start):
        return spark.createDataFrame(
            [(str(start + k), m, k + 1) for k, m in enumerate(months)], "invoice_id string, m string, amount int"
        ).selectExpr("invoice_id", "cast(m as date) AS invoice_month", "amount")

    def build(df):
        return df.groupBy("invoice_month").agg(F.sum("amount").alias("total"), F.count("*").alias("n"))

    def refreshed():
        touched = warehouse.refresh(spark, workdir, "mart", "fact_invoices", "invoice_month", build)
        stored = warehouse.read_table(spark, workdir, "fact_invoices")
        got = sorted(map(str, warehouse.read_table(spark, workdir, "mart").collect()))
        assert got == sorted(map(str, build(stored).select("invoice_month", "total", "n").collect()))
        return touched, warehouse.current(spark, workdir, "mart")["paths"]

    name = lambda m: f"invoice_month={m}"
    warehouse.write_table(spark, workdir, "fact_invoices", rows(["2025-01-01", "2025-02-01", "2025-02-01", None], 0))
    touched, before = refreshed()
    assert touched == sorted([name("2025-01-01"), name("2025-02-01"), name("__HIVE_DEFAULT_PARTITION__")])
    assert refreshed() == ([], before)
    warehouse.append_rows(spark, workdir, "fact_invoices", rows(["2025-02-01", "2025-03-01"], 10))
    touched, after = refreshed()
    assert touched == [name("2025-02-01"), name("2025-03-01")]
    assert [p for p in before if "2025-02" not in p] == [p for p in after if p in before]
    # Merged or replaced inputs are built anew, all of them.
    warehouse.compact(spark, workdir, "fact_invoices", 1)
    assert len(refreshed()[0]) == 4
    warehouse.write_table(spark, workdir, "fact_invoices", rows(["2025-05-01"], 20))
    assert refreshed()[0] == [name("2025-05-01")]
    assert warehouse.vacuum(spark, workdir, "mart", keep=1) > 0
    assert warehouse.read_table(spark, workdir, "mart").count() == 1
    with pytest.raises(ValueError, match="not partitioned"):
        warehouse.refresh(spark, workdir, "mart2", "mart", "n", build)


def _rows_scanned(df):
    """Rows that the scan of ``df`` gave to its filter, and the result."""
    rows = df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    scans = [leaves.apply(i).metrics().get("numOutputRows") for i in range(leaves.size())]
    return sum(x.get().value() for x in scans), rows


def _history(spark, root, files=8):
    """Tickets whose keys have the same range in every file."""
    keys = [spark.range(i, 8000, files, numPartitions=1) for i in range(files)]
    for i, part in enumerate(keys):
        batch = part.select(F.concat(F.lit("t"), F.sha2(F.col("id").cast("string"), 256)).alias("ticket_id"), F.lit(i).alias("v"))
        warehouse.append_rows(spark, root, "fact_support_tickets", batch)


def test_a_small_batch_reads_the_row_groups_that_may_hold_its_keys(spark, workdir):
    _history(spark, workdir)
    stored = warehouse.read_table(spark, workdir, "fact_support_tickets")
    own = stored.where("v = 3").limit(2).collect()
    incoming = spark.createDataFrame([(own[0][0], 9), (own[1][0], 9), ("new", 9), (None, 9)], "ticket_id string, v int")
    scanned, found = _rows_scanned(warehouse.holding_keys(stored, incoming, "ticket_id"))
    assert sorted(r["ticket_id"] for r in found) == sorted(r["ticket_id"] for r in own)
    # One file of eight, and with a small chance one more for each absent key.
    assert scanned <= 3000
    tables = {"fact_support_tickets": incoming}
    assert warehouse.load(spark, tables, workdir, "incremental") == {"fact_support_tickets": 2}
    assert warehouse.load(spark, tables, workdir, "incremental") == {"fact_support_tickets": 0}


def test_merged_files_keep_their_key_filters(spark, workdir):
    _history(spark, workdir, files=4)
    assert warehouse.compact(spark, workdir, "fact_support_tickets", max_files=1)
    stored = warehouse.read_table(spark, workdir, "fact_support_tickets")
    absent = spark.createDataFrame([("t8", 1)], "ticket_id string, v int")
    scanned, found = _rows_scanned(warehouse.holding_keys(stored, absent, "ticket_id"))
    assert (scanned, found) == (0, [])


def test_many_keys_or_other_types_read_the_whole_history(spark, workdir):
    warehouse.write_table(spark, workdir, "t", spark.range(50).toDF("id"))
    stored = warehouse.read_table(spark, workdir, "t")
    assert warehouse.holding_keys(stored, spark.range(9), "id", most=8).count() == 50
    assert warehouse.holding_keys(stored, spark.range(8), "id", most=8).count() == 8
    assert warehouse.holding_keys(stored, spark.range(0), "id").count() == 0
    assert warehouse.holding_keys(stored, spark.range(3).selectExpr("CAST(id AS STRING) AS id"), "id").count() == 50
