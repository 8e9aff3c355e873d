"""The warehouse: silver tables and marts as Parquet under one root.

Every table lives in ``<root>/<name>/`` as load directories plus pointer
files in ``_pointers/`` (JSON: load directories, schema, partition columns);
the pointer whose name sorts last is the current version.

* A **full** load writes a new version and then publishes a new pointer, so
  a failed load leaves the previous version readable and nothing that a
  running plan reads is ever overwritten.
* An **incremental** load writes a directory of its own and then publishes a
  pointer that lists it after the earlier ones, so a reader sees all of an
  append or none of it.  It appends only rows whose key is not stored yet
  (``left_anti`` against the stored keys).  Rows with
  a known key are ignored even if changed; duplicates inside one batch are
  all appended (insert-only, like the reference).
* ``compact`` merges the small directories of many appends, and ``vacuum``
  removes what no kept pointer names any more.

Row counts come from ``DataFrame.observe`` on the write itself, not from an
extra job.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.coerce import as_text
from ledgerline.functions.joins import key_set
from ledgerline.functions.order import column
from ledgerline.sources.tables import _fs_path

# The key of every stored table.
PRIMARY_KEYS = {
    "dim_customers": "customer_id",
    "dim_plans": "plan",
    "fact_subscriptions": "subscription_id",
    "fact_invoices": "invoice_id",
    "fact_product_events": "event_id",
    "fact_support_tickets": "ticket_id",
}

# Facts partitioned by month so month filters prune directories.
PARTITION_COLUMNS = {"fact_invoices": ["invoice_month"]}

#: A batch with at most so many distinct keys looks for them in the row groups that may hold them.
PUSHED_KEYS = 256


# ----------------------------------------------------------------------------
# pointer files
# ----------------------------------------------------------------------------


def _pointer_dir(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}/_pointers"


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file under a new name: written to a temporary file, then
    renamed, so readers never see a partial pointer."""
    fs, hpath = _fs_path(spark, path)
    tmp = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.tmp")
    out = fs.create(tmp, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    if not fs.rename(tmp, hpath):
        raise OSError(f"could not publish {path}")


def _read_text(spark: SparkSession, path: str) -> str:
    fs, hpath = _fs_path(spark, path)
    stream = fs.open(hpath)
    try:
        reader = spark.sparkContext._jvm.java.io.BufferedReader(
            spark.sparkContext._jvm.java.io.InputStreamReader(stream, "UTF-8")
        )
        lines = []
        line = reader.readLine()
        while line is not None:
            lines.append(line)
            line = reader.readLine()
        return "\n".join(lines)
    finally:
        stream.close()


def _pointer_files(spark: SparkSession, root: str, name: str) -> list[str]:
    fs, hdir = _fs_path(spark, _pointer_dir(root, name))
    if not fs.exists(hdir):
        return []
    return sorted(
        st.getPath().getName() for st in fs.listStatus(hdir) if st.getPath().getName().endswith(".json")
    )


def _publish(spark: SparkSession, root: str, name: str, meta: dict) -> None:
    """Make ``meta`` the current version: a new pointer file numbered one past
    the latest, whatever the driver's clock says.  Nothing is overwritten or
    deleted, so a reader always finds a complete pointer, and old pointers
    remain as history.  A table has one writer at a time."""
    files = _pointer_files(spark, root, name)
    number = int(re.match(r"\d+", files[-1]).group()) + 1 if files else 1
    _write_text(spark, f"{_pointer_dir(root, name)}/{number:015d}.json", json.dumps(meta))


def table_exists(spark: SparkSession, root: str, name: str) -> bool:
    """S11."""
    return bool(_pointer_files(spark, root, name))


def current(spark: SparkSession, root: str, name: str) -> dict:
    files = _pointer_files(spark, root, name)
    if not files:
        raise FileNotFoundError(f"table {name} not found under {root}")
    return json.loads(_read_text(spark, f"{_pointer_dir(root, name)}/{files[-1]}"))


#: Load directories are named like a partition column, so that many of them are read as one table.
LOAD = "_load"


def _new_dir(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}/{LOAD}={uuid.uuid4().hex}"


def read_dirs(spark: SparkSession, root: str, name: str, paths: list[str]) -> DataFrame:
    """Some load directories of a stored table, columns in stored order."""
    schema = T.StructType.fromJson(current(spark, root, name)["schema"])
    whole = T.StructType([*schema.fields, T.StructField(LOAD, T.StringType())])
    df = spark.read.schema(whole).option("basePath", f"{root.rstrip('/')}/{name}").parquet(*paths)
    return df.select(*[column(c) for c in schema.fieldNames()])


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The current version of a stored table, columns in stored order."""
    return read_dirs(spark, root, name, current(spark, root, name)["paths"])


# ----------------------------------------------------------------------------
# writes
# ----------------------------------------------------------------------------


def _key_filter(name: str, columns: list[str]) -> dict[str, str]:
    """Writer options for a Bloom filter on the key of a stored table, so that
    a scan for a few keys skips the row groups that lack them.  It is as large
    as the number of keys in the row group asks for, 1 MB at most."""
    key = PRIMARY_KEYS.get(name)
    if key not in columns:
        return {}
    return {
        f"parquet.bloom.filter.enabled#{key}": "true",
        "parquet.bloom.filter.adaptive.enabled": "true",
        "parquet.bloom.filter.candidates.number": "10",
    }


def observed_write(
    df: DataFrame, path: str, mode: str, partition_by: list[str], options: Mapping[str, str] | None = None
) -> int:
    if partition_by:
        # Without this every task writes one file per month it holds (tasks x
        # months small files).  A rebalance on the partition columns sends a
        # month to few tasks; AQE splits a hot month into advisory-size
        # pieces and merges small ones, so files stay near the advisory size.
        # It sits below the observation: AQE may replace an empty stage under
        # the rebalance, which must not take the row counter with it.
        df = df.hint("rebalance", *partition_by)
    obs = Observation(f"rows_{uuid.uuid4().hex}")
    writer = df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode(mode).options(**(options or {}))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return int(obs.get.get("rows", 0) or 0)


def write_table(spark: SparkSession, root: str, name: str, df: DataFrame) -> int:
    """Write a new version of ``name`` and switch the pointer to it."""
    partition_by = [c for c in PARTITION_COLUMNS.get(name, []) if c in df.columns]
    path = _new_dir(root, name)
    rows = observed_write(df, path, "errorifexists", partition_by, _key_filter(name, df.columns))
    meta = {"paths": [path], "merged": 0, "schema": json.loads(df.schema.json()), "partition_by": partition_by}
    _publish(spark, root, name, {**meta, **_side(spark, root, name, [path], full=True)})
    return rows


def _side(spark: SparkSession, root: str, name: str, paths: list[str], full: bool = False) -> dict:
    """What a stream keeps in the pointer, after a load that did not come from it: its keys are noted as unknown to the stream."""
    stream = current(spark, root, name).get("stream") if table_exists(spark, root, name) else None
    if not stream:
        return {}
    if "unindexed" not in stream:
        return {"stream": stream}
    if full and not stream["keeps_rejected"]:
        # The stream's keys are those of the rows that were replaced.
        stream = {**stream, "keys": None, "unindexed": []}
    return {"stream": {**stream, "unindexed": [*stream["unindexed"], *paths]}}


def stored_shape(df: DataFrame, name: str, stored: list[str]) -> DataFrame:
    """``df`` in the stored column order; a column that the table lacks is an
    error, since an append would lose it."""
    new = [c for c in df.columns if c not in stored]
    if new:
        raise ValueError(f"table {name} has no column {', '.join(new)}: a full load is needed to add it")
    return df.select(*[column(c) for c in stored])


def append_rows(
    spark: SparkSession, root: str, name: str, df: DataFrame, stream: Callable[[], dict] | None = None
) -> int:
    """Append to ``name`` (creating it when absent) as one step for readers.

    ``stream`` is called after the rows are written and before they become
    visible; what it returns is kept in the same pointer.
    """
    meta = current(spark, root, name) if table_exists(spark, root, name) else None
    if meta is None:
        partition_by = [c for c in PARTITION_COLUMNS.get(name, []) if c in df.columns]
        meta = {"paths": [], "merged": 0, "schema": json.loads(df.schema.json()), "partition_by": partition_by}
    rows = stored_shape(df, name, T.StructType.fromJson(meta["schema"]).fieldNames())
    path = _new_dir(root, name)
    written = observed_write(rows, path, "errorifexists", meta["partition_by"], _key_filter(name, rows.columns))
    side = {"stream": stream()} if stream else _side(spark, root, name, [path])
    # A version needs one directory at least, for its files' schema.
    if written or not meta["paths"] or side.get("stream") != meta.get("stream"):
        paths = [*meta["paths"], path] if written or not meta["paths"] else meta["paths"]
        _publish(spark, root, name, {**meta, **side, "paths": paths})
    return written


def data_files(spark: SparkSession, root: str, name: str) -> int:
    """Number of Parquet files in the directories of ``name`` that are not
    merged yet (a metadata listing on the driver, no job)."""
    meta = current(spark, root, name)
    count = 0
    for path in meta["paths"][meta["merged"] :]:
        fs, hpath = _fs_path(spark, path)
        files = fs.listFiles(hpath, True)
        while files.hasNext():
            if files.next().getPath().getName().endswith(".parquet"):
                count += 1
    return count


def compact(spark: SparkSession, root: str, name: str, max_files: int) -> bool:
    """Merge the directories appended to ``name`` since the last merge when they
    hold more than ``max_files`` files: their rows are rewritten into a
    new directory that is never rewritten again.  Reading packs small files
    into full-size splits, so that directory has about one file per split.
    Each row is rewritten once, however large the table grows.  The old files
    are left as they are.  Returns whether a new version was published."""
    if not table_exists(spark, root, name) or data_files(spark, root, name) <= max_files:
        return False
    meta = current(spark, root, name)
    merged, small = meta["paths"][: meta["merged"]], meta["paths"][meta["merged"] :]
    path = _new_dir(root, name)
    rows = read_dirs(spark, root, name, small)
    observed_write(rows, path, "errorifexists", meta["partition_by"], _key_filter(name, rows.columns))
    side = {}
    if "unindexed" in (stream := meta.get("stream") or {}):
        # Rows that the stream has not met yet now stand in the merged directory.
        waiting = [p for p in stream["unindexed"] if p not in small]
        side = {"stream": {**stream, "unindexed": waiting + ([path] if len(waiting) < len(stream["unindexed"]) else [])}}
    _publish(spark, root, name, {**meta, **side, "paths": [*merged, path], "merged": len(merged) + 1})
    return True


def _leaves(spark: SparkSession, paths: list[str], by: str) -> list[str]:
    """The directories ``<by>=<value>`` of load directories; one that is such a directory already stays."""
    out = []
    for path in paths:
        if path.rsplit("/", 1)[1].startswith(f"{by}="):
            out.append(path)
            continue
        fs, hpath = _fs_path(spark, path)
        names = [st.getPath().getName() for st in fs.listStatus(hpath)]
        out += [f"{path}/{n}" for n in sorted(names) if n.startswith(f"{by}=")]
    return out


def refresh(
    spark: SparkSession, root: str, name: str, source: str, by: str, build: Callable[[DataFrame], DataFrame]
) -> list[str]:
    """Bring a mart, partitioned like its source table by ``by``, up to date with the loads since its last refresh.

    ``build`` makes the mart's rows of some partitions from the source's rows of
    the same partitions.  Only partitions that a new load directory of the
    source holds are read and built again, and one pointer replaces them; all others stay the files they are.
    Where the source was loaded in full or merged since, or the mart does not
    exist, all of it is built.  Returns the names of the partitions built.
    """
    src = current(spark, root, source)
    if src["partition_by"] != [by]:
        raise ValueError(f"table {source} is not partitioned by {by}")
    meta = current(spark, root, name) if table_exists(spark, root, name) else {}
    done = meta.get("inputs")
    every = _leaves(spark, src["paths"], by)
    if done is None or not set(done) <= set(src["paths"]):
        touched, kept = {p.rsplit("/", 1)[1] for p in every}, []
    else:
        touched = {p.rsplit("/", 1)[1] for p in _leaves(spark, [p for p in src["paths"] if p not in done], by)}
        kept = [p for p in _leaves(spark, meta["paths"], by) if p.rsplit("/", 1)[1] not in touched]
        if not touched:
            return []
    own = [p for p in every if p.rsplit("/", 1)[1] in touched]
    rows = read_dirs(spark, root, source, own) if own else read_table(spark, root, source).where(F.lit(False))
    df = build(rows)
    path = _new_dir(root, name)
    observed_write(df, path, "errorifexists", [by])
    paths = [*kept, *_leaves(spark, [path], by)] or [path]
    schema = json.loads(df.schema.json())
    _publish(spark, root, name, {"paths": paths, "merged": 0, "schema": schema, "partition_by": [by], "inputs": src["paths"]})
    return sorted(touched)


def vacuum(spark: SparkSession, root: str, name: str, keep: int = 10) -> int:
    """Bound the history of ``name``: pointers older than the latest ``keep`` and the directories that none of the
    kept ones names are removed, never those of the current version.  Returns the number of directories removed.

    A reader of an older version must have ended, and no load of the table
    may run (its directory is not named by any pointer yet).
    """
    if keep < 1:
        raise ValueError("keep must be at least 1")
    files = _pointer_files(spark, root, name)
    named = " ".join(_read_text(spark, f"{_pointer_dir(root, name)}/{f}") for f in files[-keep:])
    fs, base = _fs_path(spark, f"{root.rstrip('/')}/{name}")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    # Pointers first: no pointer ever names a directory that is gone.
    for f in files[:-keep]:
        fs.delete(path(f"{_pointer_dir(root, name)}/{f}"), False)
    removed = 0
    for status in fs.listStatus(base) if fs.exists(base) else []:
        own = status.getPath()
        folders = [own] if own.getName().startswith(f"{LOAD}=") else []
        if own.getName() == "_stream":
            folders = [x.getPath() for x in fs.listStatus(own)]
        for folder in folders:
            if f"/{folder.getName()}\"" not in named and f"/{folder.getName()}/" not in named:
                removed += bool(fs.delete(folder, True))
    return removed


def new_rows(incoming: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """Incoming rows whose key (compared as text, null-safe) is not stored.

    A small incoming batch is checked only against the stored keys it holds
    (found by a broadcast semi join over the stored key column, no shuffle
    of the store).  Otherwise, above the broadcast threshold, the stored keys
    are deduplicated map-side before the anti join (invoices may store one
    key many times)."""
    in_type = incoming.schema[key].dataType
    st_type = stored.schema[key].dataType
    in_key = column(key) if in_type == st_type else as_text(column(key), in_type)
    st_key = column(key) if in_type == st_type else as_text(column(key), st_type)
    probe = incoming.withColumn("_incoming_key", in_key)
    stored_keys = key_set(stored.select(st_key.alias("_stored_key")), probe.select("_incoming_key"))
    return probe.join(stored_keys, probe["_incoming_key"].eqNullSafe(stored_keys["_stored_key"]), "left_anti").drop(
        "_incoming_key"
    )


def holding_keys(stored: DataFrame, incoming: DataFrame, key: str, most: int = PUSHED_KEYS) -> DataFrame:
    """The stored rows that can share a key with ``incoming``.

    At most ``most`` distinct incoming keys are written into the filter of the
    scan, where the statistics and Bloom filters of a row group answer it
    before its rows are read.  With more keys, or keys of another type than the
    stored ones, all stored rows are returned; the join decides alike.
    """
    if incoming.schema[key].dataType != stored.schema[key].dataType:
        return stored
    found = [r[0] for r in incoming.select(column(key)).distinct().limit(most + 1).collect()]
    if len(found) > most:
        return stored
    # Single comparisons: a long list of values would be pushed as a range only.
    tests = [column(key) == F.lit(value) for value in found if value is not None]
    while len(tests) > 1:
        tests = [a | b for a, b in zip(tests[::2], tests[1::2])] + tests[len(tests) // 2 * 2 :]
    rows = stored.where(tests[0] if tests else F.lit(False))
    # Bloom filters do not know nulls: beside other values a null would have every row group read.
    return rows.unionByName(stored.where(column(key).isNull())) if None in found else rows


def load(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    root: str,
    mode: str,
    keys: Mapping[str, str] = PRIMARY_KEYS,
) -> dict[str, int]:
    """Full or incremental load; returns rows written per table."""
    if mode not in {"full", "incremental"}:
        raise ValueError("mode must be 'full' or 'incremental'")
    loaded: dict[str, int] = {}
    for name, df in tables.items():
        if mode == "full" or not table_exists(spark, root, name):
            loaded[name] = write_table(spark, root, name, df)
            continue
        stored = holding_keys(read_table(spark, root, name), df, keys[name])
        loaded[name] = append_rows(spark, root, name, new_rows(df, stored, keys[name]))
    return loaded


def write_parquet_layers(spark: SparkSession, root: str, out_dir: str) -> dict[str, str]:
    """A plain Parquet copy of each stored base table (for outside readers)."""
    paths = {}
    for name in PRIMARY_KEYS:
        if table_exists(spark, root, name):
            path = f"{out_dir.rstrip('/')}/{name}.parquet"
            read_table(spark, root, name).write.mode("overwrite").parquet(path)
            paths[name] = path
    return paths
