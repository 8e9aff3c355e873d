"""Row order of raw tables.

Spark has no row order, but "keep the first copy of a key" needs one.  Raw
tables carry ``_ingest_*`` columns that record where each row came from
(file path, split offset, a per-split increasing id); tables without them are
ordered by all their columns, which decides every tie that can show in the
output.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

INGEST_PREFIX = "_ingest_"
# Together they name a row of an ingested table.
INGEST_COLUMNS = ("_ingest_file", "_ingest_offset", "_ingest_row")

# Holds the text of a malformed JSON line in a raw table.
CORRUPT = "_corrupt_record"


def column(name: str) -> Column:
    """A top-level column by its exact name.  Raw headers may hold dots,
    spaces or backticks; quoted, they stay part of the name instead of
    being read as struct access."""
    return F.col("`" + name.replace("`", "``") + "`")


def ingest_order(df: DataFrame) -> list[str]:
    """Order columns: the ``_ingest_*`` columns first, then every data column."""
    ingest = [c for c in df.columns if c.startswith(INGEST_PREFIX)]
    return ingest + [c for c in df.columns if not c.startswith(INGEST_PREFIX)]


def data_columns(df: DataFrame) -> list[str]:
    """The columns that belong in a silver table (no ingest bookkeeping)."""
    return [c for c in df.columns if not c.startswith(INGEST_PREFIX)]
