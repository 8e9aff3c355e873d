"""Column expressions that turn raw values into typed ones.

Bronze tables read from CSV are all strings; the driver views are already
typed.  Every helper takes the column's Spark type (known from the schema on
the driver, no job) and builds a pure JVM expression, so it stays inside
whole-stage codegen.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Text that a CSV reader of the reference treats as missing
# (the pandas default NA token list).
NULL_TOKENS = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]

# A decimal literal (optional sign, digits with an optional point, optional
# exponent) or an infinity / NaN word.  Spark's own string->double cast also
# accepts suffixes such as ``1d`` or ``5f``; the guard rejects them.
_NUMERIC_TEXT = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity|nan))\s*$"

MONEY = T.DecimalType(18, 2)

# Money parsed from text or doubles: ten decimals are kept, so that only sums
# are rounded, and a sum has ten more digits before it can overflow.
PARSED_MONEY = T.DecimalType(28, 10)


def null_tokens_to_null(col: Column) -> Column:
    return F.when(col.isin(NULL_TOKENS), F.lit(None).cast("string")).otherwise(col)


def as_text(col: Column, dtype: T.DataType) -> Column:
    """Stringified value as used for key comparison and issue references."""
    return col if isinstance(dtype, T.StringType) else col.cast("string")


def as_number(col: Column, dtype: T.DataType) -> Column:
    """DOUBLE value or null: unparsable text, null and NaN are all null."""
    if isinstance(dtype, T.StringType):
        value = F.when(col.rlike(_NUMERIC_TEXT), F.trim(col).try_cast("double"))
    elif isinstance(dtype, (T.NumericType, T.BooleanType)):
        value = col.cast("double")
    else:
        value = col.cast("string").try_cast("double")
    return F.when(~F.isnan(value), value)


def as_money(col: Column, dtype: T.DataType) -> Column:
    """Decimal money with the precision it came with: decimals stay as they
    are, all else becomes ``PARSED_MONEY``.  Null when the value is not a
    finite number or not below 1e18."""
    if isinstance(dtype, T.DecimalType):
        return col
    if isinstance(dtype, T.StringType):
        exact = F.trim(col).try_cast(PARSED_MONEY)
        return F.when(col.rlike(_NUMERIC_TEXT), F.coalesce(exact, as_number(col, dtype).try_cast(PARSED_MONEY)))
    return as_number(col, dtype).try_cast(PARSED_MONEY)


def as_timestamp(col: Column, dtype: T.DataType, fmt: str | tuple[str, ...] = "yyyy-MM-dd") -> Column:
    """Timestamp or null.  Text must match one of ``fmt`` exactly (no lenient casts)."""
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return col.cast("timestamp")
    text = as_text(col, dtype)
    formats = (fmt,) if isinstance(fmt, str) else tuple(fmt)
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in formats])


def as_date(col: Column, dtype: T.DataType, fmt: str | tuple[str, ...] = "yyyy-MM-dd") -> Column:
    if isinstance(dtype, T.DateType):
        return col
    return F.to_date(as_timestamp(col, dtype, fmt))


def matches_from_start(text: Column, pattern: str) -> Column:
    """Match anchored at the start only (like ``re.match``); null never matches."""
    return F.coalesce(text.rlike(f"^(?:{pattern})"), F.lit(False))


def decimal_literal(value: float | int | str) -> Column:
    """An exact literal for a weight such as 0.4 (decimal, not binary)."""
    dec = Decimal(str(value))
    return F.lit(dec)


def round_half_away(col: Column, digits: int) -> Column:
    """ROUND of a DOUBLE scaled in binary, ties away from zero.

    This is how the reference's SQL engine rounds doubles
    (``round(x * 10^d) / 10^d``): ``round(1.005, 2)`` is 1.0 there.  Spark's
    ``round`` on a double rounds the shortest decimal text instead, so the
    scaling is done here in double arithmetic first.
    """
    scale = float(10**digits)
    scaled = col.cast("double") * F.lit(scale)
    return F.round(scaled, 0) / F.lit(scale)
