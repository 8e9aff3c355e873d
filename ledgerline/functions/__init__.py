from ledgerline.functions.coerce import (
    MONEY,
    PARSED_MONEY,
    NULL_TOKENS,
    as_date,
    as_money,
    as_number,
    as_text,
    as_timestamp,
    decimal_literal,
    matches_from_start,
    null_tokens_to_null,
    round_half_away,
)
from ledgerline.functions.order import INGEST_PREFIX, column, data_columns, ingest_order

__all__ = [
    "MONEY",
    "PARSED_MONEY",
    "NULL_TOKENS",
    "INGEST_PREFIX",
    "as_date",
    "as_money",
    "as_number",
    "as_text",
    "as_timestamp",
    "column",
    "data_columns",
    "decimal_literal",
    "ingest_order",
    "matches_from_start",
    "null_tokens_to_null",
    "round_half_away",
]
