"""Property tests: cleaning against a brute-force model of the reference's rules.

The model walks the raw rows in order: the first copy of each key (null keys
form one group) is kept if its mrr parses as a number > 0 and its customer is
known (a null customer only when the customers have a null key).  Rejected
rows are the exact multiset complement.
"""

from __future__ import annotations

from collections import Counter
from decimal import Decimal, InvalidOperation

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from ledgerline.operators import clean

KEYS = st.sampled_from(["s1", "s2", "s3", "s4", None])
CUSTOMERS = st.sampled_from(["c1", "c2", "c3", None])
MRR = st.sampled_from(["10", "5.5", "0", "-1", "abc", "1e2", " 7 ", None])

RAW = T.StructType(
    [
        T.StructField("subscription_id", T.StringType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("mrr", T.StringType()),
        T.StructField("_ingest_row", T.LongType()),
    ]
)
PARENT = T.StructType([T.StructField("customer_id", T.StringType())])


def _positive(text):
    if text is None:
        return False
    try:
        return Decimal(text.strip()) > 0
    except InvalidOperation:
        return False


def _model(rows, customers):
    seen, kept = set(), []
    for key, customer, mrr in rows:
        if key in seen:
            continue
        seen.add(key)
        if _positive(mrr) and customer in customers:
            kept.append((key, customer, mrr))
    return kept


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    rows=st.lists(st.tuples(KEYS, CUSTOMERS, MRR), max_size=25),
    customers=st.sets(CUSTOMERS, max_size=4),
)
def test_clean_and_rejected_match_model(spark, rows, customers):
    raw = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], RAW)
    parent = spark.createDataFrame([(c,) for c in customers], PARENT)
    expected = _model(rows, customers)

    got = clean.clean_subscriptions(raw, parent).collect()
    assert sorted(((r["subscription_id"], r["customer_id"]) for r in got), key=repr) == sorted(
        ((k, c) for k, c, _ in expected), key=repr
    )
    for r in got:
        assert r["mrr"] == Decimal(next(m for k, _, m in expected if k == r["subscription_id"]).strip())

    rejected = clean.rejected_rows("subscriptions", raw, parent).collect()
    assert Counter((r["subscription_id"], r["customer_id"], r["mrr"]) for r in rejected) == Counter(
        rows
    ) - Counter(expected)
    for r in rejected:
        if r["customer_id"] not in customers:
            assert r["reject_reason"] == "missing_customer"
        elif not _positive(r["mrr"]):
            assert r["reject_reason"] == "not_positive"
        else:
            assert r["reject_reason"] == "duplicate_key"


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(keys=st.lists(st.sampled_from(["a", "b", "c", None]), max_size=40), chunk=st.integers(1, 6))
def test_duplicate_issues_match_model_for_any_chunking(spark, keys, chunk):
    from ledgerline.operators import contracts

    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k string, i long")
    issues = contracts.duplicate_key_issues("t", df, "k", chunk_rows=chunk).collect()
    expected = Counter({k: n - 1 for k, n in Counter(keys).items() if n > 1})
    assert Counter(r["row_reference"] for r in issues) == expected
    assert {(r["issue_type"], r["column_name"], r["issue_detail"]) for r in issues} <= {
        ("duplicate_key", "k", "Duplicate key")
    }
