"""Summarise the physical plan of every lazy driver query (no execution).

usage: python tools/plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import re
import sys
from collections import Counter

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from ledgerline.plans.driver import QUERIES  # noqa: E402
from ledgerline.session import build_session  # noqa: E402

# Queries that write or run a stream when called are left out.
EAGER = {
    "parquet_roundtrip", "export_roundtrip", "export_mart_mrr", "export_mart_churn", "export_mart_feature_adoption",
    "export_executive_overview", "mrr_reconciliation", "stream_feature_adoption", "stream_incremental_load",
    "stream_planted",
}
NODES = [
    "Exchange",
    "BroadcastExchange",
    "SortMergeJoin",
    "BroadcastHashJoin",
    "ShuffledHashJoin",
    "BroadcastNestedLoopJoin",
    "CartesianProduct",
    "HashAggregate",
    "SortAggregate",
    "ObjectHashAggregate",
    "Window",
    "Expand",
    "Generate",
]


def table(spark, sf: str) -> None:
    print("| query | " + " | ".join(NODES) + " | pushed filters |")
    print("|---" * (len(NODES) + 2) + "|")
    for key, fn in QUERIES.items():
        if key in EAGER:
            continue
        plan = fn(spark, sf)._jdf.queryExecution().executedPlan().toString()
        counts = Counter()
        for line in plan.split("\n"):
            m = re.search(r"(?:\+- |:- |^)(?:\*\(\d+\) )?([A-Za-z]+)", line.strip())
            if m:
                counts[m.group(1)] += 1
        pushed = sorted(set(re.findall(r"PushedFilters: \[([^\]]+)\]", plan)))
        cells = [str(counts.get(n, 0)) for n in NODES]
        print(f"| {key} | " + " | ".join(cells) + f" | {'; '.join(pushed)[:120]} |")


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", shuffle_partitions=16)
    print("# Physical plans of the driver queries\n")
    print(f"Initial (pre-AQE) plans at `{sf}`, from `tools/plan_report.py`. Counts are plan nodes;")
    print("`Exchange` counts shuffles, `BroadcastExchange` size-checked broadcasts (AQE may turn")
    print("more sort-merge joins into broadcasts at run time when a side is measured small).\n")
    print("## Local shape (default broadcast threshold)\n")
    table(spark, sf)
    print("\n## Large-table shape (no side under the broadcast threshold)\n")
    print("The same queries planned with `spark.sql.autoBroadcastJoinThreshold=-1`: what the")
    print("plans become when no side fits under the threshold, as at 100 TB.\n")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    table(spark, sf)
    spark.stop()


if __name__ == "__main__":
    main()
