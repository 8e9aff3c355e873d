"""Subscription analytics on Spark.

Lazy DataFrame operators for a subscription business: data contracts that
report violations as rows, cleaning into silver tables, full and incremental
loads, revenue / churn / adoption / health marts, quality scores, health
checks and billing schedules.  Every operator takes and returns DataFrames and
leaves planning to Catalyst; nothing is collected except bounded summaries.
"""

from ledgerline.session import build_session, scratch_path

__all__ = ["build_session", "scratch_path"]
