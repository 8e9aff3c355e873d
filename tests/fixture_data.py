"""The hand fixture: five small raw files with planted defects.

Expected results are in the tests; they were derived by hand from the
reference's documented rules.
"""

from __future__ import annotations

import json
import os

CUSTOMERS = [
    "customer_id,customer_name,segment,country,signup_date",
    "C-0001,Acme,SMB,Egypt,2024-01-05",
    "C-0002,Beta,Enterprise,Germany,2024-02-01",
    "C-0002,Beta,Enterprise,Germany,2024-02-01",
    "C-0003,Gamma,startup,UAE,2026-01-01",
    "X-1,Bad,Gov,Egypt,not-a-date",
]

SUBSCRIPTIONS = [
    "subscription_id,customer_id,plan,start_date,end_date,status,mrr",
    "S-00001,C-0001,Starter,2025-01-10,,active,49",
    "S-00002,C-0002,Scale,2025-01-15,2025-03-20,cancelled,399",
    "S-00003,C-0001,Growth,2025-02-01,,trial,0",
    "S-00003,C-0001,Growth,2025-02-01,,trial,149",
    "S-00004,C-9999,Starter,2025-02-01,,active,49",
    "S-00005,C-0003,Growth,2025-04-01,,trial,149",
    "S-00006,C-0002,Starter,2025-01-01,2025-03-31,cancelled,abc",
]

INVOICES = [
    "invoice_id,customer_id,invoice_month,amount,status",
    "I-000001,C-0001,2025-01-01,49,paid",
    "I-000002,C-0002,2025-01-01,399,paid",
    "I-000003,C-0003,2025-01-01,74.5,failed",
    "I-000003,C-0003,2025-01-01,74.5,failed",
    "I-000004,C-0001,2025-02-01,49,PAID",
    "I-000005,C-0002,2025-02-01,399,refunded",
]

EVENT_FIELDS = ["event_id", "customer_id", "user_id", "event_time", "feature", "event_type"]
EVENTS = [
    ("E-0000001", "C-0001", "U-0001", "2025-01-02", "Dashboard", "view"),
    ("E-0000002", "C-0001", "U-0002", "2025-01-03", "Reports", "click"),
    ("E-0000003", "C-0002", "U-0003", "2025-01-04", "Dashboard", "export"),
    ("E-0000003", "C-0002", "U-0003", "2025-01-04", "Dashboard", "export"),
    ("E-0000004", "C-9999", "U-0009", "2025-01-05", "Billing", "view"),
]

TICKETS = [
    "ticket_id,customer_id,opened_date,priority,status,category",
    "T-00001,C-0001,2025-01-10,high,open,billing",
    "T-00002,C-0001,2025-01-11,low,solved,bug",
]


def write_lines(path: str, lines: list[str]) -> None:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as fh:
        fh.write("\n".join(lines) + "\n")


def write_events(path: str, rows) -> None:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as fh:
        for row in rows:
            fh.write(json.dumps(dict(zip(EVENT_FIELDS, row))) + "\n")


def write_fixture(base: str) -> None:
    raw = os.path.join(base, "raw")
    write_lines(os.path.join(raw, "customers.csv"), CUSTOMERS)
    write_lines(os.path.join(raw, "subscriptions.csv"), SUBSCRIPTIONS)
    write_lines(os.path.join(raw, "invoices.csv"), INVOICES)
    write_events(os.path.join(raw, "product_events.jsonl"), EVENTS)
    write_lines(os.path.join(raw, "support_tickets.csv"), TICKETS)
