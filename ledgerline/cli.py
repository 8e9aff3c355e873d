"""spark-submit entry point: ``python -m ledgerline.cli <command> --base <dir>``.

Commands: ``run-pipeline [--mode full|incremental]``, ``validate-contracts``,
``export-marts``, ``health-check``, ``stream-load`` (files landed under
``<base>/landing/<table>``, the JSON-lines table in ``product_events.jsonl``).  ``--base`` is the project root holding
``raw/``; warehouse and exports are written under it (any Hadoop URI).
"""

from __future__ import annotations

import argparse
import json

from ledgerline.plans import pipeline
from ledgerline.plans.settings import default_settings
from ledgerline.session import build_session
from ledgerline.streaming.load import stream_load


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="ledgerline")
    parser.add_argument("--base", required=True, help="project root with raw/ (local path or URI)")
    parser.add_argument("--master", default=None, help="Spark master (default: from spark-submit)")
    parser.add_argument("--settings", default=None, help="JSON file whose entries replace the default settings")
    sub = parser.add_subparsers(dest="command", required=True)
    run = sub.add_parser("run-pipeline")
    run.add_argument("--mode", choices=["full", "incremental"], default="full")
    sub.add_parser("validate-contracts")
    sub.add_parser("export-marts")
    sub.add_parser("health-check")
    stream = sub.add_parser("stream-load", help="load files landed under <base>/landing/<table>")
    stream.add_argument("--checkpoint", default=None, help="stream checkpoints (default <base>/checkpoints/load)")
    args = parser.parse_args(argv)

    spark = build_session(args.master)
    settings = default_settings(args.base)
    if args.settings:
        settings |= json.loads(spark.read.text(args.settings, wholetext=True).first()[0])
    if args.command == "run-pipeline":
        out = pipeline.run_pipeline(spark, settings, args.mode)
        print(f"Warehouse: {out['warehouse']}")
        print(f"Exports: {out['exports']}")
    elif args.command == "validate-contracts":
        _, breakdown = pipeline.validate(spark, settings)
        print(f"Contract issues found: {sum(n for _, _, n in breakdown)}")
        for table, issue, n in breakdown:
            print(f"{table}\t{issue}\t{n}")
    elif args.command == "export-marts":
        for name in pipeline.export_existing_marts(spark, settings):
            print(f"- {name}")
    elif args.command == "health-check":
        pipeline.health_check(spark, settings)
        print("Health checks passed.")
    elif args.command == "stream-load":
        base = args.base.rstrip("/")
        landing = {
            name: f"{base}/landing/{name}" + (".jsonl" if path.endswith(".jsonl") else "")
            for name, path in settings["raw_files"].items()
        }
        checkpoint = args.checkpoint or f"{base}/checkpoints/load"
        for name, n in stream_load(spark, landing, settings["warehouse"], checkpoint, settings["contracts"]).items():
            print(f"{name}\t{n}")


if __name__ == "__main__":
    main()
