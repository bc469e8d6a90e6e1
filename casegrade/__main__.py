"""Command line: run the pipeline, or one task of it, on a folder layout.

    python -m casegrade ingest-claims --base /data/claims
    spark-submit --py-files casegrade.zip casegrade_job.py all --base s3://bucket/claims

Tasks (each can be scheduled on its own, in this order):
  ledger          record landed claim files and medical payloads (hash, size, count, status)
  ingest-claims   claims CSV files -> bronze (availableNow)
  ingest-medical  medical JSON files -> bronze (availableNow; --json-layout lines for JSON Lines feeds)
  models          staging -> scored table -> gold table
  test            the 22 declared column tests -> dq_results (exit code 1 when any fails, with --strict)
  register        namespaces, tables and comments in the catalog
  all             every task above
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from pyspark.sql import functions as F

from .plans import pipeline as P
from .session import get_session
from .streaming.claims_csv import ingest_claims_csv
from .streaming.medical_json import ingest_medical_json

TASKS = ("ledger", "ingest-claims", "ingest-medical", "models", "test", "register", "all")


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="casegrade", description=__doc__.splitlines()[0])
    ap.add_argument("task", choices=TASKS)
    ap.add_argument("--base", help="base folder of the layout (default: under spark.checkpoint.dir)")
    ap.add_argument("--report-date", type=dt.date.fromisoformat, help="report_date of the gold table (default today)")
    ap.add_argument("--json-layout", choices=("document", "lines"), default="document")
    ap.add_argument("--no-skew-guard", action="store_true")
    ap.add_argument("--strict", action="store_true", help="exit 1 when a declared test fails")
    args = ap.parse_args(argv)

    spark = get_session()
    lay = P.Layout(args.base) if args.base else P.Layout.under_shared_dir(spark)
    guard = None if args.no_skew_guard else P.SkewGuard()
    run = set(TASKS[:-1]) if args.task == "all" else {args.task}
    out: dict = {"base": lay.base}

    if "ledger" in run:
        out["ledger"] = P.record_landed_files(spark, lay, args.json_layout)
    if "ingest-claims" in run:
        ingest_claims_csv(spark, lay.landing_claims, lay.bronze_claims, lay.checkpoint_claims).awaitTermination()
    if "ingest-medical" in run:
        ingest_medical_json(spark, lay.landing_medical, lay.bronze_medical, lay.checkpoint_medical,
                            layout=args.json_layout).awaitTermination()
    failed = 0
    if "models" in run or "test" in run:
        report_date = F.lit(args.report_date) if args.report_date else None
        if "models" in run:
            models = P.build_models(spark, lay, report_date, None, guard)
        else:
            models = P.stored_models(spark, lay)
        if "test" in run:
            results = P.run_tests(spark, lay, models).collect()      # 22 rows
            failed = sum(1 for r in results if not r.passed)
            out["tests"] = {"total": len(results), "failed": failed}
    if "register" in run:
        P.register(spark, lay)
    print(json.dumps(out, default=str))
    return 1 if (args.strict and failed) else 0


if __name__ == "__main__":
    sys.exit(main())
