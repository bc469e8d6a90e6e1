"""Benchmark: land files from the test tables, then time the pipeline steps.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Prints ONE JSON line. ``value`` is the sum of the timed steps (seconds):
  ingest_claims_csv    CSV landing folder -> bronze (availableNow)
  ingest_medical_json  JSON landing folder -> bronze (availableNow)
  high_complexity_daily bronze -> staging -> scored table -> gold table (median of 3)
  dq_report            the 22 declared tests over the four models (median of 3)
  ledger_file_scan     manifest rows (size + SHA-256) of the landed claim files
  ledger_payloads      manifest rows (SHA-256 + record count) of the landed payloads
  run_pipeline         every step of a later run over the landed files: ledgers,
                       streams with nothing new, models, gold, tests, catalog
  scoring_chain_noop   stage -> flags -> join -> score -> band to the noop sink
Landing the files (setup) is reported separately and not in ``value``.
Before the timed ingests, one untimed warm-up ingest of files landed from
the next smaller supplied scale (sf 0.01 for sf 0.1) runs the same code
paths, so the ingest figures are steady-state rather than JVM warm-up; the same
holds for the ledger scan. ``machine_loop`` (extra) times a fixed CPU loop.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from casegrade.operators import ledger as L  # noqa: E402
from casegrade.operators import quality as Q  # noqa: E402
from casegrade.operators.mart import read_table  # noqa: E402
from casegrade.operators.scoring import complexity_score  # noqa: E402
from casegrade.operators.staging import medical_event_types, stage_claims  # noqa: E402
from casegrade.plans import pipeline as P  # noqa: E402
from casegrade.schemas import API_MEDICAL_ACTIVITY, GOLD, SCORED, SFTP_CLAIMS  # noqa: E402
from casegrade.session import get_session, scratch_dir  # noqa: E402
from casegrade.sources import testtables as TT  # noqa: E402
from casegrade.sources.landing import land_csv, land_json_payloads  # noqa: E402
from casegrade.streaming.claims_csv import ingest_claims_csv, read_bronze_claims  # noqa: E402
from casegrade.streaming.medical_json import ingest_medical_json, read_bronze_medical  # noqa: E402


def warmup_dir(sf_dir: str) -> str | None:
    """The largest supplied scale below the benchmarked one, if any."""
    base, here = os.path.dirname(sf_dir), os.path.basename(sf_dir)
    try:
        target = float(here.replace("sf", ""))
        scales = sorted((float(d[2:]), d) for d in os.listdir(base)
                        if d.startswith("sf") and d[2:].replace(".", "").isdigit())
    except (ValueError, OSError):
        return None
    smaller = [d for v, d in scales if v < target]
    return os.path.join(base, smaller[-1]) if smaller else None


def machine_seconds() -> float:
    """A fixed CPU loop, so that runs on other machines can be compared."""
    t = time.perf_counter()
    total = 0
    for i in range(20_000_000):
        total += i & 7
    return time.perf_counter() - t


def timed(fn):
    t = time.perf_counter()
    out = fn()
    return time.perf_counter() - t, out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    # local mode: the driver JVM is the whole cluster, so give it a real heap
    mem = os.environ.get("BENCH_DRIVER_MEMORY", "16g")
    spark = get_session(f"local[{cpus}]", cpus, extra_conf={"spark.driver.memory": mem})
    lay = P.Layout(scratch_dir(spark, "bench"))
    queries, extra = {}, {}

    extra["machine_loop"] = machine_seconds()

    def land():
        for part in TT.claim_files_by_layout(spark, sf_dir):
            land_csv(part, lay.landing_claims)
        land_json_payloads(TT.medical_records(spark, sf_dir), lay.landing_medical)
    extra["land_files_setup"], _ = timed(land)

    warm_dir = warmup_dir(sf_dir)
    if warm_dir:
        warm = P.Layout(scratch_dir(spark, "bench-warmup"))
        for part in TT.claim_files_by_layout(spark, warm_dir):
            land_csv(part, warm.landing_claims)
        land_json_payloads(TT.medical_records(spark, warm_dir), warm.landing_medical)
        t_warm = time.perf_counter()
        ingest_claims_csv(spark, warm.landing_claims, warm.bronze_claims, warm.checkpoint_claims).awaitTermination()
        ingest_medical_json(spark, warm.landing_medical, warm.bronze_medical, warm.checkpoint_medical).awaitTermination()
        extra["warmup_ingest"] = time.perf_counter() - t_warm
        L.scan_files(spark, warm.landing_claims, SFTP_CLAIMS).write.format("noop").mode("overwrite").save()
        extra["warmup_sf"] = os.path.basename(warm_dir)

    queries["ingest_claims_csv"], _ = timed(lambda: ingest_claims_csv(
        spark, lay.landing_claims, lay.bronze_claims, lay.checkpoint_claims).awaitTermination())
    queries["ingest_medical_json"], _ = timed(lambda: ingest_medical_json(
        spark, lay.landing_medical, lay.bronze_medical, lay.checkpoint_medical).awaitTermination())
    n_claims = read_bronze_claims(spark, lay.bronze_claims).count()
    n_medical = read_bronze_medical(spark, lay.bronze_medical).count()
    extra["claims_rows_per_sec"] = round(n_claims / queries["ingest_claims_csv"])
    extra["medical_rows_per_sec"] = round(n_medical / queries["ingest_medical_json"])

    models = {}

    def gold():
        models.update(P.build_models(spark, lay))
    runs = [timed(gold)[0] for _ in range(4)]           # first run warms up
    queries["high_complexity_daily"] = statistics.median(runs[1:])

    def dq():
        return Q.dq_report(models).collect()
    runs = [timed(dq)[0] for _ in range(4)]
    queries["dq_report"] = statistics.median(runs[1:])

    queries["ledger_file_scan"], _ = timed(lambda: L.scan_files(
        spark, lay.landing_claims, SFTP_CLAIMS).write.format("noop").mode("overwrite").save())
    queries["ledger_payloads"], ledger = timed(lambda: L.record_payloads(
        spark, lay.landing_medical, lay.payload_manifest, API_MEDICAL_ACTIVITY))
    extra["payloads"] = ledger["landed"]
    queries["run_pipeline"], _ = timed(lambda: P.run_pipeline(spark, lay).collect())

    def chain():
        raw_c = read_bronze_claims(spark, lay.bronze_claims)
        raw_m = read_bronze_medical(spark, lay.bronze_medical)
        scored = complexity_score(stage_claims(raw_c), medical_event_types(raw_m), P.SkewGuard())
        scored.write.format("noop").mode("overwrite").save()
    runs = [timed(chain)[0] for _ in range(5)]
    queries["scoring_chain_noop"] = statistics.median(runs[1:])

    extra["gold_rows"] = read_table(spark, lay.high_complexity_claims_daily, GOLD).count()
    extra["bands"] = {r.complexity_band: r.n for r in read_table(spark, lay.int_claim_complexity_score, SCORED)
                      .groupBy("complexity_band").agg(F.count("*").alias("n")).collect()}
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({
        "metric": "pipeline_total_sec",
        "value": round(sum(queries.values()), 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in queries.items()},
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": cpus,
        "extra": {k: (round(v, 3) if isinstance(v, float) else v) for k, v in extra.items()},
    }))


if __name__ == "__main__":
    main()
