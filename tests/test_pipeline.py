"""End to end on sf 0.001: land files, ledger, ingest, models, tests, catalog."""

import datetime as dt

from conftest import SF_SMALL
from pyspark.sql import functions as F

from casegrade.operators.ledger import read_manifest
from casegrade.operators.staging import stage_claims, stage_medical
from casegrade.plans import pipeline as P
from casegrade.session import scratch_dir
from casegrade.sources import testtables as TT
from casegrade.sources.landing import land_csv, land_json_payloads


def test_run_pipeline_end_to_end(spark):
    lay = P.Layout(scratch_dir(spark, "t-pipeline"))
    for part in TT.claim_files_by_layout(spark, SF_SMALL):
        land_csv(part, lay.landing_claims)
    land_json_payloads(TT.medical_records(spark, SF_SMALL), lay.landing_medical)
    results = P.run_pipeline(spark, lay, report_date=dt.date(2026, 1, 1))
    rows = {(r.model, r.column_name, r.test): r for r in results.collect()}
    assert len(rows) == 22
    n_orders = TT.table(spark, SF_SMALL, "orders").count()
    n_claims = stage_claims(TT.raw_claims(spark, SF_SMALL)).count()
    assert rows[("stg_claims", "claim_id", "unique")].n_rows == n_claims < n_orders
    for column in ("claim_id", "date_of_loss", "body_part", "is_litigated", "number_of_priors"):
        test = "unique" if column == "claim_id" else "not_null"
        assert rows[("stg_claims", column, test)].n_failed > 0
    # 'physical therapy' is not an accepted event type: the test reports it
    assert rows[("stg_medical_activity", "event_type", "accepted_values")].n_failed == 1
    gold = spark.table("gold.high_complexity_claims_daily")
    assert gold.filter(F.col("complexity_band") != "HIGH").count() == 0
    assert gold.select(F.min("report_date")).first()[0] == dt.date(2026, 1, 1)
    n_lines = TT.table(spark, SF_SMALL, "lineitem").count()
    assert spark.table("bronze.raw_claims").count() == n_orders
    assert spark.table("bronze.raw_medical_activity").count() == n_lines
    assert spark.table("silver.stg_medical_activity").count() == stage_medical(TT.raw_medical(spark, SF_SMALL)).count()
    for name in ("bronze.raw_claims", "bronze.raw_medical_activity", "silver.stg_claims", "silver.stg_medical_activity",
                 "silver.int_claim_complexity_score", "audit.file_manifest", "audit.payload_manifest", "audit.dq_results"):
        described = spark.sql(f"describe table extended {name}").collect()
        assert {r.col_name: r.data_type for r in described}.get("Comment")
        columns = {r.col_name: r.comment for r in described}
        assert [c for c in spark.table(name).columns if not columns[c]] == [], name
    # ledger: one LANDED row per claim file; a second run records nothing new
    fm = read_manifest(spark, lay.file_manifest)
    n_files = fm.count()
    assert n_files > 0 and fm.filter(F.col("status") != "LANDED").count() == 0
    pm = read_manifest(spark, lay.payload_manifest, "payload")
    assert pm.agg(F.sum("record_count")).first()[0] == n_lines
    again = P.record_landed_files(spark, lay)
    assert again["files"] == {"landed": 0, "failed": 0}
    assert read_manifest(spark, lay.file_manifest).count() == n_files
    assert spark.table("audit.file_manifest").count() == n_files
    # a second run: a new gold run folder, the table points to it, bronze is not loaded again
    before = gold.count()
    P.run_pipeline(spark, lay, report_date=dt.date(2026, 1, 2))
    gold = spark.table("gold.high_complexity_claims_daily")
    assert gold.count() == before and gold.select(F.max("report_date")).first()[0] == dt.date(2026, 1, 2)
    assert spark.table("bronze.raw_medical_activity").count() == n_lines
    desc = {r.col_name: r.data_type for r in spark.sql("describe table extended gold.high_complexity_claims_daily").collect()}
    assert desc.get("Comment")


def test_command_line_tasks(spark, capsys):
    import json as _json

    from casegrade.__main__ import main
    lay = P.Layout(scratch_dir(spark, "t-cli"))
    for part in TT.claim_files_by_layout(spark, SF_SMALL):
        land_csv(part, lay.landing_claims)
    land_json_payloads(TT.medical_records(spark, SF_SMALL), lay.landing_medical)
    for task in ("ledger", "ingest-claims", "ingest-medical", "models"):
        assert main([task, "--base", lay.base, "--report-date", "2026-01-01"]) == 0
    capsys.readouterr()
    # the landed data is dirty: --strict reports it
    assert main(["test", "--base", lay.base, "--strict"]) == 1
    out = _json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["tests"]["total"] == 22 and out["tests"]["failed"] > 1


def test_failed_rebuild_leaves_the_last_run(spark):
    import pytest

    from casegrade.operators.mart import read_table, write_table
    d = scratch_dir(spark, "t-rebuild")
    good = spark.createDataFrame([(1,)], "a int")
    write_table(good, d)
    with pytest.raises(Exception):
        write_table(good.select(F.raise_error(F.lit("no")).cast("int").alias("a")), d)
    assert [r.a for r in read_table(spark, d, good.schema).collect()] == [1]


def test_no_machine_local_default_on_a_cluster(monkeypatch):
    import pytest

    from casegrade import session as S

    class Conf:
        @staticmethod
        def get(key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        @staticmethod
        def getCheckpointDir():
            return None

    class Session:
        conf, sparkContext = Conf, Context
    with pytest.raises(ValueError):
        S.shared_dir(Session)
