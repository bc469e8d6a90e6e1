"""Every registered query with an oracle equals its DuckDB SQL (sf 0.001)."""

import pytest
from conftest import SF_SMALL

import __spark_entry__ as E
from tools.compare import compare


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "complexity_band" in df.columns


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, name):
    res = compare(spark, SF_SMALL, [name])
    assert res[name] is True


def test_every_query_has_oracle_or_is_listed():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_planned_query_keys_are_registered():
    planned = {"stg_claims", "stg_medical_activity", "medical_flags", "claim_medical_join", "complexity_score",
               "complexity_band", "high_complexity_daily", "dq_not_null", "dq_unique", "dq_accepted_values",
               "dq_report", "ingest_claims_csv", "ingest_medical_json", "ingest_incremental", "rescued_fields",
               "payload_hash", "payload_record_count", "ledger_file_scan", "ledger_status", "ledger_append",
               "ledger_new_files", "ledger_duplicates"}
    assert planned <= set(E.queries())
    from casegrade.plans.registry import ORACLE_SQL, QUERIES
    assert set(QUERIES) == set(ORACLE_SQL)
