"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the supplied test tables (or files Spark writes from
them) in full. Columns are named exactly as in the oracle SQL; clock
columns (``_ingested_at``, ``processed_at``) are left out of the compared
output because two engines cannot agree on "now".
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import quality
from ..operators.mart import high_complexity_daily, read_table, write_table
from ..operators.scoring import complexity_score, join_claims, medical_flags, score
from ..operators.skew import SkewGuard
from ..operators.staging import medical_event_types, stage_claims, stage_medical
from ..schemas import SCORED
from ..session import scratch_dir
from ..sources.testtables import raw_claims, raw_medical
from . import ingest_queries as IQ
from . import ledger_queries as LQ
from . import model_queries as MQ
from .oracle import CORE_SQL, INGEST_SQL, LEDGER_SQL, MODEL_SQL

SKEW_GUARD = SkewGuard()
REPORT_DATE = dt.date(2026, 1, 1)

Query = Callable[[SparkSession, str], DataFrame]


def _stg_claims(spark, sf):
    return stage_claims(raw_claims(spark, sf))


def _flags(spark, sf):
    return medical_flags(medical_event_types(raw_medical(spark, sf)))


def _joined(spark, sf):
    return join_claims(_stg_claims(spark, sf), _flags(spark, sf), SKEW_GUARD)


def _scored(spark, sf):
    return complexity_score(_stg_claims(spark, sf), medical_event_types(raw_medical(spark, sf)), SKEW_GUARD)


def _gold(spark, sf):
    return high_complexity_daily(_scored(spark, sf), report_date=F.lit(REPORT_DATE))


def models(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """The four tested models; the scored one is written once, as in the pipeline."""
    path = scratch_dir(spark, "dq-scored")
    write_table(_scored(spark, sf), path)
    scored = read_table(spark, path, SCORED)
    return {
        "stg_claims": _stg_claims(spark, sf),
        "stg_medical_activity": stage_medical(raw_medical(spark, sf)),
        "int_claim_complexity_score": scored,
        "high_complexity_claims_daily": high_complexity_daily(scored, report_date=F.lit(REPORT_DATE)),
    }


def q_stg_claims(spark, sf):
    return _stg_claims(spark, sf).select(
        "claim_id", "date_of_loss", "body_part", "is_litigated", "number_of_priors", "_source_file")


def q_stg_medical_activity(spark, sf):
    return stage_medical(raw_medical(spark, sf)).select("claim_id", "event_type", "event_date", "_source_file")


def q_medical_flags(spark, sf):
    return _flags(spark, sf)


def q_claim_medical_join(spark, sf):
    return _joined(spark, sf).drop("_ingested_at")


def q_complexity_score(spark, sf):
    return score(_joined(spark, sf)).drop("_ingested_at")


def q_complexity_band(spark, sf):
    return _scored(spark, sf).drop("_ingested_at")


def q_high_complexity_daily(spark, sf):
    return _gold(spark, sf).drop("processed_at", "_ingested_at")


def _dq(kinds, with_passed):
    def q(spark, sf):
        out = quality.dq_report(models(spark, sf), kinds)
        return out if with_passed else out.drop("passed")
    return q


def q_gold_rebuild(spark, sf):
    return MQ.gold_rebuild(spark, _scored(spark, sf))


def q_catalog_comments(spark, sf):
    return MQ.catalog_comments(spark, sf, _scored(spark, sf))


def q_dq_observed(spark, sf):
    return MQ.dq_observed(spark, models(spark, sf))


def q_dq_violations(spark, sf):
    return MQ.dq_violations(models(spark, sf))


QUERIES: dict[str, Query] = {
    "stg_claims": q_stg_claims,
    "stg_medical_activity": q_stg_medical_activity,
    "medical_flags": q_medical_flags,
    "claim_medical_join": q_claim_medical_join,
    "complexity_score": q_complexity_score,
    "complexity_band": q_complexity_band,
    "high_complexity_daily": q_high_complexity_daily,
    "dq_not_null": _dq(("not_null",), False),
    "dq_unique": _dq(("unique",), False),
    "dq_accepted_values": _dq(("accepted_values",), False),
    "dq_report": _dq(None, True),
    "ingest_claims_csv": IQ.q_ingest_claims_csv,
    "rescued_fields": IQ.q_rescued_fields,
    "ingest_medical_json": IQ.q_ingest_medical_json,
    "ingest_incremental": IQ.q_ingest_incremental,
    "json_dirty_records": IQ.q_json_dirty_records,
    "bronze_by_name": IQ.q_bronze_by_name,
    "lineage_to_ledger": IQ.q_lineage_to_ledger,
    "ledger_file_scan": LQ.q_ledger_file_scan,
    "ledger_duplicates": LQ.q_ledger_duplicates,
    "ledger_new_files": LQ.q_ledger_new_files,
    "payload_hash": LQ.q_payload_hash,
    "payload_record_count": LQ.q_payload_record_count,
    "payload_manifest": LQ.q_payload_manifest,
    "ledger_status": LQ.q_ledger_status,
    "ledger_append": LQ.q_ledger_append,
    "ledger_runs": LQ.q_ledger_runs,
    "ledger_payload_pages": LQ.q_ledger_payload_pages,
    "ingest_medical_split": IQ.q_ingest_medical_split,
    "ingest_table_sink": IQ.q_ingest_table_sink,
    "inferred_types": MQ.q_inferred_types,
    "payload_file_names": MQ.q_payload_file_names,
    "schema_registry": MQ.q_schema_registry,
    "gold_rebuild": q_gold_rebuild,
    "catalog_comments": q_catalog_comments,
    "dq_observed": q_dq_observed,
    "dq_violations": q_dq_violations,
}

ORACLE_SQL: dict[str, str] = {**CORE_SQL, **INGEST_SQL, **LEDGER_SQL, **MODEL_SQL}
