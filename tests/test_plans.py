"""Plan shape checks: pruning, pushdown and the number of shuffles."""

import re

from conftest import SF_SMALL, claims_df, medical_df, raw_claim
from pyspark.sql import functions as F

from casegrade.operators.scoring import complexity_score
from casegrade.operators.skew import SkewGuard
from casegrade.operators.staging import medical_event_types, stage_claims, stage_medical
from casegrade.session import scratch_dir
from casegrade.sources.testtables import raw_claims, raw_medical


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _bronze(spark):
    d = scratch_dir(spark, "t-plans")
    raw_claims(spark, SF_SMALL).write.parquet(f"{d}/claims")
    raw_medical(spark, SF_SMALL).write.parquet(f"{d}/medical")
    return spark.read.parquet(f"{d}/claims"), spark.read.parquet(f"{d}/medical")


def test_flags_path_reads_only_the_event_type(spark):
    _, med = _bronze(spark)
    plan = _plan(medical_event_types(med))
    assert "medical_events:array<struct<type:string>>" in plan
    assert "claim_id" in re.search(r"DataFilters: \[([^\]]*)\]", plan).group(1)


def test_scored_model_has_two_shuffles_both_on_claim_id(spark):
    claims, med = _bronze(spark)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = _plan(complexity_score(stage_claims(claims), medical_event_types(med), None))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    exchanges = re.findall(r"Exchange hashpartitioning\((\w+)#", plan)
    assert exchanges == ["claim_id", "claim_id"]
    assert "partial_max" in plan and "SortMergeJoin" in plan


def test_claim_filter_reaches_the_scan(spark):
    claims, _ = _bronze(spark)
    plan = _plan(stage_claims(claims))
    assert "DataFilters: [isnotnull(trim(claim_id" in plan


def test_hot_claim_id_is_salted_and_result_unchanged(spark):
    # one claim id holds a third of all claim rows
    rows = [raw_claim("HOT" if i % 3 == 0 else f"C{i}", body="spine", lit="true", priors=str(i % 5)) for i in range(3000)]
    claims = stage_claims(claims_df(spark, rows))
    meds = stage_medical(medical_df(spark, [("HOT", [("surgery", None)], None, "m"),
                                            ("C1", [("opioid prescription", None)], None, "m")]))
    guard = SkewGuard(sample_fraction=0.5, buckets=8, partitions=100)
    salted = complexity_score(claims, meds, guard)
    assert "_salt" in salted._jdf.queryExecution().optimizedPlan().toString()
    plain = complexity_score(claims, meds, None)
    cols = ["claim_id", "number_of_priors", "has_surgery", "has_opioid", "complexity_score", "complexity_band"]
    assert sorted(map(tuple, salted.select(cols).collect())) == sorted(map(tuple, plain.select(cols).collect()))
    assert salted.filter(F.col("claim_id") == "HOT").count() == 1000
