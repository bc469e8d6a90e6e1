from conftest import claims_df, medical_df, raw_claim
from pyspark.sql import functions as F

from casegrade.operators import quality as Q
from casegrade.operators.mart import high_complexity_daily
from casegrade.operators.scoring import complexity_score
from casegrade.operators.staging import stage_claims, stage_medical


def test_22_declared_tests():
    assert len(Q.DECLARED_TESTS) == 22
    kinds = [t.test for t in Q.DECLARED_TESTS]
    assert (kinds.count("not_null"), kinds.count("unique"), kinds.count("accepted_values")) == (16, 3, 3)


def test_each_test_sees_its_violation(spark):
    claims = claims_df(spark, [
        raw_claim("C1", body="spine", lit="true", priors="3"),
        raw_claim("C1", body="spine", lit="true", priors="3"),        # duplicate id (T7)
        raw_claim("C2", date="bad", body=None, lit="maybe", priors="x"),
    ])
    meds = medical_df(spark, [("C1", [("surgery", None), ("massage", "2026-01-01")], None, "m")])
    stg_c, stg_m = stage_claims(claims), stage_medical(meds)
    scored = complexity_score(stg_c, stg_m)
    gold = high_complexity_daily(scored)
    rep = Q.dq_report({"stg_claims": stg_c, "stg_medical_activity": stg_m,
                       "int_claim_complexity_score": scored, "high_complexity_claims_daily": gold})
    got = {(r.model, r.column_name, r.test): (r.n_rows, r.n_failed, r.passed) for r in rep.collect()}
    assert len(got) == 22
    assert got[("stg_claims", "claim_id", "unique")] == (3, 1, False)
    assert got[("stg_claims", "date_of_loss", "not_null")] == (3, 1, False)
    assert got[("stg_claims", "body_part", "not_null")] == (3, 1, False)
    assert got[("stg_claims", "is_litigated", "not_null")] == (3, 1, False)
    assert got[("stg_claims", "number_of_priors", "not_null")] == (3, 1, False)
    assert got[("stg_medical_activity", "event_type", "accepted_values")] == (2, 1, False)
    assert got[("stg_medical_activity", "event_date", "not_null")] == (2, 1, False)
    assert got[("int_claim_complexity_score", "claim_id", "unique")] == (3, 1, False)
    assert got[("high_complexity_claims_daily", "claim_id", "unique")] == (2, 1, False)
    assert got[("high_complexity_claims_daily", "complexity_band", "accepted_values")] == (2, 0, True)
    assert got[("int_claim_complexity_score", "complexity_band", "accepted_values")] == (3, 0, True)


def test_accepted_values_counts_distinct_bad_values_and_ignores_null(spark):
    df = spark.createDataFrame([("a",), ("zz",), ("zz",), ("yy",), (None,)], "v string")
    t = Q.ColumnTest("m", "v", "accepted_values", ("a",))
    r = Q.run_tests(df, [t]).collect()[0]
    assert (r.n_rows, r.n_failed) == (5, 2)
    assert sorted(tuple(x) for x in Q.violations(df, t).collect()) == [("yy", 1), ("zz", 2)]


def test_unique_ignores_nulls(spark):
    df = spark.createDataFrame([(None,), (None,), ("x",)], "v string")
    r = Q.run_tests(df, [Q.ColumnTest("m", "v", "unique")]).collect()[0]
    assert (r.n_rows, r.n_failed) == (3, 0)


def test_gold_clock_columns_injectable(spark):
    import datetime as dt
    scored = complexity_score(stage_claims(claims_df(spark, [raw_claim("C1", body="back", lit="true", priors="5")])),
                              stage_medical(medical_df(spark, [("C1", [("surgery", None)], None, "m")])))
    g = high_complexity_daily(scored, report_date=F.lit(dt.date(2026, 3, 1))).collect()
    assert g[0].report_date == dt.date(2026, 3, 1) and g[0].processed_at is not None


def test_observed_checks_during_write(spark):
    from casegrade.session import scratch_dir
    df = spark.createDataFrame([("a", "HIGH"), (None, "LOW"), ("c", None)], "claim_id string, complexity_band string")
    tests = Q.tests_for("high_complexity_claims_daily")
    tests = [t for t in tests if t.column in ("claim_id", "complexity_band")]
    observed, obs = Q.observe_tests(df, tests)
    observed.write.mode("overwrite").parquet(scratch_dir(spark, "t-obs"))
    got = obs.get
    assert got["n_rows"] == 3 and got["claim_id:not_null"] == 1
    assert got["complexity_band:not_null"] == 1 and got["complexity_band:accepted_values_rows"] == 1
