import datetime as dt

import pytest
from conftest import claims_df, medical_df, raw_claim

from casegrade.operators.staging import medical_event_types, stage_claims, stage_medical


def test_claim_ids_trimmed_and_blank_dropped(spark):
    rows = [raw_claim(None), raw_claim(""), raw_claim("   "), raw_claim(" C1 "), raw_claim("007")]
    out = stage_claims(claims_df(spark, rows)).collect()
    assert sorted(r.claim_id for r in out) == ["007", "C1"]


def test_body_part_and_casts(spark):
    rows = [raw_claim("A", date="2026-01-05", body=" Spine ", lit="true", priors="3"),
            raw_claim("B", date="not a date", body="HEAD", lit="maybe", priors="x"),
            raw_claim("C", date=" 2026-1-5 ", body="\tback", lit="no", priors=" 3 "),
            raw_claim("D", date=None, body=None, lit="Y", priors="")]
    out = {r.claim_id: r for r in stage_claims(claims_df(spark, rows)).collect()}
    assert out["A"].body_part == "spine" and out["A"].date_of_loss == dt.date(2026, 1, 5)
    assert out["A"].is_litigated is True and out["A"].number_of_priors == 3
    assert out["B"].date_of_loss is None and out["B"].is_litigated is None and out["B"].number_of_priors is None
    assert out["B"].body_part == "head"
    assert out["C"].date_of_loss == dt.date(2026, 1, 5) and out["C"].is_litigated is False
    assert out["C"].number_of_priors == 3 and out["C"].body_part == "\tback"   # trim keeps tabs
    assert out["D"].is_litigated is True and out["D"].number_of_priors is None


def test_strict_cast_raises(spark):
    rows = [raw_claim("B", date="not a date")]
    with pytest.raises(Exception):
        stage_claims(claims_df(spark, rows), strict=True).collect()


def test_lineage_kept(spark):
    out = stage_claims(claims_df(spark, [raw_claim("A", rescued='{"x":"1"}', src="s.csv")])).collect()[0]
    assert out._source_file == "s.csv" and out._rescued_data == '{"x":"1"}' and out._ingested_at is not None


def test_medical_explode_and_filters(spark):
    rows = [(" C1 ", [(" Surgery ", "2026-02-01"), ("", "2026-02-02"), (None, None), ("other", "bad")], None, "m"),
            ("C2", [], None, "m"), ("C3", None, None, "m"), ("  ", [("surgery", None)], None, "m")]
    out = sorted((r.claim_id, r.event_type, r.event_date) for r in stage_medical(medical_df(spark, rows)).collect())
    assert out == [("C1", "other", None), ("C1", "surgery", dt.date(2026, 2, 1))]
    lean = sorted(tuple(r) for r in medical_event_types(medical_df(spark, rows)).collect())
    assert lean == [("C1", "other"), ("C1", "surgery")]
