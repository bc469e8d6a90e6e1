import itertools

from conftest import claims_df, medical_df, raw_claim

from casegrade.functions import rules as R
from casegrade.operators.scoring import complexity_score, medical_flags
from casegrade.operators.skew import SkewGuard
from casegrade.operators.staging import stage_claims, stage_medical


def expected(body, lit, priors, surg, opi):
    s = (15 if body in ("spine", "head", "back") else 0) + (20 if lit else 0) + (10 if priors >= 3 else 0) \
        + (25 if surg else 0) + (15 if opi else 0)
    return s, ("HIGH" if s >= 50 else "MEDIUM" if s >= 30 else "LOW")


def test_truth_table_all_32_combinations(spark):
    claims, meds, want = [], [], {}
    for i, (body, lit, priors, surg, opi) in enumerate(itertools.product(
            ["knee", "spine"], [False, True], [2, 3], [0, 1], [0, 1])):
        cid = f"C{i}"
        claims.append(raw_claim(cid, body=body, lit=str(lit).lower(), priors=str(priors)))
        events = [("physical therapy", "2026-01-01")]
        if surg:
            events.append(("Surgery ", "2026-01-02"))
        if opi:
            events.append((" opioid prescription", None))
        meds.append((cid, events, None, "m.json"))
        want[cid] = expected(body, lit, priors, surg, opi)
    scored = complexity_score(stage_claims(claims_df(spark, claims)),
                              stage_medical(medical_df(spark, meds)), SkewGuard())
    got = {r.claim_id: (r.complexity_score, r.complexity_band) for r in scored.collect()}
    assert got == want
    bands = [b for _, b in want.values()]
    assert (bands.count("HIGH"), bands.count("MEDIUM"), bands.count("LOW")) == (13, 11, 8)
    assert sorted({s for s, _ in want.values()}) == [0, 10, 15, 20, 25, 30, 35, 40, 45, 50, 55, 60, 65, 70, 75, 85]


def test_hand_made_edges(spark):
    # (body, litigated, priors, surgery, opioid) -> score, band
    cases = [
        ("knee", "false", "0", 0, 0, 0, "LOW"),
        ("spine", "false", "3", 0, 0, 25, "LOW"),
        ("knee", "true", "3", 0, 0, 30, "MEDIUM"),
        ("head", "false", "0", 0, 1, 30, "MEDIUM"),
        ("knee", "true", "0", 1, 0, 45, "MEDIUM"),
        ("back", "true", "0", 0, 1, 50, "HIGH"),
        ("back", "false", "4", 1, 0, 50, "HIGH"),
        ("spine", "true", "9", 1, 1, 85, "HIGH"),
        (None, None, None, None, None, 0, "LOW"),
        ("knee", "true", "2", 1, 0, 45, "MEDIUM"),
    ]
    claims, meds = [], []
    for i, (body, lit, pri, surg, opi, _, _) in enumerate(cases):
        claims.append(raw_claim(f"C{i}", body=body, lit=lit, priors=pri))
        ev = ([("surgery", "2026-01-01")] if surg else []) + ([("opioid prescription", "2026-01-01")] if opi else [])
        if surg is not None:
            meds.append((f"C{i}", ev, None, "m.json"))
    scored = complexity_score(stage_claims(claims_df(spark, claims)), stage_medical(medical_df(spark, meds)))
    got = {r.claim_id: (r.complexity_score, r.complexity_band) for r in scored.collect()}
    assert got == {f"C{i}": (c[5], c[6]) for i, c in enumerate(cases)}


def test_flags_are_max_over_events_and_int(spark):
    meds = [("C1", [("surgery", "2026-01-01"), ("x", None)], None, "a"),
            ("C1", [("opioid prescription", "2026-01-01")], None, "b"),
            ("C2", [("physical therapy", "2026-01-01")], None, "a"),
            ("C3", [], None, "a"),
            ("C4", None, None, "a")]
    flags = medical_flags(stage_medical(medical_df(spark, meds)))
    assert dict(flags.dtypes)["has_surgery"] == "int"
    got = {r.claim_id: (r.has_surgery, r.has_opioid) for r in flags.collect()}
    assert got == {"C1": (1, 1), "C2": (0, 0)}   # empty / null arrays give no row


def test_claims_without_medical_rows_score_from_claim_fields(spark):
    claims = [raw_claim("C1", body="spine", lit="true", priors="3")]
    scored = complexity_score(stage_claims(claims_df(spark, claims)),
                              stage_medical(medical_df(spark, [("C9", [("surgery", None)], None, "m")])))
    r = scored.collect()
    assert [(x.claim_id, x.has_surgery, x.has_opioid, x.complexity_score) for x in r] == [("C1", 0, 0, 45)]


def test_rule_constants_are_reachable():
    assert R.HIGH_BAND_MIN == 50 and R.MEDIUM_BAND_MIN == 30
