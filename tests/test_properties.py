"""Property test: score and band of random claims equal a plain oracle."""

from conftest import claims_df, medical_df, raw_claim
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from casegrade.operators.scoring import complexity_score
from casegrade.operators.staging import stage_claims, stage_medical

BODY = st.sampled_from([None, "spine", " Spine ", "HEAD", "back", "knee", "arm", "", "\tback"])
LIT = st.sampled_from([None, "true", "false", "TRUE", "no", "yes", "maybe", ""])
PRI = st.sampled_from([None, "0", "2", "3", " 4 ", "10", "x", ""])
EVENTS = st.lists(st.sampled_from(["surgery", "Opioid Prescription ", "physical therapy", "", None]), max_size=4)


def oracle(body, lit, pri, events):
    b = (body or "").strip(" ").lower()
    lit_v = {"true": True, "yes": True, "false": False, "no": False}.get((lit or "").strip().lower())
    try:
        p = int((pri or "").strip())
    except ValueError:
        p = None
    types = {(e or "").strip(" ").lower() for e in events}
    s = (15 if b in ("spine", "head", "back") else 0) + (20 if lit_v else 0) + (10 if p is not None and p >= 3 else 0) \
        + (25 if "surgery" in types else 0) + (15 if "opioid prescription" in types else 0)
    return s, "HIGH" if s >= 50 else "MEDIUM" if s >= 30 else "LOW"


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(BODY, LIT, PRI, EVENTS), min_size=1, max_size=40))
def test_score_matches_oracle(spark, cases):
    claims = [raw_claim(f"C{i}", body=b, lit=li, priors=p) for i, (b, li, p, _) in enumerate(cases)]
    meds = [(f"C{i}", [(t, "2026-01-01") for t in ev], None, "m") for i, (_, _, _, ev) in enumerate(cases)]
    scored = complexity_score(stage_claims(claims_df(spark, claims)), stage_medical(medical_df(spark, meds)))
    got = {r.claim_id: (r.complexity_score, r.complexity_band) for r in scored.collect()}
    assert got == {f"C{i}": oracle(*c) for i, c in enumerate(cases)}
