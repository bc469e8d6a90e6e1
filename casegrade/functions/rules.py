"""Scoring rules, bands and accepted values.

FIXED VALUES — these must equal the business rules of the pipeline being
reproduced, stated here together in their natural order:

* body part in (spine, head, back)   -> 15 points
* litigated                          -> 20 points
* number of priors >= 3              -> 10 points
* has a surgery event                -> 25 points
* has an opioid prescription event   -> 15 points
* band: score >= 50 HIGH, score >= 30 MEDIUM, otherwise LOW
* event types that set flags: "surgery", "opioid prescription"
* accepted event types: surgery, opioid prescription
* accepted bands: LOW, MEDIUM, HIGH; the gold table accepts HIGH only
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
HIGH_RISK_BODY_PARTS = ("spine", "head", "back")
BODY_PART_POINTS = 15
LITIGATION_POINTS = 20
PRIORS_THRESHOLD = 3
PRIORS_POINTS = 10
SURGERY_POINTS = 25
OPIOID_POINTS = 15
HIGH_BAND_MIN = 50
MEDIUM_BAND_MIN = 30
SURGERY_EVENT = "surgery"
OPIOID_EVENT = "opioid prescription"
ACCEPTED_EVENT_TYPES = ("surgery", "opioid prescription")
BANDS = ("LOW", "MEDIUM", "HIGH")
GOLD_BANDS = ("HIGH",)
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Rule:
    """One additive scoring rule: ``points`` when ``condition`` holds.

    A null condition scores 0 (CASE ... ELSE 0), so the total is never null.
    """

    name: str
    condition: Column
    points: int

    def column(self) -> Column:
        return F.when(self.condition, F.lit(self.points)).otherwise(F.lit(0))


def score_rules() -> list[Rule]:
    """The rule list, in order; columns must exist on the joined claim rows."""
    return [
        Rule("body_part", F.col("body_part").isin(*HIGH_RISK_BODY_PARTS), BODY_PART_POINTS),
        Rule("litigation", F.col("is_litigated") == F.lit(True), LITIGATION_POINTS),
        Rule("priors", F.col("number_of_priors") >= PRIORS_THRESHOLD, PRIORS_POINTS),
        Rule("surgery", F.col("has_surgery") == 1, SURGERY_POINTS),
        Rule("opioid", F.col("has_opioid") == 1, OPIOID_POINTS),
    ]


def score_expr(rules: list[Rule] | None = None) -> Column:
    """Sum of the rule columns (int)."""
    cols = [r.column() for r in (rules or score_rules())]
    total = cols[0]
    for c in cols[1:]:
        total = total + c
    return total


def band_expr(score: Column) -> Column:
    return (F.when(score >= HIGH_BAND_MIN, F.lit("HIGH"))
            .when(score >= MEDIUM_BAND_MIN, F.lit("MEDIUM"))
            .otherwise(F.lit("LOW")))
