"""Claim-level medical flags, the claims/flags join, score and band.

Shuffles: one for the flags ``groupBy`` (partial ``max`` on the map side,
so a claim with millions of events still ships one row per map task) and one
for the left join on ``claim_id`` (AQE turns it into a broadcast when the
measured flag table is small; the skew guard spreads hot claim ids).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rules import OPIOID_EVENT, SURGERY_EVENT, band_expr, score_expr
from .skew import SkewGuard, salted_left_join

CLAIM_COLUMNS = ("claim_id", "date_of_loss", "body_part", "is_litigated", "number_of_priors",
                 "_source_file", "_ingested_at")
SCORED_COLUMNS = ("claim_id", "date_of_loss", "body_part", "is_litigated", "number_of_priors",
                  "has_surgery", "has_opioid", "complexity_score", "complexity_band",
                  "_source_file", "_ingested_at")


def _any_event(event_type: str):
    return F.max(F.when(F.col("event_type") == event_type, F.lit(1)).otherwise(F.lit(0)))


def medical_flags(events: DataFrame) -> DataFrame:
    """One row per claim: has_surgery / has_opioid as 0/1 ints."""
    return events.groupBy("claim_id").agg(
        _any_event(SURGERY_EVENT).alias("has_surgery"),
        _any_event(OPIOID_EVENT).alias("has_opioid"),
    )


def join_claims(claims: DataFrame, flags: DataFrame, skew_guard: SkewGuard | None = None) -> DataFrame:
    """Every claim with its flags; claims without medical rows get 0/0."""
    joined = salted_left_join(claims.select(*CLAIM_COLUMNS), flags, "claim_id", skew_guard)
    return joined.select(
        "claim_id", "date_of_loss", "body_part", "is_litigated", "number_of_priors",
        F.coalesce(F.col("has_surgery"), F.lit(0)).alias("has_surgery"),
        F.coalesce(F.col("has_opioid"), F.lit(0)).alias("has_opioid"),
        "_source_file", "_ingested_at",
    )


def score(joined: DataFrame) -> DataFrame:
    return joined.withColumn("complexity_score", score_expr())


def band(scored: DataFrame) -> DataFrame:
    return scored.withColumn("complexity_band", band_expr(F.col("complexity_score")))


def complexity_score(stg_claims: DataFrame, events: DataFrame,
                     skew_guard: SkewGuard | None = None) -> DataFrame:
    """The scored model: stg_claims ⟕ flags(events) → score → band.

    ``events`` needs only ``claim_id`` and ``event_type`` (``stage_medical``
    or the lean ``medical_event_types``).
    """
    flags = medical_flags(events)
    return band(score(join_claims(stg_claims, flags, skew_guard))).select(*SCORED_COLUMNS)
