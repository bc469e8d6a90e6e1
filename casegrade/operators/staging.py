"""Staging models: clean and type the raw (bronze) records.

``stage_claims``  — trim ids, lower-case body parts, cast date / boolean /
int, keep lineage, drop rows without a claim id.
``stage_medical`` — one row per event (``explode``: null or empty arrays
give no row), cleaned event type and date, drop rows without claim id or
event type.

Both are narrow (no shuffle); the filters reach the parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.casts import clean_lower, clean_text, present, to_type

LINEAGE = ("_source_file", "_ingested_at", "_rescued_data")


def stage_claims(raw: DataFrame, strict: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """``keep`` carries extra raw columns through unchanged (e.g. ``batch_id``)."""
    cleaned = raw.select(
        clean_text("claim_id").alias("claim_id"),
        to_type("date_of_loss", "date", strict).alias("date_of_loss"),
        clean_lower("body_part").alias("body_part"),
        to_type("is_litigated", "boolean", strict).alias("is_litigated"),
        to_type("number_of_priors", "int", strict).alias("number_of_priors"),
        *LINEAGE,
        *keep,
    )
    return cleaned.filter(present("claim_id"))


def stage_medical(raw: DataFrame, strict: bool = False) -> DataFrame:
    flattened = raw.select(
        "claim_id",
        F.explode("medical_events").alias("event"),
        *LINEAGE,
    )
    cleaned = flattened.select(
        clean_text("claim_id").alias("claim_id"),
        clean_lower(F.col("event.type")).alias("event_type"),
        to_type(F.col("event.date"), "date", strict).alias("event_date"),
        *LINEAGE,
    )
    return cleaned.filter(present("claim_id") & present("event_type"))


def medical_event_types(raw: DataFrame) -> DataFrame:
    """The (claim_id, event_type) rows of ``stage_medical``, read lean.

    Exploding ``medical_events.type`` (an array of strings) instead of the
    struct array lets the parquet scan read only the ``type`` leaf
    (``ReadSchema: array<struct<type>>``); the rows and filters are the same
    as ``stage_medical`` restricted to these two columns.
    """
    flattened = raw.select("claim_id", F.explode(F.col("medical_events.type")).alias("event_type"))
    cleaned = flattened.select(
        clean_text("claim_id").alias("claim_id"),
        clean_lower("event_type").alias("event_type"),
    )
    return cleaned.filter(present("claim_id") & present("event_type"))
