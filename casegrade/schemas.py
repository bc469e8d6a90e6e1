"""Explicit schemas for every table the pipeline writes or reads.

Streaming file sources need a declared schema, and an all-string raw layer
keeps ids such as ``007`` intact (type inference would turn them into 7).
"""

from __future__ import annotations

from pyspark.sql import types as T

CLAIM_FIELDS = ("claim_id", "date_of_loss", "body_part", "is_litigated", "number_of_priors")
MEDICAL_FIELDS = ("claim_id", "medical_events")
LINEAGE_FIELDS = ("_rescued_data", "_ingested_at", "_source_file")

EVENT = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("date", T.StringType()),
])
MEDICAL_EVENTS = T.ArrayType(EVENT)

_LINEAGE = [
    T.StructField("_rescued_data", T.StringType(), metadata={"comment": "unexpected or unreadable fields, as JSON"}),
    T.StructField("_ingested_at", T.TimestampType(), metadata={"comment": "time the record was loaded (UTC)"}),
    T.StructField("_source_file", T.StringType(), metadata={"comment": "file the record came from"}),
]

RAW_CLAIMS = T.StructType([T.StructField(c, T.StringType()) for c in CLAIM_FIELDS] + _LINEAGE)

RAW_MEDICAL = T.StructType([
    T.StructField("claim_id", T.StringType()),
    T.StructField("medical_events", MEDICAL_EVENTS),
] + _LINEAGE)

SCORED = T.StructType([
    T.StructField("claim_id", T.StringType()),
    T.StructField("date_of_loss", T.DateType()),
    T.StructField("body_part", T.StringType()),
    T.StructField("is_litigated", T.BooleanType()),
    T.StructField("number_of_priors", T.IntegerType()),
    T.StructField("has_surgery", T.IntegerType(), False),
    T.StructField("has_opioid", T.IntegerType(), False),
    T.StructField("complexity_score", T.IntegerType(), False),
    T.StructField("complexity_band", T.StringType(), False),
    T.StructField("_source_file", T.StringType()),
    T.StructField("_ingested_at", T.TimestampType()),
])

GOLD = T.StructType(SCORED.fields[:9] + [
    T.StructField("report_date", T.DateType(), False),
    T.StructField("processed_at", T.TimestampType(), False),
] + SCORED.fields[9:])

DQ_RESULTS = T.StructType([
    T.StructField("model", T.StringType()),
    T.StructField("column_name", T.StringType()),
    T.StructField("test", T.StringType()),
    T.StructField("n_rows", T.LongType()),
    T.StructField("n_failed", T.LongType()),
    T.StructField("passed", T.BooleanType()),
])

# Bronze tables as stored by the ingest jobs: one folder per stream and micro-batch.
STREAM_PARTITIONS = [T.StructField("stream_id", T.StringType()), T.StructField("batch_id", T.LongType())]
BRONZE_CLAIMS = T.StructType(RAW_CLAIMS.fields + STREAM_PARTITIONS)
BRONZE_MEDICAL = T.StructType(RAW_MEDICAL.fields + STREAM_PARTITIONS)

# Audit ledgers (append-only). Declared explicitly: a batch in which a column
# is null in every row has no inferable type.
FILE_MANIFEST = T.StructType([
    T.StructField("source_system", T.StringType()),
    T.StructField("file_name", T.StringType()),
    T.StructField("remote_path", T.StringType()),
    T.StructField("landing_path", T.StringType()),
    T.StructField("file_size_bytes", T.LongType()),
    T.StructField("file_hash", T.StringType()),
    T.StructField("ingested_at", T.TimestampType()),
    T.StructField("status", T.StringType()),
    T.StructField("error_message", T.StringType()),
])

PAYLOAD_MANIFEST = T.StructType([
    T.StructField("source_system", T.StringType()),
    T.StructField("api_url", T.StringType()),
    T.StructField("landing_path", T.StringType()),
    T.StructField("payload_hash", T.StringType()),
    T.StructField("record_count", T.LongType()),
    T.StructField("ingested_at", T.TimestampType()),
    T.StructField("status", T.StringType()),
    T.StructField("error_message", T.StringType()),
])

# FIXED VALUES — source-system labels written on every ledger row.
SFTP_CLAIMS = "sftp_claims"
API_MEDICAL_ACTIVITY = "api_medical_activity"
LANDED = "LANDED"
FAILED = "FAILED"
