"""Namespaces, external tables over the pipeline's folders, and comments.

Tables are registered as external parquet tables on the folders the jobs
write (so every job can keep working on paths in the shared folder), and
carry table and column descriptions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..operators.staging import LINEAGE

NAMESPACES = ("bronze", "audit", "silver", "gold")

TABLE_COMMENTS = {
    "bronze.raw_claims": "Claim rows as landed in CSV files, all text, with lineage and rescued fields.",
    "bronze.raw_medical_activity": "Medical-activity records as landed in JSON payload files, with lineage.",
    "silver.stg_claims": "Claims cleaned and typed from the raw claims table.",
    "silver.stg_medical_activity": "One row per medical event, cleaned and typed.",
    "silver.int_claim_complexity_score": "Claims joined to medical flags, scored and banded.",
    "gold.high_complexity_claims_daily": "High-complexity claims for reporting, rebuilt on every run.",
    "audit.file_manifest": "One row per landed claims file: size, hash, status.",
    "audit.payload_manifest": "One row per landed medical payload: hash, record count, status.",
    "audit.dq_results": "Results of the declared column tests of the last run.",
}

COLUMN_COMMENTS = {
    "claim_id": "Claim identifier (business key).",
    "date_of_loss": "Date the loss occurred.",
    "body_part": "Injured body part, lower case.",
    "is_litigated": "Whether the claim is in litigation.",
    "number_of_priors": "Number of earlier claims.",
    "medical_events": "Events of the record, as landed.",
    "event_type": "Medical event type, lower case.",
    "event_date": "Date of the medical event.",
    "has_surgery": "1 when any event of the claim is a surgery.",
    "has_opioid": "1 when any event of the claim is an opioid prescription.",
    "complexity_score": "Additive complexity score.",
    "complexity_band": "LOW, MEDIUM or HIGH.",
    "report_date": "Date the report was built.",
    "processed_at": "Time the row was written to the report.",
    "_rescued_data": "Unexpected or unreadable fields, as JSON.",
    "_ingested_at": "Time the record was loaded (UTC).",
    "_source_file": "File the record came from, spelled as in the ledgers.",
    "stream_id": "Ingest stream that loaded the row.",
    "batch_id": "Micro-batch of that stream.",
    "source_system": "System the file or payload came from.",
    "file_name": "Name of the file.",
    "remote_path": "Path of the file on the source system.",
    "api_url": "Address the payload was requested from.",
    "landing_path": "Path of the landed file.",
    "file_size_bytes": "Size of the file.",
    "file_hash": "SHA-256 of the file, hexadecimal.",
    "payload_hash": "SHA-256 of the payload, hexadecimal.",
    "record_count": "Records in the payload.",
    "ingested_at": "Time the ledger row was written (UTC).",
    "status": "LANDED or FAILED.",
    "error_message": "Why the file or payload failed.",
    "model": "Tested table.",
    "column_name": "Tested column.",
    "test": "Kind of test.",
    "n_rows": "Rows of the tested table.",
    "n_failed": "Failing rows or values.",
    "passed": "Whether nothing failed.",
}

#: The staging models as views over the raw tables: columns and query.
VIEWS = {
    "silver.stg_claims": (
        ("claim_id", "date_of_loss", "body_part", "is_litigated", "number_of_priors", *LINEAGE),
        """
        select * from (
            select trim(claim_id) as claim_id, try_cast(date_of_loss as date) as date_of_loss,
                   lower(trim(body_part)) as body_part, try_cast(is_litigated as boolean) as is_litigated,
                   try_cast(number_of_priors as int) as number_of_priors,
                   _source_file, _ingested_at, _rescued_data
            from bronze.raw_claims)
        where claim_id <> ''"""),
    "silver.stg_medical_activity": (
        ("claim_id", "event_type", "event_date", *LINEAGE),
        """
        select * from (
            select trim(claim_id) as claim_id, lower(trim(event.type)) as event_type,
                   try_cast(event.date as date) as event_date, _source_file, _ingested_at, _rescued_data
            from bronze.raw_medical_activity lateral view explode(medical_events) as event)
        where claim_id <> '' and event_type <> ''"""),
}


def _quote(s: str) -> str:
    return s.replace("\\", "\\\\").replace("'", "\\'")


def setup_namespaces(spark: SparkSession) -> None:
    for ns in NAMESPACES:
        spark.sql(f"create schema if not exists {ns}")


def _columns(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()} comment '{_quote(COLUMN_COMMENTS[f.name])}'"
                     for f in schema.fields)


def register_table(spark: SparkSession, name: str, schema: StructType, path: str) -> None:
    """External parquet table with the declared schema and comments, pointed at
    ``path`` (again, if it exists)."""
    spark.sql(f"create table if not exists {name} ({_columns(schema)}) using parquet location '{_quote(path)}' "
              f"comment '{_quote(TABLE_COMMENTS.get(name, ''))}'")
    spark.sql(f"alter table {name} set location '{_quote(path)}'")
    spark.sql(f"refresh table {name}")


def register_stream_table(spark: SparkSession, name: str, schema: StructType, path: str,
                          partitions: tuple[str, ...] = ("stream_id", "batch_id")) -> None:
    """The table of an append-only job: one partition per stream and batch."""
    spark.sql(f"create table if not exists {name} ({_columns(schema)}) using parquet "
              f"partitioned by ({', '.join(partitions)}) location '{_quote(path)}' "
              f"comment '{_quote(TABLE_COMMENTS.get(name, ''))}'")
    here = spark.sql(f"describe table extended {name}").filter("col_name = 'Location'").first()
    if here and here.data_type.rstrip("/").rpartition(":")[2].lstrip("/") != path.rstrip("/").rpartition(":")[2].lstrip("/"):
        spark.sql(f"drop table {name}")           # external: the partitions of another folder go with it
        return register_stream_table(spark, name, schema, path, partitions)
    spark.sql(f"alter table {name} recover partitions")
    spark.sql(f"refresh table {name}")


def register_view(spark: SparkSession, name: str) -> None:
    columns, query = VIEWS[name]
    listed = ", ".join(f"{c} comment '{_quote(COLUMN_COMMENTS[c])}'" for c in columns)
    spark.sql(f"create or replace view {name} ({listed}) comment '{_quote(TABLE_COMMENTS[name])}' as {query}")


def described(spark: SparkSession, names: list[str]) -> DataFrame:
    """(table_name, column_name, comment): the comments of tables and views as the
    catalog has them. A null column name is the table itself; a missing comment
    is a row with a null."""
    out = None
    for name in names:
        # columns come first, then the partitioning and the detailed information
        rows = spark.sql(f"describe table extended {name}").collect()
        columns, details = [], {}
        for r in rows:
            if r.col_name.startswith("#"):
                details["#"] = r.col_name
            elif "#" in details:
                details.setdefault(r.col_name, r.data_type)
            elif r.col_name:
                columns.append((name, r.col_name, r.comment or None))
        found = spark.createDataFrame([(name, None, details.get("Comment") or None), *columns],
                                      "table_name string, column_name string, comment string")
        out = found if out is None else out.unionByName(found)
    return out
