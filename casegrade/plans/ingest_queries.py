"""Registered ingest queries: land files from the test tables, run the
streaming ingest (``availableNow``), and return what reached bronze.

Files, tables and checkpoints live in a fresh folder under the shared
checkpoint folder, so every call is a clean, repeatable run.
"""

from __future__ import annotations

import uuid

from pyarrow.fs import FileSelector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import ledger as L
from ..operators.skew import SkewGuard, salted_left_join
from ..operators.staging import stage_claims, stage_medical
from ..schemas import API_MEDICAL_ACTIVITY, BRONZE_MEDICAL, LANDED, SFTP_CLAIMS
from ..session import scratch_dir
from ..sources import testtables as TT
from ..sources.landing import land_csv, land_json_payloads
from ..sources.store import open_store
from ..streaming.claims_csv import ingest_claims_csv, read_bronze_claims
from ..streaming.medical_json import ingest_medical_json, ingest_medical_table, read_bronze_medical
from . import catalog

CLAIM_BUSINESS = ("claim_id", "date_of_loss", "body_part", "is_litigated", "number_of_priors")


def _claims_bronze(spark: SparkSession, sf: str) -> DataFrame:
    d = scratch_dir(spark, "ingest-claims")
    for part in TT.claim_files_by_layout(spark, sf):
        land_csv(part, f"{d}/landing")
    ingest_claims_csv(spark, f"{d}/landing", f"{d}/bronze", f"{d}/checkpoint").awaitTermination()
    return read_bronze_claims(spark, f"{d}/bronze")


def q_ingest_claims_csv(spark: SparkSession, sf: str) -> DataFrame:
    return stage_claims(_claims_bronze(spark, sf)).select(*CLAIM_BUSINESS)


def q_rescued_fields(spark: SparkSession, sf: str) -> DataFrame:
    return (stage_claims(_claims_bronze(spark, sf))
            .filter(F.col("_rescued_data").isNotNull())
            .select("claim_id", "_rescued_data"))


def q_ingest_medical_json(spark: SparkSession, sf: str) -> DataFrame:
    d = scratch_dir(spark, "ingest-medical")
    land_json_payloads(TT.medical_records(spark, sf), f"{d}/landing")
    ingest_medical_json(spark, f"{d}/landing", f"{d}/bronze", f"{d}/checkpoint").awaitTermination()
    return stage_medical(read_bronze_medical(spark, f"{d}/bronze")).select("claim_id", "event_type", "event_date")


def q_ingest_medical_split(spark: SparkSession, sf: str) -> DataFrame:
    """The payload files as if they were large: each is cut by many tasks."""
    d = scratch_dir(spark, "ingest-split")
    land_json_payloads(TT.medical_records(spark, sf), f"{d}/landing", records_per_doc=5000)
    ingest_medical_json(spark, f"{d}/landing", f"{d}/bronze", f"{d}/checkpoint", whole_bytes=20_000,
                        split_bytes=100_000).awaitTermination()
    return stage_medical(read_bronze_medical(spark, f"{d}/bronze")).select("claim_id", "event_type", "event_date")


def q_ingest_table_sink(spark: SparkSession, sf: str) -> DataFrame:
    """Two drops through the table sink. The last micro-batch is then run again as
    after a failure before its commit, and a file that no finished batch wrote
    lies in the table's folder: neither shows."""
    d = scratch_dir(spark, "ingest-sink")
    name = f"bronze.medical_sink_{uuid.uuid4().hex[:12]}"
    catalog.setup_namespaces(spark)
    records = TT.medical_records(spark, sf)

    def run():
        ingest_medical_table(spark, f"{d}/landing", name, f"{d}/bronze", f"{d}/checkpoint").awaitTermination()
    for half in (0, 1):
        land_json_payloads(records.filter(F.crc32(F.col("rec").cast("binary")) % 2 == half), f"{d}/landing")
        run()
    store, commits = open_store(f"{d}/checkpoint/commits")
    names = [f.base_name for f in store.get_file_info(FileSelector(commits))]
    last = max((n for n in names if n.isdigit()), key=int)
    for n in {last, f".{last}.crc"}.intersection(names):
        store.delete_file(f"{commits}/{n}")
    stray = spark.table(name).limit(10)
    stray.write.mode("overwrite").parquet(f"{d}/stray")
    for f in store.get_file_info(FileSelector(open_store(f"{d}/stray")[1])):
        if f.base_name.endswith(".parquet"):
            store.copy_file(f.path, f"{open_store(f'{d}/bronze')[1]}/{f.base_name}")
    run()
    spark.catalog.refreshTable(name)
    return stage_medical(spark.table(name)).select("claim_id", "event_type", "event_date")


def q_ingest_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """Two drops, three runs: each file lands in bronze exactly once."""
    d = scratch_dir(spark, "ingest-incremental")
    drops = TT.claim_drops(spark, sf)
    for drop in drops:
        land_csv(drop, f"{d}/landing")
        ingest_claims_csv(spark, f"{d}/landing", f"{d}/bronze", f"{d}/checkpoint").awaitTermination()
    ingest_claims_csv(spark, f"{d}/landing", f"{d}/bronze", f"{d}/checkpoint").awaitTermination()
    return (stage_claims(read_bronze_claims(spark, f"{d}/bronze"), keep=("batch_id",))
            .select(*CLAIM_BUSINESS, F.col("batch_id").cast("int").alias("batch_id")))


def q_json_dirty_records(spark: SparkSession, sf: str) -> DataFrame:
    """Dirty payload files: every record is a bronze row, each file's rows are
    its ledger count, and what a row does not hold is rescued."""
    d = scratch_dir(spark, "ingest-dirty")
    TT.land_dirty_payloads(spark, sf, f"{d}/landing")
    ingest_medical_json(spark, f"{d}/landing", f"{d}/bronze", f"{d}/checkpoint").awaitTermination()
    L.record_payloads(spark, f"{d}/landing", f"{d}/manifest", API_MEDICAL_ACTIVITY)
    rows = read_bronze_medical(spark, f"{d}/bronze")
    ledger = L.read_manifest(spark, f"{d}/manifest", "payload").filter(F.col("status") == LANDED)
    per_file = rows.groupBy("_source_file").agg(F.count(F.lit(1)).alias("n_rows"))
    counted = ledger.join(per_file, F.col("landing_path") == F.col("_source_file")).select(
        "_source_file", (F.col("n_rows") == F.col("record_count")).alias("as_in_ledger"))
    events = F.coalesce(F.size("medical_events"), F.lit(-1))
    kind = F.when(F.col("_rescued_data").startswith('{"_corrupt_record"'), "corrupt").when(
        F.col("_rescued_data").startswith('{"_record"'), "repeated key").when(
        F.col("_rescued_data").startswith('{"_value"'), "no record").otherwise(
        F.regexp_replace("_rescued_data", "[0-9]{2,}", "#"))
    return salted_left_join(rows, counted, "_source_file", SkewGuard()).select(
        F.when(kind == "corrupt", F.lit(None).cast("string")).otherwise(F.col("claim_id")).alias("claim_id"),
        events.alias("n_events"), F.get("medical_events", 0)["type"].alias("first_type"), kind.alias("rescued"),
        F.coalesce("as_in_ledger", F.lit(False)).alias("as_in_ledger"))


def q_bronze_by_name(spark: SparkSession, sf: str) -> DataFrame:
    """The raw medical table read by its catalog name after two runs."""
    d = scratch_dir(spark, "ingest-by-name")
    name = f"bronze.raw_medical_activity_{uuid.uuid4().hex[:12]}"
    catalog.setup_namespaces(spark)
    records = TT.medical_records(spark, sf)
    halves = [records.filter(F.crc32(F.col("rec").cast("binary")) % 2 == half) for half in (0, 1)]
    for half in halves:
        land_json_payloads(half, f"{d}/landing")
        ingest_medical_json(spark, f"{d}/landing", f"{d}/bronze", f"{d}/checkpoint").awaitTermination()
        catalog.register_stream_table(spark, name, BRONZE_MEDICAL, f"{d}/bronze")
    table = spark.table(name)
    return table.select("claim_id", F.coalesce(F.size("medical_events"), F.lit(-1)).alias("n_events"),
                        F.col("_ingested_at").isNotNull().alias("has_time"))


def q_lineage_to_ledger(spark: SparkSession, sf: str) -> DataFrame:
    """Bronze rows joined to the ledger by path, with blanks, percent and plus
    signs in the folder names."""
    d = scratch_dir(spark, "ingest-lineage")
    parts = dict(zip(("a b", "a%20b", "c+d%2B"), TT.claim_thirds(spark, sf)))
    for folder, part in parts.items():
        land_csv(part, f"{d}/landing/kind={folder}")
    ingest_claims_csv(spark, f"{d}/landing", f"{d}/bronze", f"{d}/checkpoint").awaitTermination()
    L.record_files(spark, f"{d}/landing", f"{d}/manifest", SFTP_CLAIMS)
    ledger = L.read_manifest(spark, f"{d}/manifest").select(
        F.col("landing_path").alias("_path"), "file_hash", "source_system", "ingested_at", "file_name")
    met = read_bronze_claims(spark, f"{d}/bronze").join(ledger, F.col("_source_file") == F.col("_path"))
    return met.select("claim_id", "source_system", F.col("_ingested_at").isNotNull().alias("has_time"),
                      F.col("_path").endswith(F.concat(F.lit("/"), "file_name")).alias("ends_in_name"),
                      (F.length("file_hash") == 64).alias("hashed"))
