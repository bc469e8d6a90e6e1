"""Registered queries of the stored models, the catalog and the declared tests.

FIXED VALUES — fixture mapping used only here:

* text columns for type inference: the raw claim columns, and of ``orders`` the
  key as it is (whole), times 10,000,000,000 (big), padded with zeros to twelve
  digits (padded), the price as a number text with four decimals (price), and a
  column of nulls (nothing);
* gold rebuilds: report dates 2026-01-01 and 2026-01-02, then a failed one.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.payload import payload_file_name
from ..operators import quality as Q
from ..operators.inference import inferred_types, merged, type_counts
from ..operators.mart import current_folder, high_complexity_daily, read_table, write_table
from ..schemas import GOLD, RAW_CLAIMS, RAW_MEDICAL, SCORED
from ..session import scratch_dir
from ..sources import testtables as TT
from ..streaming.schema_registry import SchemaChanged, track_schema
from . import catalog

TOLERANCE = 0.05


def q_inferred_types(spark: SparkSession, sf: str) -> DataFrame:
    """The types of raw text columns, from the merged counts of two parts."""
    key = F.col("o_orderkey")
    orders = TT.table(spark, sf, "orders").select(
        key.cast("string").alias("whole"), (key * 10_000_000_000).cast("string").alias("big"),
        F.lpad(key.cast("string"), 12, "0").alias("padded"),
        F.col("o_totalprice").cast("decimal(18,4)").cast("string").alias("price"),
        F.lit(None).cast("string").alias("nothing"), (key % 2).alias("part"))
    claims = TT.raw_claims(spark, sf)
    parts = [type_counts(claims, list(TT.CLAIM_COLUMNS))]
    parts += [type_counts(orders.filter(F.col("part") == i), ["whole", "big", "padded", "price", "nothing"]) for i in (0, 1)]
    counts = merged(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    return inferred_types(counts, TOLERANCE)


def q_payload_file_names(spark: SparkSession, sf: str) -> DataFrame:
    """The landing file name of a payload fetched at each event's time."""
    return TT.table(spark, sf, "events").select("event_id", payload_file_name(F.col("ts")).alias("file_name"))


def q_schema_registry(spark: SparkSession, sf: str) -> DataFrame:
    """Each table's schema recorded, seen again, and stopped when it changed."""
    d = scratch_dir(spark, "schema-registry")
    rows = []
    for name in TT.TABLES:
        schema, place = TT.table(spark, sf, name).schema, f"{d}/{name}"
        recorded, again = track_schema(spark, place, schema), track_schema(spark, place, schema)
        changed = type(schema)(schema.fields[1:])
        try:
            track_schema(spark, place, changed)
            stopped = False
        except SchemaChanged:
            stopped = True
        rows.append((name, len(recorded.fields), [f.name for f in again.fields] == schema.fieldNames(), stopped))
    return spark.createDataFrame(rows, "table_name string, n_columns int, same_again boolean, change_stopped boolean")


def _scored_table(spark: SparkSession, scored: DataFrame, purpose: str) -> tuple[str, DataFrame]:
    path = scratch_dir(spark, purpose)
    write_table(scored, path)
    return path, read_table(spark, path, SCORED)


def gold_rebuild(spark: SparkSession, scored: DataFrame) -> DataFrame:
    """The gold table after two rebuilds and one that fails while it writes."""
    _, stored = _scored_table(spark, scored, "gold-scored")
    path = scratch_dir(spark, "gold")
    for day in (1, 2):
        write_table(high_complexity_daily(stored, report_date=F.lit(dt.date(2026, 1, day))), path)
    failing = F.when(F.length("claim_id") > 3, F.raise_error(F.lit("stopped"))).otherwise(F.lit(dt.date(2026, 1, 3)))
    try:
        write_table(high_complexity_daily(stored, report_date=failing.cast("date")), path)
    except PySparkException:
        pass                                         # meant to fail: readers keep the run before
    return read_table(spark, path, GOLD).drop("processed_at", "_ingested_at")


def catalog_comments(spark: SparkSession, sf: str, scored: DataFrame) -> DataFrame:
    """Tables and views with their comments as the catalog has them, and their rows."""
    d = scratch_dir(spark, "catalog")
    catalog.setup_namespaces(spark)
    for name, schema, rows in (("raw_claims", RAW_CLAIMS, TT.raw_claims(spark, sf)),
                               ("raw_medical_activity", RAW_MEDICAL, TT.raw_medical(spark, sf))):
        rows.select(*schema.fieldNames()).write.mode("overwrite").parquet(f"{d}/{name}")
        spark.sql(f"drop table if exists bronze.{name}")
        catalog.register_table(spark, f"bronze.{name}", schema, f"{d}/{name}")
    path, stored = _scored_table(spark, scored, "catalog-scored")
    gold = scratch_dir(spark, "catalog-gold")
    write_table(high_complexity_daily(stored), gold)
    catalog.register_table(spark, "silver.int_claim_complexity_score", SCORED, current_folder(spark, path))
    catalog.register_table(spark, "gold.high_complexity_claims_daily", GOLD, current_folder(spark, gold))
    names = ["bronze.raw_claims", "bronze.raw_medical_activity", "silver.int_claim_complexity_score",
             "gold.high_complexity_claims_daily"]
    for view in catalog.VIEWS:
        catalog.register_view(spark, view)
        names.append(view)
    bare = f"audit.no_comments_{uuid.uuid4().hex[:8]}"
    spark.sql(f"create table {bare} (status string) using parquet location '{d}/bare'")
    described = catalog.described(spark, [*names, bare])
    counts = None
    for name in names:
        n = spark.table(name).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("counted"), "n_rows")
        counts = n if counts is None else counts.unionByName(n)
    met = described.join(counts, (F.col("table_name") == F.col("counted")) & F.col("column_name").isNull(), "left")
    return met.select(F.when(F.col("table_name") == bare, "audit.no_comments").otherwise(F.col("table_name")).alias("table_name"),
                      "column_name", "comment", "n_rows")


def dq_observed(spark: SparkSession, models: dict[str, DataFrame]) -> DataFrame:
    """The inline checks of the models' writes, as rows."""
    d, parts = scratch_dir(spark, "dq-observed"), None
    for name, df in models.items():
        tests = Q.tests_for(name, ("not_null", "accepted_values"))
        observed, checks = Q.observe_tests(df, tests, f"write_{name}")
        observed.write.mode("overwrite").parquet(f"{d}/{name}")
        rows = Q.observed_rows(spark, tests, checks)
        parts = rows if parts is None else parts.unionByName(rows)
    return parts


def dq_violations(models: dict[str, DataFrame]) -> DataFrame:
    """The failing rows of all declared tests."""
    return Q.all_violations(models)
