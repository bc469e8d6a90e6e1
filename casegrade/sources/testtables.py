"""Raw claims and raw medical activity derived from the supplied test tables.

The pipeline's real inputs are claim CSV files and medical-activity JSON
payloads; the test tables are TPC-H-like, so they are mapped onto the raw
layout. Everything is a narrow projection of one table (no shuffle): every
``orders`` row is a claim, every ``lineitem`` row is one medical record
holding its events. One record per line (rather than one record per order
built with ``collect_list``) keeps every record bounded even when one order
holds a third of all lines.

FIXED VALUES — the mapping (also written out in FIXTURES.md §4):

* claim_id          = ' C' || o_orderkey || ' '; null when o_orderkey % 97 = 0,
                      blanks when % 89 = 0, ' C<o_orderkey % 10> ' when % 71 = 0
                      (ids that occur many times)
* date_of_loss      = o_orderdate as a date, as text; 'unknown' when
                      o_orderkey % 53 = 0
* body_part         by o_orderpriority: 1-URGENT ' Spine ', 2-HIGH 'HEAD',
                      3-MEDIUM 'Back', 4-NOT SPECIFIED 'knee', 5-LOW 'arm';
                      null when o_orderkey % 59 = 0
* is_litigated      = 'true' when o_orderstatus = 'F', else 'false'; 'maybe'
                      when o_orderkey % 61 = 0
* number_of_priors  = o_custkey % 6, as text; 'many' when o_orderkey % 67 = 0
* medical claim_id  = 'C' || l_orderkey; null when l_partkey % 83 = 0, a blank
                      when % 79 = 0
* event type        by l_returnflag: R 'surgery', A 'opioid prescription',
                      N 'physical therapy'
* event date        = l_shipdate as a date, as text; 'soon' when
                      l_suppkey % 41 = 0
* medical events    = one event; by l_linenumber: 4 that event, a ' SURGERY '
                      of the same date and a null; 5 that event and one with a
                      blank type and no date; 6 none; 7 null
* claim file layouts by body part: ' Spine ', 'HEAD', 'arm' use the
  standard header; 'Back', 'knee' use a reordered header with an extra
  column policy_id = 'P' || o_custkey (rescued on ingest)
* incremental drops: litigated claims first, the others second
* _source_file      = the table's file name ('orders.parquet',
                      'lineitem.parquet'); a literal, because reading the
                      ``_metadata`` column makes the scans fetch row indexes
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .landing import keyed, land_texts

# --- fixed values -----------------------------------------------------------
PRIORITY_TO_BODY_PART = {
    "1-URGENT": " Spine ",
    "2-HIGH": "HEAD",
    "3-MEDIUM": "Back",
    "4-NOT SPECIFIED": "knee",
    "5-LOW": "arm",
}
RETURNFLAG_TO_EVENT = {
    "R": "surgery",
    "A": "opioid prescription",
    "N": "physical therapy",
}
PRIORS_MODULUS = 6
REORDERED_LAYOUT_BODY_PARTS = ("Back", "knee")
REORDERED_HEADER = ("number_of_priors", "claim_id", "is_litigated", "body_part", "date_of_loss", "policy_id")
# ---------------------------------------------------------------------------


CLAIM_COLUMNS = ("claim_id", "date_of_loss", "body_part", "is_litigated", "number_of_priors")


TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _lookup(col: Column, mapping: dict[str, str]) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = F.when(col == k, F.lit(v)) if expr is None else expr.when(col == k, F.lit(v))
    return expr


def _rows(col: str, step: int) -> Column:
    return F.col(col) % step == 0


def raw_claims(spark: SparkSession, sf_dir: str, ingested_at: Column | None = None,
               with_policy: bool = False) -> DataFrame:
    """Bronze-shaped claims (all text) from ``orders``."""
    o = table(spark, sf_dir, "orders")
    extra = [F.concat(F.lit("P"), F.col("o_custkey").cast("string")).alias("policy_id")] if with_policy else []
    key = F.col("o_orderkey")
    return o.select(
        F.when(_rows("o_orderkey", 97), F.lit(None).cast("string"))
        .when(_rows("o_orderkey", 89), F.lit("   "))
        .when(_rows("o_orderkey", 71), F.concat(F.lit(" C"), (key % 10).cast("string"), F.lit(" ")))
        .otherwise(F.concat(F.lit(" C"), key.cast("string"), F.lit(" "))).alias("claim_id"),
        F.when(_rows("o_orderkey", 53), F.lit("unknown"))
        .otherwise(F.col("o_orderdate").cast("date").cast("string")).alias("date_of_loss"),
        F.when(~_rows("o_orderkey", 59), _lookup(F.col("o_orderpriority"), PRIORITY_TO_BODY_PART)).alias("body_part"),
        F.when(_rows("o_orderkey", 61), F.lit("maybe"))
        .when(F.col("o_orderstatus") == "F", F.lit("true")).otherwise(F.lit("false")).alias("is_litigated"),
        F.when(_rows("o_orderkey", 67), F.lit("many"))
        .otherwise((F.col("o_custkey") % PRIORS_MODULUS).cast("string")).alias("number_of_priors"),
        F.lit(None).cast("string").alias("_rescued_data"),
        (ingested_at if ingested_at is not None else F.current_timestamp()).alias("_ingested_at"),
        F.lit("orders.parquet").alias("_source_file"),
        *extra,
    )


def raw_medical(spark: SparkSession, sf_dir: str, ingested_at: Column | None = None) -> DataFrame:
    """Bronze-shaped medical activity from ``lineitem``: one record per line."""
    li = table(spark, sf_dir, "lineitem")
    date = F.when(_rows("l_suppkey", 41), F.lit("soon")).otherwise(F.col("l_shipdate").cast("date").cast("string"))

    def event(kind, when):
        return F.struct(kind.alias("type"), when.alias("date"))
    main = event(_lookup(F.col("l_returnflag"), RETURNFLAG_TO_EVENT), date)
    nothing = F.lit(None).cast("struct<type:string,date:string>")
    line = F.col("l_linenumber")
    return li.select(
        F.when(_rows("l_partkey", 83), F.lit(None).cast("string")).when(_rows("l_partkey", 79), F.lit(" "))
        .otherwise(F.concat(F.lit("C"), F.col("l_orderkey").cast("string"))).alias("claim_id"),
        F.when(line == 4, F.array(main, event(F.lit(" SURGERY "), date), nothing))
        .when(line == 5, F.array(main, event(F.lit(" "), F.lit(None).cast("string"))))
        .when(line == 6, F.array().cast("array<struct<type:string,date:string>>"))
        .when(line != 7, F.array(main)).alias("medical_events"),
        F.lit(None).cast("string").alias("_rescued_data"),
        (ingested_at if ingested_at is not None else F.current_timestamp()).alias("_ingested_at"),
        F.lit("lineitem.parquet").alias("_source_file"),
    )


def claim_files_by_layout(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Raw claim rows split by header layout (every row in exactly one part)."""
    raw = raw_claims(spark, sf_dir, with_policy=True)
    reordered = F.coalesce(F.col("body_part").isin(*REORDERED_LAYOUT_BODY_PARTS), F.lit(False))
    return [
        raw.filter(~reordered).select(*CLAIM_COLUMNS),
        raw.filter(reordered).select(*REORDERED_HEADER),
    ]


def claim_drops(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Two successive landing drops (litigated first); together all claims."""
    raw = raw_claims(spark, sf_dir).select(*CLAIM_COLUMNS)
    first = F.col("is_litigated") == "true"
    return [raw.filter(first), raw.filter(~first)]


def claim_thirds(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The claims in three parts, by the remainder of the customer key."""
    raw = raw_claims(spark, sf_dir, with_policy=True)
    return [raw.filter(F.substring("policy_id", 2, 20).cast("long") % 3 == i).select(*CLAIM_COLUMNS) for i in range(3)]


def medical_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON record object per medical row, as an API would return it."""
    raw = raw_medical(spark, sf_dir)
    return raw.select(F.to_json(F.struct("claim_id", "medical_events")).alias("rec"))


# FIXED VALUES — dirty payload files, by the remainder of o_orderkey / 8:
# 0 and 1 plain, 2 a repeated key (the last value counts), 3 an unknown key in
# the record and in its event, 4 a text, a number and a null among the events,
# 5 events that are no list, 6 a claim id that is an object, 7 a text instead
# of a record. Records of o_orderkey % 64 = 9 come one to a file that is cut
# off, those of % 64 = 17 one to a file that is not UTF-8; all others in lists
# of one month each.
def dirty_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(o_orderkey, day, rec): one JSON record text per order."""
    key = F.col("o_orderkey").cast("string")
    event = '{"type":"surgery","date":"2026-01-05"%s}'
    kind = F.col("o_orderkey") % 8

    def rec(*parts):
        return F.concat(*[key if p is None else F.lit(p) for p in parts])
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderdate").cast("date").alias("day"),
        F.when(kind <= 1, rec('{"claim_id":"D', None, '","medical_events":[', event % "", "]}"))
        .when(kind == 2, rec('{"claim_id":"X","claim_id":"D', None, '","medical_events":[', event % "", "]}"))
        .when(kind == 3, rec('{"claim_id":"D', None, '","note":"n","medical_events":[', event % ',"dose":5', "]}"))
        .when(kind == 4, rec('{"claim_id":"D', None, '","medical_events":["surgery",7,', event % "", ",null]}"))
        .when(kind == 5, rec('{"claim_id":"D', None, '","medical_events":"surgery"}'))
        .when(kind == 6, rec('{"claim_id":{"id":', None, '},"medical_events":[]}'))
        .otherwise(rec('"D', None, '"')).alias("rec"))


def land_dirty_payloads(spark: SparkSession, sf_dir: str, landing_dir: str) -> None:
    """The dirty records as files: lists by day, cut-off files, files in Latin-1."""
    records = dirty_records(spark, sf_dir)
    part = F.col("o_orderkey") % 64
    lists = (records.filter(~part.isin(9, 17)).groupBy(F.trunc("day", "month").alias("month")).agg(F.collect_list("rec").alias("recs"))
             .select(F.col("month").alias("key"), F.concat(F.lit("["), F.concat_ws(",\n ", "recs"), F.lit("]")).alias("value")))
    cut = keyed(F.concat(F.lit("["), "rec"), records.filter(part == 9))
    latin = keyed(F.concat(F.lit('[{"claim_id":"Mül'), "o_orderkey", F.lit('"}]')), records.filter(part == 17))
    land_texts(lists, landing_dir)
    land_texts(cut, landing_dir)
    land_texts(latin, landing_dir, suffix=".csv", encoding="ISO-8859-1")
