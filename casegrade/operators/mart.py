"""Gold table: high-complexity claims with report columns, rebuilt per run."""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

POINTER = "folder string, written_at bigint"

GOLD_COLUMNS = ("claim_id", "date_of_loss", "body_part", "is_litigated", "number_of_priors",
                "has_surgery", "has_opioid", "complexity_score", "complexity_band",
                "report_date", "processed_at", "_source_file", "_ingested_at")


def high_complexity_daily(scored: DataFrame, report_date: Column | None = None,
                          processed_at: Column | None = None) -> DataFrame:
    """Band HIGH only; ``report_date`` / ``processed_at`` default to now.

    Both clocks are parameters so that a run can be repeated exactly.
    """
    rd = report_date if report_date is not None else F.current_date()
    pa = processed_at if processed_at is not None else F.current_timestamp()
    return (scored.filter(F.col("complexity_band") == F.lit("HIGH"))
            .withColumn("report_date", rd)
            .withColumn("processed_at", pa)
            .select(*GOLD_COLUMNS))


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """Full rebuild of a materialised model under ``path``; the new folder.

    The rows go to a run folder of their own. Only when they are all there is a
    pointer to it appended, in one file that Spark commits: a reader sees the
    run before or this run, and a failed job changes nothing. Earlier runs stay
    until they are removed from outside.
    """
    spark, now = df.sparkSession, time.time_ns() // 1000
    folder = f"{path.rstrip('/')}/run_id={now}"
    df.write.mode("errorifexists").format(fmt).save(folder)
    (spark.createDataFrame([(folder, now)], POINTER).coalesce(1)
     .write.mode("append").parquet(f"{path.rstrip('/')}/current"))
    return folder


def current_folder(spark: SparkSession, path: str) -> str:
    """The folder of the last complete run."""
    pointers = spark.read.schema(POINTER).parquet(f"{path.rstrip('/')}/current")
    return pointers.agg(F.max_by("folder", "written_at")).first()[0]


def read_table(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet") -> DataFrame:
    """The last complete run, with its declared schema (no footer reads to infer it)."""
    return spark.read.schema(schema).format(fmt).load(current_folder(spark, path))
