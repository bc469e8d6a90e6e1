"""The corpus pipeline: language ID, near-duplicates, repeated passages,
benchmark passages, packing.

Each stage is ``(spark, docs, sf_dir) -> DataFrame``; its result is written as
Parquet and read again as the next stage's ``docs``. All but the last return
the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casegrade.llm import decontamination, langid, packing, simhash, substring
from casegrade.llm.common import named, read_table, stored

#: A document stays if its language has at least this posterior.
LANGUAGE_SCORE = 0.5


#: The columns that stages work with; others only pass through.
OWN_COLUMNS = ("doc_id", "text", "lang", "n_chars")

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def carrying(stage: Stage) -> Stage:
    """The stage with all other columns under names of our own, whatever theirs are."""
    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        inner = [c if c in OWN_COLUMNS else f"__carried_{i}" for i, c in enumerate(docs.columns)]
        found = stage(spark, docs.toDF(*inner), sf_dir)
        return found.select(*named(inner)).toDF(*docs.columns)
    return run_stage


@carrying
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a letter or without a clear language.

    The languages are learned from ``lang``; if that is null in all rows, only
    documents without a letter go. So null, empty and blank texts go; equal rows
    stay or go together; null ids are allowed.
    """
    model = langid.train(docs)
    if not model.languages:                      # one language, of equal odds for every n-gram
        model = langid.Model(["any"], np.zeros((1, langid.BUCKETS), np.float32), np.zeros(1))
    judged = langid.predict(docs, model, keep=docs.columns, pred_col="__lang_pred", score_col="__lang_score")
    return (judged.filter((F.col("__lang_pred") != langid.UNKNOWN) & (F.col("__lang_score") >= LANGUAGE_SCORE))
            .select(*named(docs.columns)))


@carrying
def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each group of near copies.

    Equal rows are copies: one stays. All texts without a word (null, empty or
    blank) are copies of one another. Null ids come last.
    """
    return simhash.first_of_each(docs)


@carrying
def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut passages that a document with a smaller id holds too.

    A document without such a passage keeps its text as it is (also a null or
    empty one); one of which nothing is left goes. Equal rows are treated alike,
    rows of one id do not cut each other, and null ids come after all others.
    """
    found = substring.remove_repeats(docs, keep=docs.columns)         # adds columns that `carrying` keeps free
    changed = F.col("n_removed") > 0
    return (found.filter(~changed | (F.col("n_removed") < F.col("n_words")))
            .withColumn("text", F.when(changed, F.col("kept_text")).otherwise(F.col("text")))
            .withColumn("n_chars", F.when(changed, F.length("text")).otherwise(F.col("n_chars")).cast("long"))
            .select(*named(docs.columns)))


@carrying
def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a passage of the benchmark.

    Null and empty texts hold none and stay; equal rows go together.
    """
    return decontamination.clean_rows(docs, read_table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack the tokenized documents: one row per piece.

    A null or empty text is the end id alone; equal rows are packed each.
    """
    return packing.pack(docs).withColumnRenamed("id", "doc_id")


STAGES = [("language_id", language_id), ("simhash_near_dedup", simhash_near_dedup),
          ("substring_dedup", substring_dedup), ("benchmark_decontamination", benchmark_decontamination),
          ("best_fit_packing", best_fit_packing)]

#: Stages work on words, hashes and models that SQL does not express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    docs = read_table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = stored(docs, f"pipeline-{name}")
    return docs
