"""Registered queries of the corpus operators: one ``opN_<name>`` each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (decontamination, hard_negatives, langid, lexical, packing, quality_gam, quality_rules, sharding, simhash,
               substring, token_counts, url_filter, warc)
from ..session import scratch_dir
from .common import read_table
from .oracle import ORACLE_SQL

__all__ = ["ORACLE_SQL", "QUERIES"]

Query = Callable[[SparkSession, str], DataFrame]
SHARDS = 40
QUALITY_THRESHOLD = 0.3


def _fold(parts: int) -> Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(parts))


def op1_decontamination(spark, sf):
    found = decontamination.decontaminate(read_table(spark, sf, "documents"), read_table(spark, sf, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op2_substring_dedup(spark, sf):
    found = substring.remove_repeats(read_table(spark, sf, "documents"), keep=["doc_id"])
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op3_quality_rules(spark, sf):
    found = quality_rules.judge(read_table(spark, sf, "documents"), read_table(spark, sf, "labels"))
    return found.select(F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines",
                        "n_repeat_words", "base_failed", "kept", F.array_join("broken", ",").alias("broken_rules"))


def op4_warc_dictionary(spark, sf):
    manifest = warc.write(read_table(spark, sf, "pages"), scratch_dir(spark, "llm-warc"))
    return warc.read(manifest)


def op5_language_id(spark, sf):
    docs = read_table(spark, sf, "documents").withColumn("held_out", F.coalesce(_fold(4) == 2, F.lit(False)))
    model = langid.train(docs.filter(~F.col("held_out")))
    return langid.predict(docs, model, keep=["doc_id", "held_out"])


def op6_token_counts(spark, sf):
    return token_counts.count_tokens(read_table(spark, sf, "documents")).withColumnRenamed("id", "doc_id")


def op7_simhash_near_dedup(spark, sf):
    found = simhash.near_duplicates(read_table(spark, sf, "documents"))
    return found.select(F.col("id").alias("doc_id"), simhash.hex_fingerprint(F.col("fp")).alias("fingerprint"),
                        F.col("component").alias("component_id"))


def op8_quality_classifier(spark, sf):
    docs = read_table(spark, sf, "documents").withColumn("held_out", F.coalesce(_fold(5) == 0, F.lit(False)))
    model = quality_gam.train(docs, read_table(spark, sf, "labels"), usable=_fold(5) != 0)
    return (quality_gam.score(docs, model, keep=["doc_id", "held_out"])
            .withColumn("predicted", (F.col("score") >= QUALITY_THRESHOLD).cast("int")))


def op9_jump_sharding(spark, sf):
    text = F.col("text").cast("binary")
    rows = read_table(spark, sf, "documents").select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit(b""))).alias("text_crc32"), F.lit("key").alias("law"))
    return sharding.shard_rows(rows, "doc_id", SHARDS)


def op10_best_fit_packing(spark, sf):
    return packing.pack(read_table(spark, sf, "documents")).withColumnRenamed("id", "doc_id")


#: The rules of the URL filter.
URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]
ANCHOR_STEP = 100


def op11_url_filter(spark, sf):
    found = url_filter.judge(read_table(spark, sf, "pages"), url_filter.rule_table(spark, URL_RULES))
    return found.withColumnRenamed("id", "page_id")


def op12_lexical_search(spark, sf):
    return lexical.search(read_table(spark, sf, "documents"), read_table(spark, sf, "benchmark"))


def op13_hard_negatives(spark, sf):
    rows = read_table(spark, sf, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", moved), F.col("id") % ANCHOR_STEP == 0)


QUERIES: dict[str, Query] = {
    "op1_decontamination": op1_decontamination,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_quality_rules": op3_quality_rules,
    "op4_warc_dictionary": op4_warc_dictionary,
    "op5_language_id": op5_language_id,
    "op6_token_counts": op6_token_counts,
    "op7_simhash_near_dedup": op7_simhash_near_dedup,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_jump_sharding": op9_jump_sharding,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op11_url_filter": op11_url_filter,
    "op12_lexical_search": op12_lexical_search,
    "op13_hard_negatives": op13_hard_negatives,
}
