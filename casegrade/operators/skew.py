"""Skew-safe equi-join for a right side that is unique per key.

Assume one key may hold a third of the left rows (e.g. a feed that repeats
one claim id). A plain shuffle join sends all of them to one task. Here:

1. ``hot_keys`` — the keys that would fill more than ``factor`` mean shuffle
   partitions, by their share of a seeded sample. There are at most
   ``partitions / factor`` of them, so the list is bounded by construction.
2. No hot key (the usual case): a plain left join. The flag side keeps the
   ``claim_id`` partitioning of its aggregation (no second exchange) and AQE
   may broadcast it when its measured size is small.
3. Hot keys: left rows of hot keys get a salt in ``[0, buckets)`` by their
   place in the scan, which a retried task reproduces and which spreads equal
   rows too; all others get salt 0. Right rows of hot keys are replicated once
   per salt. Joining on ``(key, salt)`` spreads a hot key over ``buckets``
   tasks.

Each left row still meets exactly the right rows of its key, so the result
equals the plain join; only the work distribution changes. The left side must
be read from storage (its rows then have the same places in every attempt).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SALT, _HOT = "_salt", "_hot_key"


@dataclass(frozen=True)
class SkewGuard:
    factor: float = 4.0          # hot: as many rows as this many mean partitions
    sample_fraction: float = 0.01
    buckets: int = 64
    seed: int = 17
    min_sample_rows: int = 20    # fewer sampled rows say nothing about a share
    partitions: int | None = None  # default: spark.sql.shuffle.partitions

    def parts(self, df: DataFrame) -> int:
        return self.partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def hot_keys(df: DataFrame, key: str, guard: SkewGuard) -> list:
    """The keys whose share of the sample is ``factor / partitions`` or more.

    One job: partial counts, the total beside them, and a filter on the share.
    """
    sample = df.select(key).sample(fraction=guard.sample_fraction, seed=guard.seed)
    counts = sample.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    share = guard.factor / guard.parts(df)
    total = sample.agg(F.count(F.lit(1)).alias("_total"))
    hot = (counts.crossJoin(F.broadcast(total))           # one row
           .filter(F.col(key).isNotNull() & (F.col("_n") >= guard.min_sample_rows)
                   & (F.col("_n") >= share * F.col("_total"))))
    return [r[0] for r in hot.select(key).collect()]      # at most partitions / factor


def salted_left_join(left: DataFrame, right: DataFrame, key: str,
                     guard: SkewGuard | None = None, hot: list | None = None) -> DataFrame:
    """``left`` LEFT JOIN ``right`` USING (key), with hot keys salted.

    ``hot`` may be passed when already known; otherwise it is measured.
    """
    if guard is None:
        return left.join(right, key, "left")
    if hot is None:
        hot = hot_keys(left, key, guard)
    if not hot:
        return left.join(right, key, "left")
    kind = left.schema[key].dataType.simpleString()
    table = F.broadcast(left.sparkSession.createDataFrame([(k,) for k in hot], f"{_HOT} {kind}"))

    def marked(df):
        return df.join(table, F.col(key) == F.col(_HOT), "left")
    place = F.pmod(F.monotonically_increasing_id(), F.lit(guard.buckets)).cast("int")
    salted_left = (marked(left.withColumn("_place", place))
                   .withColumn(_SALT, F.when(F.col(_HOT).isNotNull(), F.col("_place")).otherwise(F.lit(0)))
                   .drop(_HOT, "_place"))
    salted_right = marked(right).withColumn(
        _SALT, F.explode(F.when(F.col(_HOT).isNotNull(), F.sequence(F.lit(0), F.lit(guard.buckets - 1)))
                         .otherwise(F.array(F.lit(0))))).drop(_HOT)
    return salted_left.join(salted_right, [key, _SALT], "left").drop(_SALT)
