from pyspark.sql import functions as F

from casegrade.operators.skew import SkewGuard, hot_keys, salted_left_join


def _is_salted(df):
    return "_salt" in df._jdf.queryExecution().optimizedPlan().toString()


def test_salted_join_equals_plain_join_on_hot_key(spark):
    # a third of all rows carry one key
    left = spark.range(0, 30000).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("k"), F.col("id").cast("string"))).alias("k"),
        F.col("id"))
    right = spark.range(0, 30000, 7).select(
        F.concat(F.lit("k"), F.col("id").cast("string")).alias("k"), (F.col("id") * 2).alias("v")
    ).unionByName(spark.createDataFrame([("HOT", -1)], "k string, v long"))
    guard = SkewGuard(sample_fraction=0.2, buckets=16, partitions=100)
    assert hot_keys(left, "k", guard) == ["HOT"]
    salted = salted_left_join(left, right, "k", guard)
    plain = left.join(right, "k", "left")
    assert sorted(map(tuple, salted.collect())) == sorted(map(tuple, plain.collect()))
    assert _is_salted(salted)


def test_no_hot_key_gives_plain_join(spark):
    left = spark.range(0, 5000).select(F.col("id").cast("string").alias("k"))
    right = spark.range(0, 5000, 2).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("v"))
    out = salted_left_join(left, right, "k", SkewGuard())
    assert not _is_salted(out)
    assert out.filter(F.col("v").isNotNull()).count() == 2500


def test_even_keys_are_not_hot_and_a_small_share_is_hot_at_many_partitions(spark):
    even = spark.range(0, 200_000).select((F.col("id") % 1000).alias("k"))
    assert hot_keys(even, "k", SkewGuard(sample_fraction=0.5, partitions=200)) == []
    half_percent = even.select(F.when(F.col("k") < 5, F.lit(-1)).otherwise(F.monotonically_increasing_id()).alias("k"))
    assert hot_keys(half_percent, "k", SkewGuard(sample_fraction=0.5, partitions=200)) == []
    assert hot_keys(half_percent, "k", SkewGuard(sample_fraction=0.5, partitions=2000)) == [-1]


def test_equal_rows_of_one_key_spread_over_all_buckets(spark):
    left = spark.range(0, 6400, 1, 2).select(F.lit("HOT").alias("k"), F.lit(1).alias("v"))
    right = spark.createDataFrame([("HOT", 5)], "k string, w int")
    guard = SkewGuard(buckets=64)
    out = salted_left_join(left, right, "k", guard, hot=["HOT"])
    assert out.count() == 6400 and out.agg(F.sum("w")).first()[0] == 32000
    place = F.pmod(F.monotonically_increasing_id(), F.lit(64))
    sizes = [r["count"] for r in left.groupBy(place.alias("p")).count().collect()]
    assert len(sizes) == 64 and max(sizes) <= 2 * min(sizes)
