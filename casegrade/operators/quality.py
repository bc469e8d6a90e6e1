"""Declared column tests (not_null, unique, accepted_values) as Spark jobs.

Failure counts follow the usual meaning of such tests, i.e. the number of
rows the failing-rows query would return:

* ``not_null``        — rows where the column is null;
* ``unique``          — non-null values that occur more than once;
* ``accepted_values`` — distinct non-null values outside the list (nulls
                        are the business of the accompanying not_null).

A unique test is a ``groupBy(col)`` whose map-side partial counts keep a hot
value to one row per map task; the model's not_null tests ride on the same
pass. Accepted-values tests are one narrow pass over their columns.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rules import ACCEPTED_EVENT_TYPES, BANDS, GOLD_BANDS


@dataclass(frozen=True)
class ColumnTest:
    model: str
    column: str
    test: str                      # not_null | unique | accepted_values
    values: tuple[str, ...] = field(default=())


# FIXED VALUES — the 22 declared tests, in declaration order.
DECLARED_TESTS: tuple[ColumnTest, ...] = (
    ColumnTest("stg_claims", "claim_id", "not_null"),
    ColumnTest("stg_claims", "claim_id", "unique"),
    ColumnTest("stg_claims", "date_of_loss", "not_null"),
    ColumnTest("stg_claims", "body_part", "not_null"),
    ColumnTest("stg_claims", "is_litigated", "not_null"),
    ColumnTest("stg_claims", "number_of_priors", "not_null"),
    ColumnTest("stg_medical_activity", "claim_id", "not_null"),
    ColumnTest("stg_medical_activity", "event_type", "not_null"),
    ColumnTest("stg_medical_activity", "event_type", "accepted_values", ACCEPTED_EVENT_TYPES),
    ColumnTest("stg_medical_activity", "event_date", "not_null"),
    ColumnTest("int_claim_complexity_score", "claim_id", "not_null"),
    ColumnTest("int_claim_complexity_score", "claim_id", "unique"),
    ColumnTest("int_claim_complexity_score", "complexity_score", "not_null"),
    ColumnTest("int_claim_complexity_score", "complexity_band", "not_null"),
    ColumnTest("int_claim_complexity_score", "complexity_band", "accepted_values", BANDS),
    ColumnTest("high_complexity_claims_daily", "claim_id", "not_null"),
    ColumnTest("high_complexity_claims_daily", "claim_id", "unique"),
    ColumnTest("high_complexity_claims_daily", "complexity_score", "not_null"),
    ColumnTest("high_complexity_claims_daily", "complexity_band", "not_null"),
    ColumnTest("high_complexity_claims_daily", "complexity_band", "accepted_values", GOLD_BANDS),
    ColumnTest("high_complexity_claims_daily", "report_date", "not_null"),
    ColumnTest("high_complexity_claims_daily", "processed_at", "not_null"),
)

RESULT_COLUMNS = ("model", "column_name", "test", "n_rows", "n_failed")


def tests_for(model: str, kinds: tuple[str, ...] | None = None) -> list[ColumnTest]:
    return [t for t in DECLARED_TESTS if t.model == model and (kinds is None or t.test in kinds)]


def _failure_agg(t: ColumnTest) -> Column:
    c = F.col(t.column)
    if t.test == "not_null":
        return F.count_if(c.isNull())
    if t.test == "accepted_values":
        return F.count_distinct(F.when(c.isNotNull() & ~c.isin(*t.values), c))
    raise ValueError(t.test)


def _result_row(t: ColumnTest, n_rows: Column, n_failed: Column) -> Column:
    return F.struct(
        F.lit(t.model).alias("model"),
        F.lit(t.column).alias("column_name"),
        F.lit(t.test).alias("test"),
        n_rows.cast("bigint").alias("n_rows"),
        n_failed.cast("bigint").alias("n_failed"),
    )


def _as_rows(one_row: DataFrame, tests: list[ColumnTest]) -> DataFrame:
    """(_n, _f0, _f1, ...) -> a result row per test."""
    rows = F.array(*[_result_row(t, F.coalesce(F.col("_n"), F.lit(0)), F.coalesce(F.col(f"_f{i}"), F.lit(0)))
                     for i, t in enumerate(tests)])
    return one_row.select(F.inline(rows))


def single_pass_tests(df: DataFrame, tests: list[ColumnTest]) -> DataFrame:
    """not_null and accepted_values tests of one model in one aggregate pass."""
    return _as_rows(df.agg(F.count(F.lit(1)).alias("_n"),
                           *[_failure_agg(t).alias(f"_f{i}") for i, t in enumerate(tests)]), tests)


def keyed_tests(df: DataFrame, unique: ColumnTest, others: list[ColumnTest]) -> DataFrame:
    """A unique test and the not_null tests of a model in one pass: row and
    null counts per value (partial on the map side), then their sums."""
    key = F.col(unique.column)
    per_value = df.groupBy(unique.column).agg(
        F.count(F.lit(1)).alias("_c"), *[_failure_agg(t).alias(f"_p{i}") for i, t in enumerate(others)])
    sums = per_value.agg(F.sum("_c").alias("_n"), F.count_if(key.isNotNull() & (F.col("_c") > 1)).alias("_f0"),
                         *[F.sum(f"_p{i}").alias(f"_f{i + 1}") for i in range(len(others))])
    return _as_rows(sums, [unique, *others])


def run_tests(df: DataFrame, tests: list[ColumnTest]) -> DataFrame:
    """Result rows (model, column_name, test, n_rows, n_failed) for one model.

    A model with a unique test is read once for it and the not_null tests, and
    its accepted_values columns once more; one without is read once.
    """
    unique = [t for t in tests if t.test == "unique"]
    nulls = [t for t in tests if t.test == "not_null"]
    accepted = [t for t in tests if t.test == "accepted_values"]
    parts = [keyed_tests(df, t, nulls if i == 0 else []) for i, t in enumerate(unique)]
    rest = accepted if unique else nulls + accepted
    if rest:
        parts.append(single_pass_tests(df, rest))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def dq_report(models: dict[str, DataFrame], kinds: tuple[str, ...] | None = None) -> DataFrame:
    """All declared tests over the given models, with a ``passed`` flag."""
    parts = [run_tests(df, tests_for(name, kinds)) for name, df in models.items() if tests_for(name, kinds)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("passed", F.col("n_failed") == 0)


def violations(df: DataFrame, t: ColumnTest) -> DataFrame:
    """The failing rows / values of one test, for inspection."""
    c = F.col(t.column)
    if t.test == "not_null":
        return df.filter(c.isNull())
    if t.test == "accepted_values":
        return (df.filter(c.isNotNull() & ~c.isin(*t.values))
                .groupBy(t.column).agg(F.count(F.lit(1)).alias("n_records")))
    if t.test == "unique":
        return (df.filter(c.isNotNull()).groupBy(t.column)
                .agg(F.count(F.lit(1)).alias("n_records")).filter(F.col("n_records") > 1))
    raise ValueError(t.test)


def all_violations(models: dict[str, DataFrame], key: str = "claim_id") -> DataFrame:
    """(model, column_name, test, row_key, value, n_records): what fails, of all tests.

    Rows are named by their ``key``. The not_null and accepted_values tests of a
    model are one pass, in which a row gives an entry for each test it fails.
    """
    def entry(t: ColumnTest, value: Column) -> Column:
        return F.struct(F.lit(t.column).alias("column_name"), F.lit(t.test).alias("test"),
                        value.cast("string").alias("value"))
    out = None
    for name, df in models.items():
        checks = []
        for t in tests_for(name, ("not_null", "accepted_values")):
            c = F.col(t.column)
            failed = c.isNull() if t.test == "not_null" else c.isNotNull() & ~c.isin(*t.values)
            checks.append(F.when(failed, entry(t, c)))
        found = df.select(F.col(key).cast("string").alias("row_key"), F.explode(F.array_compact(F.array(*checks))).alias("v"))
        parts = [found.select("v.column_name", "v.test", "row_key", "v.value")
                 .groupBy("column_name", "test", "row_key", "value").agg(F.count(F.lit(1)).alias("n_records"))]
        for t in tests_for(name, ("unique",)):
            value = F.col(t.column).cast("string")
            parts.append(violations(df, t).select(F.lit(t.column).alias("column_name"), F.lit(t.test).alias("test"),
                                                  value.alias("row_key"), value.alias("value"), "n_records"))
        for part in parts:
            part = part.select(F.lit(name).alias("model"), "column_name", "test", "row_key", "value", "n_records")
            out = part if out is None else out.unionByName(part)
    return out


def observed_rows(spark, tests: list[ColumnTest], observation) -> DataFrame:
    """(model, column_name, test, n_rows, n_failed_rows) of an ``observe_tests`` after its write."""
    got = observation.get
    rows = [(t.model, t.column, t.test, int(got["n_rows"] or 0),
             int(got[f"{t.column}:{'not_null' if t.test == 'not_null' else 'accepted_values_rows'}"] or 0))
            for t in tests if t.test != "unique"]
    return spark.createDataFrame(rows, "model string, column_name string, test string, n_rows bigint, n_failed_rows bigint")


def observe_tests(df: DataFrame, tests: list[ColumnTest], name: str = "dq"):
    """Inline checks on a write: ``(observed_df, observation)``.

    not_null counts null rows and accepted_values counts the *rows* outside
    the list, both computed while the DataFrame is written (no extra pass);
    ``observation.get`` holds them after the write. ``unique`` needs a
    ``groupBy`` and stays with ``run_tests``.
    """
    from pyspark.sql import Observation
    metrics = []
    for t in tests:
        c = F.col(t.column)
        if t.test == "not_null":
            metrics.append(F.count_if(c.isNull()).alias(f"{t.column}:not_null"))
        elif t.test == "accepted_values":
            metrics.append(F.count_if(c.isNotNull() & ~c.isin(*t.values)).alias(f"{t.column}:accepted_values_rows"))
    obs = Observation(name)
    if not metrics:
        return df, obs
    return df.observe(obs, F.count(F.lit(1)).alias("n_rows"), *metrics), obs
