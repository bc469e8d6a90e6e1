"""Type inference over an all-text table, in one pass.

Bronze keeps every column as text. What type a column could take is counted, not
guessed from a sample: ``type_counts`` aggregates, for each column, its values
and how many of them each type holds. The counts of parts of a table (files,
batches) add up to those of the whole, so they can be kept and merged
(``merged``). ``inferred_types`` reads the types off: the narrowest that holds
all values but a tolerated share; the values that fail it are counted.

Types: boolean (true, false), int, bigint, double, date (yyyy-mm-dd), text. A
number with a leading zero or a plus sign is an identifier and stays text, so
``007`` is never 7. Null and blank values have no say; a column without a value
is text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Narrow types first; the first that holds a column's values is taken.
TYPES = ("boolean", "int", "bigint", "double", "date")
_WHOLE = r"^-?(0|[1-9][0-9]*)$"
_NUMBER = r"^-?(0|[1-9][0-9]*)(\.[0-9]+)?([eE][+-]?[0-9]+)?$"
_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"


def fits(value: Column, kind: str) -> Column:
    """Whether a trimmed text is a value of the type; false for null."""
    whole = F.regexp_like(value, F.lit(_WHOLE))
    test = {
        "boolean": lambda: F.lower(value).isin("true", "false"),
        "int": lambda: whole & value.try_cast("int").isNotNull(),
        "bigint": lambda: whole & value.try_cast("bigint").isNotNull(),
        "double": lambda: F.regexp_like(value, F.lit(_NUMBER)) & value.try_cast("double").isNotNull(),
        "date": lambda: F.regexp_like(value, F.lit(_DATE)) & value.try_cast("date").isNotNull(),
    }[kind]()
    return F.coalesce(test, F.lit(False))


def type_counts(raw: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, n_values, n_boolean, n_int, ...): one row per column."""
    named = [F.trim(F.col("`" + c.replace("`", "``") + "`").cast("string")) for c in columns]
    sums = [[F.count_if(v != "").alias(f"c{i}_values"), *[F.count_if(fits(v, t)).alias(f"c{i}_{t}") for t in TYPES]]
            for i, v in enumerate(named)]
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"c{i}_values").alias("n_values"),
                              *[F.col(f"c{i}_{t}").alias(f"n_{t}") for t in TYPES]) for i, c in enumerate(columns)])
    return raw.agg(*[s for own in sums for s in own]).select(F.inline(rows))


def merged(counts: DataFrame) -> DataFrame:
    """The counts of several parts (``unionByName`` of theirs) as those of the whole."""
    return counts.groupBy("column_name").agg(*[F.sum(c).alias(c) for c in ("n_values", *[f"n_{t}" for t in TYPES])])


def inferred_types(counts: DataFrame, tolerance: float = 0.0) -> DataFrame:
    """(column_name, inferred_type, n_values, n_failing) from ``type_counts``.

    At most ``tolerance`` of a column's values may fail its type.
    """
    kind, held = F.lit("text"), F.col("n_values")
    for t in reversed(TYPES):
        good = (F.col("n_values") > 0) & (F.col("n_values") - F.col(f"n_{t}") <= F.lit(tolerance) * F.col("n_values"))
        kind, held = F.when(good, F.lit(t)).otherwise(kind), F.when(good, F.col(f"n_{t}")).otherwise(held)
    return counts.select("column_name", kind.alias("inferred_type"), "n_values",
                         (F.col("n_values") - held).alias("n_failing"))
