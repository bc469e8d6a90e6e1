"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_dir, ship_package

#: Rows whose id is null sort after every other row.
LAST_ID = 9223372036854775807


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def named(names: Iterable[str]) -> list[Column]:
    """Columns by their whole names, whatever characters these hold."""
    return [F.col("`" + name.replace("`", "``") + "`") for name in names]


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage.

    A lost executor then costs a re-read of the table, and work used by two
    consumers is done once.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark, f'llm-{purpose}')}/table"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def id_order(id_col: str) -> Column:
    """The id as a non-null long; null ids come last."""
    return F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID))


def text_key(id_col: str, text_col: str) -> Column:
    """A non-null second key (32 bits) that tells apart rows of one id with other texts."""
    return F.shiftrightunsigned(F.xxhash64(F.col(text_col), F.col(id_col).isNull()), 32)


def slices(batches: Iterator[pa.RecordBatch], text: int, max_bytes: int = 4 << 20,
           max_rows: int = 2048) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into runs of rows with about ``max_bytes`` of text each.

    Every row is passed on whole; a text above the limit is a run of its own.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        start, total = 0, 0
        for i, n in enumerate(sizes.tolist()):
            if i > start and (total + n > max_bytes or i - start >= max_rows):
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += n
        yield batch.slice(start)


def map_arrow(df: DataFrame, task, out: T.StructType) -> DataFrame:
    """``mapInArrow`` by position: any column names, also with dots.

    ``task`` takes and gives batches whose columns lie in the order of ``df``
    and of ``out``.
    """
    places = [f"c{i}" for i in range(len(out.fields))]

    def placed(batches):
        for batch in task(batches):
            yield batch.rename_columns(places)
    schema = T.StructType([T.StructField(p, f.dataType) for p, f in zip(places, out.fields)])
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))]).mapInArrow(placed, schema).toDF(*out.fieldNames())
