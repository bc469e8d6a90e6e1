"""Schema tracking for the streaming ingest (the schema-location idea).

The raw schema of a stream is declared in code. On every start it is written
next to the checkpoint on first use and compared afterwards, so a code change
that would silently change the layout of an existing bronze table stops the
run instead. Unexpected *data* never changes the schema: it is rescued into
``_rescued_data``.

The record is a one-line text dataset written and read with Spark itself, so
it lives on whatever file system holds the checkpoint.
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import types as T


class SchemaChanged(RuntimeError):
    pass


def _path(location: str) -> str:
    return f"{location.rstrip('/')}/_schema"


def read_schema(spark: SparkSession, location: str) -> T.StructType | None:
    try:
        rows = spark.read.text(_path(location)).collect()     # one line
    except AnalysisException:                                  # not recorded yet
        return None
    return T.StructType.fromJson(json.loads(rows[0].value)) if rows else None


def track_schema(spark: SparkSession, location: str, schema: T.StructType) -> T.StructType:
    """Record ``schema`` at ``location`` or check it equals the recorded one."""
    known = read_schema(spark, location)
    if known is None:
        (spark.createDataFrame([(schema.json(),)], "value string")
         .coalesce(1).write.mode("overwrite").text(_path(location)))
        return schema
    if [(f.name, f.dataType) for f in known.fields] != [(f.name, f.dataType) for f in schema.fields]:
        raise SchemaChanged(f"schema at {location} is {known.simpleString()}, code declares {schema.simpleString()}")
    return known
