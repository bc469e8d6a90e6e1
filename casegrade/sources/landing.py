"""Land raw files into a landing folder with Spark writers (no driver I/O).

Used to turn tables into the files the ingest jobs expect: claim CSV files
(optionally in several header layouts) and medical-activity JSON payload
files (one payload document per file, in the four payload shapes).
"""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from .store import STREAMED_SCHEMES, open_store, scheme

# Spark's CSV writer trims values unless told otherwise; raw files keep them.
CSV_WRITE_OPTIONS = {
    "header": "true",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}

PAYLOAD_SHAPES = ("list", "data", "results", "lines")


def land_csv(df: DataFrame, landing_dir: str, records_per_file: int = 5000) -> None:
    """Append CSV files (header row) holding ``df``'s columns in their order."""
    (df.write.mode("append").options(**CSV_WRITE_OPTIONS)
     .option("maxRecordsPerFile", records_per_file).csv(landing_dir))


def _write_task(landing_dir: str):
    def run(batches):
        store, folder = open_store(landing_dir)
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with store.open_output_stream(f"{folder}/{name}", compression=None) as out:
                    out.write(content)
            yield pa.RecordBatch.from_arrays([batch.column(0)], ["name"])
    return run


def land_texts(rows: DataFrame, landing_dir: str, suffix: str = ".txt", encoding: str = "UTF-8") -> None:
    """Append one file per row of ``rows`` (key, value): its value and a line end.

    Tasks write the files themselves (Spark's writers start a process for each
    file they make where Hadoop's native library is missing). The key is
    different in every row and the same in every attempt, so a task that is run
    again writes the same files.
    """
    if scheme(landing_dir) not in STREAMED_SCHEMES:
        writer = rows.select("value").write.mode("append").option("maxRecordsPerFile", 1)
        if encoding == "UTF-8":
            writer.text(landing_dir)
        else:    # the text writer knows UTF-8 only: the CSV writer, with nothing in the value to quote
            writer.option("encoding", encoding).option("quote", "").option("sep", "\x01").csv(landing_dir)
        return
    ship_package(rows.sparkSession)
    store, folder = open_store(landing_dir)
    store.create_dir(folder, recursive=True)
    text = F.coalesce(F.col("value"), F.lit(""))
    content = text.cast("binary") if encoding == "UTF-8" else F.encode(text, encoding)
    name = F.concat(F.lit(f"part-{uuid.uuid4().hex}-"), F.coalesce(F.col("key").cast("string"), F.lit("none")), F.lit(suffix))
    (rows.select(name.alias("name"), F.concat(content, F.lit(b"\n")).alias("content"))
     .mapInArrow(_write_task(landing_dir), "name string").write.format("noop").mode("overwrite").save())


def keyed(values: Column | str, rows: DataFrame) -> DataFrame:
    """(key, value) of ``rows`` read from storage: the key is a row's place in the scan."""
    value = F.col(values) if isinstance(values, str) else values
    return rows.select(F.monotonically_increasing_id().alias("key"), value.alias("value"))


def payload_documents(records: DataFrame, records_per_doc: int = 500) -> DataFrame:
    """Group record objects into payload documents of at most ``records_per_doc``.

    ``records`` has one JSON object text per row in column ``rec``. Rows are
    chunked by their position within their partition (bounded groups; no key
    can make a chunk larger), and each chunk becomes one document whose shape
    cycles through a list, ``{"data": [...]}``, ``{"results": [...]}`` and
    JSON Lines. Lists are written one record per line, as an indented API
    response would be.
    """
    chunked = records.withColumn("chunk", F.floor(F.monotonically_increasing_id() / records_per_doc))
    docs = chunked.groupBy("chunk").agg(F.collect_list("rec").alias("recs"))
    body = F.concat_ws(",\n  ", "recs")
    shape = F.pmod(F.col("chunk"), F.lit(len(PAYLOAD_SHAPES)))
    text = (F.when(shape == 0, F.concat(F.lit("[\n  "), body, F.lit("\n]")))
            .when(shape == 1, F.concat(F.lit('{\n "data": [\n  '), body, F.lit("\n ]\n}")))
            .when(shape == 2, F.concat(F.lit('{\n "results": [\n  '), body, F.lit("\n ]\n}")))
            .otherwise(F.concat_ws("\n", "recs")))
    return docs.select(F.col("chunk").alias("key"), text.alias("value"))


def land_json_payloads(records: DataFrame, landing_dir: str, records_per_doc: int = 500) -> None:
    """One payload document per file."""
    land_texts(payload_documents(records, records_per_doc), landing_dir)
