"""Medical-activity JSON files -> bronze ``raw_medical_activity``.

Incremental over the landing folder (``availableNow`` by default: take all
files present now, then stop; the checkpoint remembers which files were
done). Each file is one API payload, usually an indented document, so it is
read whole (``wholetext``), checked and split into record texts by a
streaming parse, and each record is parsed by itself:

* payload shapes: a list of records, ``{"data": [...]}``, ``{"results": [...]}``
  or a single record object (same precedence as the payload record count);
  a file that is not one JSON document but JSON Lines (one document per
  line, every line valid) is read line by line;
* known fields are typed; unknown keys of a record or of an event, known keys
  whose value does not fit, and events that are no objects go to
  ``_rescued_data`` as JSON;
* a record with a repeated key gets the last value of its known keys, and its
  whole text is rescued under ``_record``;
* a file that is not JSON, or not UTF-8, gives one row whose ``_rescued_data``
  holds the text (its claim id is null, so staging drops it and the ledger
  marks it FAILED); the other files of the batch load;
* a file above ``WHOLE_FILE_BYTES`` is cut into its records by many tasks
  (``large_json``), which are parsed in the same way; one that is not a single
  document is read by lines, each a document of its own, if every line is one;
  the text of one that is not JSON is rescued line by line;
* ``_source_file`` / ``_ingested_at`` lineage per row.

The number of rows of a file is its record count in the ledger.
"""

from __future__ import annotations

from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.exprs import let, plain_path, source_path
from ..functions.payload import (document_texts, is_one_document, list_document, payload_record_count,
                                 payload_record_texts)
from ..schemas import BRONZE_MEDICAL, RAW_MEDICAL
from ..session import ship_package
from ..sources.store import STREAMED_SCHEMES, open_store, scheme
from .files import batch_folder, few_listing_tasks, literal_paths, path_batches
from .large_json import cut_files
from .schema_registry import track_schema

EVENTS_TYPE = "array<struct<type:string,date:string>>"
#: Larger files are cut by many tasks; what a file gives is the same either way.
WHOLE_FILE_BYTES = 64 << 20
LAYOUTS = ("document", "lines")
#: Names of files that Spark's reader decompresses.
COMPRESSED = ("gz", "bz2", "zst", "lz4", "snappy", "deflate")
BATCH_BYTES = 4 << 20
TASK_BYTES = 32 << 20
SMALL_TASK_BYTES = 1 << 20

# Keys kept in _rescued_data: unknown ones, and known ones whose value could
# not be typed (an explicit JSON null is not rescued).
_RESCUE = f"""
map_filter(try_variant_get(r, '$', 'map<string,variant>'), (k, x) ->
    k not in ('claim_id', 'medical_events')
    or (k = 'claim_id' and try_variant_get(x, '$', 'string') is null and not is_variant_null(x))
    or (k = 'medical_events' and try_variant_get(x, '$', '{EVENTS_TYPE}') is null and not is_variant_null(x)))
"""
# The same for each event: (number, what its row does not hold).
_EVENT_RESCUE = """
filter(transform(try_variant_get(r, '$.medical_events', 'array<variant>'), (e, i) -> struct(
    i as event,
    case when e is null or is_variant_null(e) then map()
         when try_variant_get(e, '$', 'map<string,variant>') is null then map('_value', e)
         else map_filter(try_variant_get(e, '$', 'map<string,variant>'), (k, x) ->
             k not in ('type', 'date') or (try_variant_get(x, '$', 'string') is null and not is_variant_null(x)))
    end as rest)), p -> size(p.rest) > 0)
"""


def parse_payloads(text: DataFrame) -> DataFrame:
    """(value, _source_file) payload texts -> bronze medical rows (without _ingested_at).

    Only the file's path is carried through the ``explode``: the text, or the list
    it came from, beside every record would be copied once per record. A file that
    is not JSON has its text in its one element.
    """
    docs = text.select("_source_file", "value", list_document("value").alias("_list"))
    docs = docs.withColumn("_docs", F.when(F.col("_list").isNull(), document_texts("value")))

    def elements(texts):
        return F.transform(texts, lambda t: F.struct(F.lit(None).cast("string").alias("_bad"), t.alias("t")))
    records = (F.when(F.col("_list").isNotNull(), elements(F.col("_list")))
               .when(F.col("_docs").isNotNull(), elements(payload_record_texts(F.col("_docs"))))
               .otherwise(F.array(F.struct(F.make_valid_utf8("value").alias("_bad"), F.lit(None).cast("string").alias("t")))))
    return parse_records(docs.select("_source_file", F.inline(records)))


def parse_records(recs: DataFrame) -> DataFrame:
    """(_source_file, _bad, t): a record text, or the text of a file that is not
    JSON -> bronze medical rows (without _ingested_at)."""
    # A record that comes out of its typed form letter by letter holds nothing
    # else; only the others are taken apart.
    recs = recs.withColumn("j", F.from_json("t", f"claim_id string, medical_events {EVENTS_TYPE}"))
    recs = recs.withColumn("plain", F.coalesce(F.to_json("j") == F.col("t"), F.lit(False)))
    # in brackets the whole text has to be one value: nothing may follow it
    one = let(F.from_json(F.concat(F.lit("["), "t", F.lit("]")), "array<variant>"), lambda a: F.when(F.size(a) == 1, a[0]))
    recs = recs.withColumn("r", F.when(~F.col("plain"), one))
    # an object that is no variant has a repeated key somewhere
    again = F.col("r").isNull() & F.startswith("t", F.lit("{")) & is_one_document(F.col("t"))
    recs = recs.withColumn("j", F.when(F.col("plain") | again, F.col("j")))
    typed = recs.select(
        "_source_file", "_bad", "t", "r", "j", "plain",
        F.coalesce(F.expr("try_variant_get(r, '$.claim_id', 'string')"), F.col("j.claim_id")).alias("claim_id"),
        F.coalesce(F.expr(f"try_variant_get(r, '$.medical_events', '{EVENTS_TYPE}')"), F.col("j.medical_events"))
        .alias("medical_events"),
        F.expr(_RESCUE).alias("_extra"),
        F.coalesce(F.expr(_EVENT_RESCUE), F.expr("array()")).alias("_events"),
    )
    with_events = F.expr("map_concat(_extra, map('medical_events', to_variant_object(_events)))")
    rescued = (F.when(F.col("_bad").isNotNull(), F.to_json(F.struct(F.col("_bad").alias("_corrupt_record"))))
               .when(F.col("t").isNull() | F.col("plain"), F.lit(None).cast("string"))
               .when(F.col("j").isNotNull(), F.to_json(F.struct(F.col("t").alias("_record"))))
               .when(F.col("r").isNull(), F.to_json(F.struct(F.col("t").alias("_value"))))
               .when(F.expr("is_variant_null(r)"), F.lit(None).cast("string"))
               .when(F.col("_extra").isNull(), F.to_json(F.struct(F.col("r").alias("_value"))))
               .when(F.size("_events") > 0, F.to_json(with_events))
               .when(F.size("_extra") > 0, F.to_json("_extra")))
    return typed.select("claim_id", "medical_events", rescued.alias("_rescued_data"), "_source_file")


def by_size(files: dict[str, int], layout: str, whole_bytes: int | None = None) -> tuple[list[str], list[str]]:
    """The files to read whole, and the others."""
    if layout not in LAYOUTS:
        raise ValueError(layout)
    most = WHOLE_FILE_BYTES if whole_bytes is None else whole_bytes
    def is_whole(n):
        return layout == "document" and n <= most
    return [p for p, n in files.items() if is_whole(n)], [p for p, n in files.items() if not is_whole(n)]


def _opened(path: str, size: int) -> bool:
    """Whether a task opens the file itself; Spark's reader takes other stores' files,
    compressed ones and very large ones."""
    return (scheme(path) in STREAMED_SCHEMES and size <= WHOLE_FILE_BYTES
            and path.rpartition(".")[2].lower() not in COMPRESSED)


def _content_task(batches):
    def batch_of(rows):
        paths, contents = zip(*rows)
        return pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(contents, pa.binary())], ["path", "content"])
    for batch in batches:
        held, size = [], 0
        for path in batch.column(0).to_pylist():
            store, place = open_store(path)
            with store.open_input_stream(place, compression=None) as source:
                held.append((path, source.read()))
            size += len(held[-1][1])
            if size >= BATCH_BYTES:
                yield batch_of(held)
                held, size = [], 0
        if held:
            yield batch_of(held)


def read_whole(spark: SparkSession, files: dict[str, int]) -> DataFrame:
    """(value, _source_file) of files (path -> length), dealt evenly to tasks: Spark's
    reader puts files of a few megabytes and tiny ones alike 30 to a task, and
    lists each path again first."""
    opened = {p: n for p, n in files.items() if _opened(p, n)}
    others = [p for p in files if p not in opened]
    parts = []
    if opened:
        ship_package(spark)
        size, cores = sum(opened.values()), spark.sparkContext.defaultParallelism
        # few bytes in many files: a round of tasks for the cores, not one for each partition
        n = max(-(-size // TASK_BYTES), min(int(spark.conf.get("spark.sql.shuffle.partitions")), max(2 * cores, size // SMALL_TASK_BYTES)))
        listed = spark.createDataFrame([(p,) for p in opened], "path string").repartition(min(len(opened), n))
        parts.append(listed.mapInArrow(_content_task, "path string, content binary").select(
            F.col("content").cast("string").alias("value"), plain_path("path").alias("_source_file")))
    if others:
        # wholetext must be the argument of text(): as an option it is overridden
        with few_listing_tasks(spark):
            texts = spark.read.text(literal_paths(others), wholetext=True)
        parts.append(texts.select("value", source_path().alias("_source_file")))
    return reduce(DataFrame.unionByName, parts)


def read_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    with few_listing_tasks(spark):
        lines = spark.read.text(literal_paths(paths))
    return lines.filter(F.trim("value") != "").select("value", source_path().alias("_source_file"))


def whole_lines(spark: SparkSession, paths: list[str]) -> dict[str, int | None]:
    """The record counts of JSON Lines files; None for one of which a line is no document."""
    read = let(document_texts("value"), lambda docs: F.struct(
        docs.isNotNull().alias("ok"), payload_record_count(docs).alias("n")))
    counted = (read_lines(spark, paths).select("_source_file", read.alias("read"))
               .groupBy("_source_file").agg(F.bool_and("read.ok").alias("ok"), F.sum("read.n").alias("n")).collect())
    own = {r._source_file: r.n if r.ok else None for r in counted}               # a row per file
    spelled = spark.createDataFrame([(p,) for p in paths], "p string").select("p", plain_path("p").alias("plain")).collect()
    return {r.p: own.get(r.plain) for r in spelled}


def load_payload_files(spark: SparkSession, files: dict[str, int], layout: str = "document",
                       whole_bytes: int | None = None, split_bytes: int | None = None) -> DataFrame:
    """Bronze medical rows of the given payload files (path -> length).

    ``layout="document"``: one payload document (or JSON Lines) per file.
    ``layout="lines"``: JSON Lines feeds of any size, read line by line so that
    large files are split over tasks; each line is a document.
    ``whole_bytes`` and ``split_bytes`` set which files are cut by many tasks, and
    by how many; the rows do not depend on them.
    """
    whole, lines = by_size(files, layout, whole_bytes)
    parts = []
    if lines and layout == "document":
        counts, records, single, lines, bad = cut_files(spark, {p: files[p] for p in lines}, split_bytes)
        if lines:
            judged = whole_lines(spark, lines)
            bad += [p for p, n in judged.items() if n is None]
            lines = [p for p, n in judged.items() if n is not None]
        whole = whole + single
        none = F.lit(None).cast("string")
        if counts:
            parts.append(parse_records(records.select("_source_file", none.alias("_bad"), "t")))
        if bad:
            parts.append(parse_records(read_lines(spark, bad).select(
                "_source_file", F.make_valid_utf8("value").alias("_bad"), none.alias("t"))))
    if whole:
        parts.append(parse_payloads(read_whole(spark, {p: files[p] for p in whole})))
    if lines:
        parts.append(parse_payloads(read_lines(spark, lines)))
    return (reduce(DataFrame.unionByName, parts)
            .withColumn("_ingested_at", F.current_timestamp())
            .select(*RAW_MEDICAL.fieldNames()))


def ingest_medical_json(spark: SparkSession, landing_dir: str, table_dir: str, checkpoint_dir: str,
                        available_now: bool = True, path_glob: str | None = None,
                        max_files_per_trigger: int = 10000, layout: str = "document",
                        whole_bytes: int | None = None, split_bytes: int | None = None) -> StreamingQuery:
    """Start the ingest; with ``available_now`` it stops by itself when done."""
    if layout not in LAYOUTS:
        raise ValueError(layout)
    track_schema(spark, checkpoint_dir, RAW_MEDICAL)

    def write(files: dict[str, int], stream_id: str, batch_id: int) -> None:
        load_payload_files(spark, files, layout, whole_bytes, split_bytes).write.mode("overwrite").parquet(
            batch_folder(table_dir, stream_id, batch_id))
    return path_batches(spark, landing_dir, checkpoint_dir, write, path_glob, max_files_per_trigger, available_now)


def ingest_medical_table(spark: SparkSession, landing_dir: str, table: str, table_dir: str, checkpoint_dir: str,
                         available_now: bool = True, path_glob: str | None = None,
                         max_files_per_trigger: int = 10000) -> StreamingQuery:
    """The same rows through Spark's own table sink: ``table`` at ``table_dir``.

    The sink keeps a log of the files of each finished micro-batch beside them.
    Readers of the table see these files only, never those of a batch that is
    being written or was cut off, and a batch that is run again is not added
    twice. Payload files are read whole (each has to fit a row); names must not
    hold the characters of file patterns.
    """
    if max_files_per_trigger < 1:
        raise ValueError("max_files_per_trigger must be at least 1: it bounds what a batch lists")
    track_schema(spark, checkpoint_dir, RAW_MEDICAL)
    reader = spark.readStream.option("maxFilesPerTrigger", max_files_per_trigger)
    if path_glob:
        reader = reader.option("pathGlobFilter", path_glob)
    texts = reader.text(landing_dir, wholetext=True).select("value", source_path().alias("_source_file"))
    rows = (parse_payloads(texts).withColumn("_ingested_at", F.current_timestamp())
            .select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in RAW_MEDICAL.fields]))
    writer = rows.writeStream.format("parquet").option("checkpointLocation", checkpoint_dir).option("path", table_dir)
    if available_now:
        writer = writer.trigger(availableNow=True)
    with few_listing_tasks(spark):
        return writer.toTable(table)


def read_bronze_medical(spark: SparkSession, table_dir: str) -> DataFrame:
    """The bronze table; ``stream_id`` and ``batch_id`` name the micro-batch."""
    return spark.read.schema(BRONZE_MEDICAL).parquet(table_dir)
