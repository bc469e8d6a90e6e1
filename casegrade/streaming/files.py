"""File discovery for the ingest streams: a stream of landed file paths.

Both ingests (CSV and JSON) have the same shape: a ``binaryFile`` stream that
selects only path and length (contents are not read) discovers new files, the
checkpoint makes each file part of exactly one micro-batch, and
``foreachBatch`` reads that batch's files with a batch reader and overwrites
the batch's own folder ``stream_id=<id>/batch_id=<n>``. The id is that of the
checkpoint's stream, so a batch replayed after a failure replaces its own
output, and a second checkpoint on the same table replaces nothing.

The path list is de-duplicated and glob characters are escaped before the
files are read: Spark's file stream source re-globs listed paths, and a file
named e.g. ``p[1].json`` or ``p{a,b}.json`` made it deliver files of that
batch more than once. Only paths and lengths reach the driver, at most
``max_files_per_trigger`` per batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamReader, StreamingQuery

BINARY_FILE = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("modificationTime", T.TimestampType()),
    T.StructField("length", T.LongType()),
    T.StructField("content", T.BinaryType()),
])

#: Spark lists the paths of a read in up to 10,000 tasks, one path to a task; the
#: result of each task is a message of its own to the driver.
LISTING_TASKS = 64
_LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"

_GLOB_CHARS = "\\*?[]{}"


def literal_path(path: str) -> str:
    """A file path with glob characters escaped (readers expand globs)."""
    return "".join("\\" + ch if ch in _GLOB_CHARS else ch for ch in path)


def literal_paths(paths: list[str]) -> list[str]:
    return [literal_path(p) for p in paths]


@contextmanager
def few_listing_tasks(spark: SparkSession) -> Iterator[None]:
    """Reads of many paths made inside list them in ``LISTING_TASKS`` tasks."""
    before = spark.conf.get(_LISTING)
    spark.conf.set(_LISTING, str(min(int(before), LISTING_TASKS)))
    try:
        yield
    finally:
        spark.conf.set(_LISTING, before)


def path_reader(spark: SparkSession) -> DataStreamReader:
    """A reader for streams of paths, in a session that is a clone of ``spark``.

    A file source lists the paths of every micro-batch with the settings that the
    session of its reader has at that time, whatever they were at the start of the
    stream. The clone (same context and catalog) has ``LISTING_TASKS`` for good,
    and deals a batch's paths to about as many tasks as there are cores.
    """
    own = spark._jsparkSession.cloneSession()
    own.conf().set(_LISTING, str(min(int(spark.conf.get(_LISTING)), LISTING_TASKS)))
    own.conf().set("spark.sql.files.maxPartitionBytes", str(1 << 50))         # contents are not read
    reader = spark.readStream
    reader._jreader = own.readStream()
    return reader


def batch_folder(table_dir: str, stream_id: str, batch_id: int) -> str:
    return f"{table_dir.rstrip('/')}/stream_id={stream_id}/batch_id={batch_id}"


def path_batches(spark: SparkSession, landing_dir: str, checkpoint_dir: str,
                 handle: Callable[[dict[str, int], str, int], None], path_glob: str | None = None,
                 max_files_per_trigger: int = 1000, available_now: bool = True) -> StreamingQuery:
    """Stream new files of ``landing_dir``; ``handle(files, stream_id, batch_id)``
    gets each micro-batch's paths with their lengths (never none)."""
    if max_files_per_trigger < 1:
        raise ValueError("max_files_per_trigger must be at least 1: it bounds what a batch lists")
    reader = (path_reader(spark).format("binaryFile").schema(BINARY_FILE)
              .option("maxFilesPerTrigger", max_files_per_trigger))
    if path_glob:
        reader = reader.option("pathGlobFilter", path_glob)

    def run(batch: DataFrame, batch_id: int) -> None:
        files = {r.path: r.length for r in batch.collect()}
        if files:
            stream_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
            handle(files, stream_id, batch_id)
    writer = (reader.load(landing_dir).select("path", "length").writeStream.foreachBatch(run)
              .option("checkpointLocation", checkpoint_dir))
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
