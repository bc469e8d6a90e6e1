"""Claims CSV files -> bronze ``raw_claims``, by header name.

Open Spark's CSV reader maps a declared schema onto columns by *position*
(and type inference turns ``007`` into 7). Claim files may come with columns
in another order, extra columns, or rows of the wrong width, and a raw layer
must keep all of it. So, for each micro-batch of new files
(``streaming/files.py``):

1. ``file_headers``: a file's header is its first non-blank line. Tasks open
   the files and read them up to there; only the widest header's width and the
   headers' total length reach the driver.
2. The files are scanned once, as whole lines. Spark's CSV reader leaves each
   file's header out; its separator is one that no line holds, so it cuts no
   line (one that does hold it is kept whole as the reader's corrupt record).
3. Every line is parsed once into an array of cells. A mark appended to the
   line shows how many cells it really has; a line whose quotes swallow the
   mark, or with more cells than any header, has none.
4. The lines meet their file's header, and cells get their names by position:
   known columns are looked up, the others (and columns whose name came
   before) go to ``_rescued_data`` as JSON. A line with another number of cells
   than its header keeps its text there too.

There is one scan and one plan whatever the number of header layouts, and no
column name ever becomes a Spark column name, so no header can be ambiguous.
Like the CSV reader's default mode this is line based, and lines of white space
alone are no records. The lines of files whose
header has over ``MAX_COLUMNS`` columns are cut into cells by a pattern instead
of the CSV parser, which would need a field for each column of the widest file.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.exprs import let, plain_path, source_path
from ..schemas import BRONZE_CLAIMS, CLAIM_FIELDS, RAW_CLAIMS
from ..session import ship_package
from ..sources.store import STREAMED_SCHEMES, first_line, scheme
from .files import batch_folder, few_listing_tasks, literal_paths, path_batches
from .schema_registry import track_schema

CORRUPT = "_corrupt_record"
MAX_COLUMNS = 2000
#: Headers are broadcast to the lines while their total length is below this.
HEADER_BYTES = 64 << 20
_END = "\x01end\x01"
_UNCUT = "\x01uncut\x01"
#: No character of Unicode text, so no line starts with the reader's quote.
_UNQUOTED = "\uffff"


def batch_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(value, _source_file): the files' lines without their headers, in one scan."""
    whole = {"header": "true", "sep": _UNCUT, "quote": _UNQUOTED, "mode": "PERMISSIVE",
             "columnNameOfCorruptRecord": "_cut", "columnPruning": "false", "ignoreLeadingWhiteSpace": "false",
             "ignoreTrailingWhiteSpace": "false"}
    with few_listing_tasks(spark):
        lines = spark.read.schema("value string, _cut string").options(**whole).csv(literal_paths(paths))
    return lines.select(F.coalesce("_cut", "value").alias("value"), source_path().alias("_source_file"))


def _header_task(batches):
    for batch in batches:
        found = [first_line(path) for path in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], ["path", "header"])


def file_headers(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(_file, header): each file's first non-blank line.

    Files are read up to it; those of a store that pyarrow does not open are scanned.
    """
    opened = [(p,) for p in paths if scheme(p) in STREAMED_SCHEMES]
    others = [p for p in paths if scheme(p) not in STREAMED_SCHEMES]
    ship_package(spark)
    read = (spark.createDataFrame(opened, "path string").mapInArrow(_header_task, "path string, header string")
            .filter("header is not null").select(plain_path("path").alias("_file"), "header"))
    return read.unionByName(scanned_headers(spark, others)) if others else read


def scanned_headers(spark: SparkSession, paths: list[str]) -> DataFrame:
    lines = spark.read.text(literal_paths(paths)).select(
        "value", source_path().alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_pos"))
    return (lines.filter("_block = 0").filter(F.regexp_like("value", F.lit(r"[^\x00-\x20]")))
            .groupBy("_file").agg(F.min_by("value", "_pos").alias("header")))


def parsed(line: Column, width: int, sep: str) -> Column:
    """A CSV line and the mark as a struct of ``width`` + 1 texts c0, c1, ..."""
    options = {"sep": sep, "mode": "PERMISSIVE", "ignoreLeadingWhiteSpace": "false",
               "ignoreTrailingWhiteSpace": "false"}
    fits = F.length(line) - F.length(F.replace(line, F.lit(sep), F.lit(""))) < 20_000      # the parser's own limit
    return F.from_csv(F.when(fits, F.concat(line, F.lit(sep + _END))),
                      ", ".join(f"c{i} string" for i in range(width + 1)), options)


def cells(line: Column, width: int, sep: str) -> Column:
    """The cells of a CSV line as an array, or null if they are more than
    ``width`` or the line's quotes are not closed."""
    return let(let(parsed(line, width, sep), lambda r: F.array(*[r[f"c{i}"] for i in range(width + 1)])), lambda found: let(
        F.array_position(found, _END), lambda end: F.when(end > 0, F.slice(found, 1, (end - 1).cast("int")))))


def wide_cells(line: Column, sep: str) -> Column:
    """The cells of a CSV line of any width: quoted ones (a backslash escapes a
    quote in them) or what lies between separators. Null if a quote is not closed."""
    mark = re.escape(sep)
    quoted = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
    cell = f'(?s){mark}({quoted}(?={mark}|$)|"[^"]*$|.*?(?={mark}|$))'

    def plain(c):
        inside = F.replace(F.substring(c, F.lit(2), F.length(c) - 2), F.lit('\\"'), F.lit('"'))
        return F.nullif(F.when(F.regexp_like(c, F.lit(f"(?s)^{quoted}$")), inside).otherwise(c), F.lit(""))
    return let(F.regexp_extract_all(F.concat(F.lit(sep), line), F.lit(cell), F.lit(1)), lambda found: F.when(
        ~F.regexp_like(F.element_at(found, -1), F.lit('(?s)^"[^"]*$')), F.transform(found, plain)))


def column_names(header: Column) -> Column:
    """The names of a header's cells, all different: a blank cell is named
    ``_c<i>``, and a name that came before gets ``_<i>`` (more underscores
    if the header has that name too)."""
    trimmed = F.transform(header, lambda c, i: F.coalesce(
        F.nullif(F.trim(c), F.lit("")), F.concat(F.lit("_c"), i.cast("string"))))

    def distinct(names):
        def free(name, i):
            ways = F.transform(F.sequence(F.lit(1), F.size(names) + 1),
                               lambda k: F.concat(name, F.repeat(F.lit("_"), k), i.cast("string")))
            return F.filter(ways, lambda way: ~F.array_contains(names, way))[0]
        return F.transform(names, lambda n, i: F.when(
            (F.array_position(names, n) <= i) | (n == CORRUPT), free(n, i)).otherwise(n))
    return let(trimmed, distinct)


def _n_columns(header: Column, sep: str) -> Column:
    return F.size(F.split(header, F.concat(F.lit("\\Q"), F.lit(sep), F.lit("\\E"))))


def named_headers(headers: DataFrame, width: int, sep: str, any_wide: bool) -> DataFrame:
    """Per file: names, where the known columns are, whether there are others, and
    whether it is wide."""
    mark = F.regexp_replace("header", "^﻿", "")
    wide = (_n_columns(F.col("header"), sep) > MAX_COLUMNS) if any_wide else F.lit(False)
    found = cells(mark, width, sep)
    if any_wide:
        found = F.when(wide, wide_cells(mark, sep)).otherwise(found)
    named = headers.select("_file", wide.alias("_wide"), column_names(found).alias("_names"))
    places = [(F.array_position("_names", c) - 1).cast("int").alias(f"_at_{c}") for c in CLAIM_FIELDS]
    others = F.exists("_names", lambda n: ~n.isin(*CLAIM_FIELDS))
    return named.select("*", *places, others.alias("_others"))


def load_claim_files(spark: SparkSession, paths: list[str], sep: str = ",",
                     headers: DataFrame | None = None) -> DataFrame | None:
    """Raw claims from a set of CSV files, every file read by its own header.

    ``headers`` may be a (kept) ``file_headers`` of the same paths.
    """
    if not paths:
        return None
    lines = batch_lines(spark, paths)
    headers = headers if headers is not None else file_headers(spark, paths)
    count = _n_columns(F.col("header"), sep)
    most, total = headers.agg(F.max(count), F.sum(F.length("header"))).first()
    if most is None:
        return None
    widest, any_wide = min(most, MAX_COLUMNS), most > MAX_COLUMNS
    named = named_headers(headers, widest, sep, any_wide)
    named = F.broadcast(named) if total <= HEADER_BYTES else named
    # column by column: each step is used several times below and computed once
    value, others = F.col("value"), F.lit(None).cast("array<string>")
    if any_wide:
        others = let(wide_cells(value, sep), lambda found: F.when(F.size(found) <= most, found))
        value = F.when(~F.col("_wide"), value)
    rows = (lines.join(named, F.col("_source_file") == F.col("_file"))
            .withColumn("_row", parsed(value, widest, sep))
            .withColumn("_all", F.array(*[F.col("_row")[f"c{i}"] for i in range(widest + 1)]))
            .withColumn("_end", F.array_position("_all", _END).cast("int"))
            .withColumn("_cells", F.when(F.col("_end") > 0, F.slice("_all", F.lit(1), F.col("_end") - 1))
                        .otherwise(others)))
    known = [F.when(F.col(f"_at_{c}") >= 0, F.get("_cells", F.col(f"_at_{c}"))).alias(c) for c in CLAIM_FIELDS]
    whole = F.coalesce(F.size("_cells") == F.size("_names"), F.lit(False))
    extra = F.filter(F.arrays_zip("_names", "_cells"),
                     lambda x: x["_names"].isNotNull() & x["_cells"].isNotNull() & ~x["_names"].isin(*CLAIM_FIELDS))
    entries = F.concat(
        F.coalesce(F.transform(extra, lambda x: F.struct(x["_names"].alias("key"), x["_cells"].alias("value"))),
                   F.expr("array()")),
        F.when(whole, F.expr("array()")).otherwise(F.array(F.struct(F.lit(CORRUPT).alias("key"), "value"))))
    rescued = let(entries, lambda e: F.when(F.size(e) > 0, F.to_json(F.map_from_entries(e))))
    plain = whole & ~F.col("_others")
    return rows.select(*known, F.when(~plain, rescued).alias("_rescued_data"),
                       F.current_timestamp().alias("_ingested_at"), "_source_file").select(*RAW_CLAIMS.fieldNames())


def ingest_claims_csv(spark: SparkSession, landing_dir: str, table_dir: str, checkpoint_dir: str,
                      available_now: bool = True, path_glob: str | None = None,
                      max_files_per_trigger: int = 1000, sep: str = ",") -> StreamingQuery:
    """Start the ingest; with ``available_now`` it stops by itself when done."""
    track_schema(spark, checkpoint_dir, RAW_CLAIMS)

    def write(files: dict[str, int], stream_id: str, batch_id: int) -> None:
        paths = sorted(files)
        headers = file_headers(spark, paths).persist()        # one row per file, used twice
        try:
            raw = load_claim_files(spark, paths, sep, headers)
            if raw is not None:
                raw.write.mode("overwrite").parquet(batch_folder(table_dir, stream_id, batch_id))
        finally:
            headers.unpersist()
    return path_batches(spark, landing_dir, checkpoint_dir, write, path_glob, max_files_per_trigger, available_now)


def read_bronze_claims(spark: SparkSession, table_dir: str) -> DataFrame:
    """The bronze table; ``stream_id`` and ``batch_id`` name the micro-batch."""
    return spark.read.schema(BRONZE_CLAIMS).parquet(table_dir)
