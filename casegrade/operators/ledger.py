"""File ledger: what landed, its hash, size, record count and status.

Re-aimed as Spark jobs over files already in a landing folder (the network
transfer itself is not a Spark job and is not built):

* ``scan_files``        — one manifest row per file with the wanted suffix
                          (case-insensitive): size and SHA-256. Files are listed
                          by a task and hashed piece by piece inside tasks, so a
                          file of any size is hashed in bounded memory, and the
                          driver holds no file. (What Spark's reader has to list
                          is hashed on the JVM up to ``INLINE_BYTES``.) A file
                          that cannot be read is a FAILED row with the reason;
                          the others go on.
* ``payload_manifest``  — one row per JSON payload file: SHA-256 of its bytes,
                          record count, LANDED, or FAILED when it is not one
                          JSON document. ``layout="lines"`` counts JSON Lines
                          feeds line by line.
* ``new_files``         — candidate names minus names already LANDED for the
                          source (FAILED ones are offered again); a
                          ``left_anti`` join, never a driver-side set.
* ``flag_duplicate_content`` — copies per content hash via ``groupBy`` +
                          join (a hash held by a third of all files stays a
                          partial count per task, unlike a window).
* ``append_manifest``   — append with the declared schema.
* ``record_files`` / ``record_payloads`` — one ledger run: list the landing
                          folder once, leave out what the manifest has as LANDED
                          in one join, store the rest in pages of paths, scan and
                          append many pages at once, each as its own batch.

A manifest that a ledger run made is bucketed by landing path (``manifest_table``):
the join of a run brings the listing to the buckets, and the history stays where
it is.
"""

from __future__ import annotations

import fnmatch
import hashlib
import time
import uuid
from collections.abc import Callable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import let, plain_path, source_path
from ..functions.payload import document_texts, payload_hash, payload_record_count
from ..schemas import FAILED, FILE_MANIFEST, LANDED, PAYLOAD_MANIFEST
from ..session import located, scratch_dir, ship_package
from ..sources import store
from ..streaming.files import few_listing_tasks, literal_path, literal_paths
from ..streaming.large_json import cut_files
from ..streaming.medical_json import by_size, read_lines, read_whole
from .skew import SkewGuard, salted_left_join

#: Files of up to this size are read as one binary value.
INLINE_BYTES = 4 << 20
BUCKETS = 32
FILES_PER_PAGE = 10_000
#: Pages are read together up to about this many files; each has its own batch.
FILES_AT_ONCE = 100_000
#: Entries of a folder that the task which lists it holds.
LISTED_AT_ONCE = 10_000


def suffix_glob(suffix: str) -> str:
    """``.csv`` -> ``*.[cC][sS][vV]`` (a plain ``*.csv`` misses ``B.CSV``)."""
    return "*" + "".join(f"[{ch.lower()}{ch.upper()}]" if ch.isalpha() else ch for ch in suffix)


def _base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def _list_task(pattern: str | None):
    def batch_of(rows):
        paths, lengths, names, folders = zip(*rows)
        return pa.RecordBatch.from_arrays(
            [pa.array(paths, pa.string()), pa.array(lengths, pa.int64()), pa.array(names, pa.string()), pa.array(folders, pa.bool_())],
            ["path", "length", "file_name", "is_folder"])

    def run(batches):
        held = []
        for folder in (f for batch in batches for f in batch.column(0).to_pylist()):
            for name, is_folder, length in store.entries(folder):
                # what Spark's file sources leave out: hidden names, files of no bytes
                if name.startswith(".") or name.endswith("._COPYING_") or (name.startswith("_") and "=" not in name):
                    continue
                if is_folder or (length and (pattern is None or fnmatch.fnmatchcase(name, pattern))):
                    held.append((f"{folder.rstrip('/')}/{name}", length, name, is_folder))
                if len(held) == LISTED_AT_ONCE:
                    yield batch_of(held)
                    held = []
        if held:
            yield batch_of(held)
    return run


def stored_listing(spark: SparkSession, landing_dir: str, suffix: str | None) -> DataFrame | None:
    """(path, length, file_name) of the files of one folder, listed by a task and stored:
    Spark's readers hold every file of a listing in the driver.

    None for what is left to Spark's reader: a folder that holds folders (these may
    be partitions), a single file or a pattern, a store that pyarrow does not open.
    """
    folder = located(spark, landing_dir)
    if literal_path(folder) != folder or store.scheme(folder) not in store.STREAMED_SCHEMES or not store.is_folder(folder):
        return None
    ship_package(spark)
    stored, schema = scratch_dir(spark, "ledger-listing"), "path string, length bigint, file_name string, is_folder boolean"
    roots = spark.createDataFrame([(folder,)], "folder string").coalesce(1)
    (roots.mapInArrow(_list_task(suffix and suffix_glob(suffix)), schema)
     .write.mode("overwrite").parquet(stored))
    listed = spark.read.schema(schema).parquet(stored)
    if not listed.filter("is_folder").isEmpty():
        return None
    return listed.select(plain_path("path").alias("path"), "length", "file_name")


def list_files(spark: SparkSession, landing_dir: str, suffix: str | None = ".csv") -> DataFrame:
    """(path, length, file_name) of the landed files; no content is read.

    Files of no bytes are left out, as Spark's file sources do.
    """
    listed = stored_listing(spark, landing_dir, suffix)
    if listed is not None:
        return listed
    reader = spark.read.format("binaryFile")
    if suffix:
        reader = reader.option("pathGlobFilter", suffix_glob(suffix))
    return reader.load(landing_dir).select(
        plain_path("path").alias("path"), "length", _base_name(F.col("path")).alias("file_name"))


def _hash_task(batches):
    for batch in batches:
        found = []
        for path in batch.column(0).to_pylist():
            try:
                found.append((*store.sha256_of(path), None))
            except Exception as error:          # of this file alone: it becomes its FAILED row
                found.append((None, None, f"{type(error).__name__}: {error}"))
        digest, size, reason = zip(*found) if found else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(digest, pa.string()), pa.array(size, pa.int64()), pa.array(reason, pa.string())],
            [*batch.schema.names, "file_hash", "file_size_bytes", "error_message"])


def hash_files(files: DataFrame) -> DataFrame:
    """``files`` (first column ``path``) with file_hash, file_size_bytes, error_message.

    A SHA-256 is sequential, so a file is one task's work; the listing deals
    files out by size.
    """
    ship_package(files.sparkSession)
    out = files.withColumns({"file_hash": F.lit(""), "file_size_bytes": F.lit(0).cast("long"),
                             "error_message": F.lit("")})
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in out.schema.fields])
    return files.mapInArrow(_hash_task, schema)


def _row_of(hashed: DataFrame, source_system: str, remote_dir: str | None, keep: tuple = ()) -> DataFrame:
    ok = F.col("error_message").isNull()
    remote = F.concat(F.lit(remote_dir.rstrip("/") + "/"), "file_name") if remote_dir else F.lit(None).cast("string")
    return hashed.select(
        F.lit(source_system).alias("source_system"), "file_name", remote.alias("remote_path"),
        F.when(ok, F.col("path")).alias("landing_path"), "file_size_bytes", "file_hash",
        F.current_timestamp().alias("ingested_at"),
        F.when(ok, F.lit(LANDED)).otherwise(F.lit(FAILED)).alias("status"), "error_message", *keep)


def manifest_rows(files: DataFrame, source_system: str, remote_dir: str | None = None, keep: tuple = ()) -> DataFrame:
    """``list_files`` rows -> FILE_MANIFEST rows, every file read piece by piece."""
    return _row_of(hash_files(files.select("path", "file_name")), source_system, remote_dir, keep)


def inline_bytes(spark: SparkSession) -> int:
    """The largest file that is read as one value, here or by the session's own limit."""
    return min(INLINE_BYTES, int(spark.conf.get("spark.sql.sources.binaryFile.maxLength", str(INLINE_BYTES))))


def inline_hashes(files: DataFrame) -> DataFrame:
    """(path, file_name, file_hash, file_size_bytes, error_message) of ``binaryFile`` rows."""
    return files.select(plain_path("path").alias("path"), _base_name(F.col("path")).alias("file_name"),
                        F.sha2("content", 256).alias("file_hash"), F.col("length").alias("file_size_bytes"),
                        F.lit(None).cast("string").alias("error_message"))


def dealt(files: DataFrame, most_inline: int) -> DataFrame:
    """Stored ``files`` (path, length, ...) dealt to tasks that open them: a task for
    each large file and for each thousand of the others."""
    n, small = files.agg(F.count(F.lit(1)), F.count_if(F.col("length") <= most_inline)).first()
    tasks = max(n - small + small // 1000, int(files.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return files.repartition(max(1, min(n, tasks, FILES_PER_PAGE)))


def page_rows(spark: SparkSession, files: dict[str, int], source_system: str, remote_dir: str | None = None,
              keep_path: bool = False) -> DataFrame:
    """FILE_MANIFEST rows of the given files (path -> length); with ``keep_path``
    their paths, of FAILED ones too, as ``_file``.

    A file that the JVM does not find any more, or not with its size, goes the
    other way and gets its reason there.
    """
    most = inline_bytes(spark)
    keep = (F.col("path").alias("_file"),) if keep_path else ()
    small = [p for p, n in files.items() if n <= most]
    listed = spark.createDataFrame([(p, p.rpartition("/")[2]) for p in files], "path string, file_name string")
    if not small or all(store.scheme(p) in store.STREAMED_SCHEMES for p in files):
        # tasks open the files: a read by Spark would list each path again first
        n = max(len(files) - len(small) + len(small) // 1000, int(spark.conf.get("spark.sql.shuffle.partitions")))
        return manifest_rows(listed.repartition(min(len(files), n, FILES_PER_PAGE)), source_system, remote_dir, keep)
    try:
        with few_listing_tasks(spark):
            read = spark.read.format("binaryFile").option("ignoreMissingFiles", "true").load(literal_paths(small))
    except AnalysisException:                        # some path is gone: every file by itself
        return manifest_rows(listed.repartition(min(len(files), FILES_PER_PAGE)), source_system, remote_dir, keep)
    read = read.filter(F.col("length") <= most)
    folder = scratch_dir(spark, "ledger-hashes")
    inline_hashes(read).write.mode("overwrite").parquet(folder)
    done = spark.read.schema(inline_hashes(read).schema).parquet(folder)
    rest = listed.join(done.select("path"), "path", "left_anti").select("path", "file_name")
    if len(small) < len(files):
        rest = rest.repartition(min(len(files) - len(small), FILES_PER_PAGE))
    return _row_of(done.unionByName(hash_files(rest)), source_system, remote_dir, keep)


def scan_files(spark: SparkSession, landing_dir: str, source_system: str, suffix: str = ".csv",
               remote_dir: str | None = None) -> DataFrame:
    """Manifest rows (FILE_MANIFEST columns) for every file in ``landing_dir``.

    Tasks list and open the files of a plain folder; the driver holds none of them.
    """
    most = inline_bytes(spark)
    stored = stored_listing(spark, landing_dir, suffix)
    if stored is not None:
        return _row_of(hash_files(dealt(stored, most).select("path", "file_name")), source_system, remote_dir)
    listed = spark.read.format("binaryFile").option("pathGlobFilter", suffix_glob(suffix)).load(landing_dir)
    small = inline_hashes(listed.filter(F.col("length") <= most))
    # the same listing; few tasks start a Python worker, however many files were small
    large = listed.filter(F.col("length") > most).select(
        plain_path("path").alias("path"), _base_name(F.col("path")).alias("file_name")).repartition(
        int(spark.conf.get("spark.sql.shuffle.partitions")))
    return _row_of(small.unionByName(hash_files(large)), source_system, remote_dir)


def _payload_row(source_system: str, api_url: str | None, ok: Column, digest: Column, count: Column,
                 keep: tuple[str, ...] = ()) -> list:
    return [
        F.lit(source_system).alias("source_system"),
        F.lit(api_url).cast("string").alias("api_url"),
        F.when(ok, F.col("landing_path")).alias("landing_path"),
        F.when(ok, digest).alias("payload_hash"),
        F.when(ok, count).alias("record_count"),
        F.current_timestamp().alias("ingested_at"),
        F.when(ok, F.lit(LANDED)).otherwise(F.lit(FAILED)).alias("status"),
        F.when(~ok, F.concat(F.lit("payload is not one JSON document: "), F.col("landing_path"))
               ).alias("error_message"),
        *keep,
    ]


def payload_rows(texts: DataFrame, source_system: str, api_url: str | None = None,
                 keep: tuple[str, ...] = ()) -> DataFrame:
    """(value, landing_path) payload texts -> PAYLOAD_MANIFEST rows
    (plus the ``keep`` columns, carried through unchanged)."""
    # the documents are computed once and give both the status and the count
    read = let(document_texts("value"), lambda docs: F.struct(
        docs.isNotNull().alias("ok"), payload_record_count(docs).alias("n")))
    return texts.withColumn("_read", read).select(*_payload_row(
        source_system, api_url, F.col("_read.ok"), payload_hash("value"), F.col("_read.n"), keep))


def counted_rows(counted: DataFrame, hashed: DataFrame, source_system: str, api_url: str | None = None,
                 keep: tuple = ()) -> DataFrame:
    """(_path, _ok, _n) of files, and the ``hash_files`` of their paths ->
    PAYLOAD_MANIFEST rows."""
    met = hashed.withColumnRenamed("path", "landing_path").join(
        counted, F.col("landing_path") == F.col("_path"), "left")
    ok = F.coalesce(F.col("_ok"), F.lit(False)) & F.col("file_hash").isNotNull()
    rows = _payload_row(source_system, api_url, ok, F.col("file_hash"), F.col("_n"))
    return met.select(*rows[:-1], F.coalesce(F.col("error_message"), rows[-1]).alias("error_message"), *keep)


def payload_line_rows(lines: DataFrame, hashed: DataFrame, source_system: str, api_url: str | None = None,
                      keep: tuple = ()) -> DataFrame:
    """(value, landing_path) lines of JSON Lines feeds, and the ``hash_files``
    of their paths -> PAYLOAD_MANIFEST rows. Lines are counted where they are read."""
    read = let(document_texts("value"), lambda docs: F.struct(
        docs.isNotNull().alias("ok"), payload_record_count(docs).alias("n")))
    counted = (lines.withColumn("_read", read).groupBy(F.col("landing_path").alias("_path"))
               .agg(F.bool_and(F.col("_read.ok")).alias("_ok"), F.sum(F.col("_read.n")).alias("_n")))
    return counted_rows(counted, hashed, source_system, api_url, keep)


def payload_file_rows(spark: SparkSession, files: dict[str, int], source_system: str, api_url: str | None = None,
                      layout: str = "document", keep_path: bool = False) -> DataFrame:
    """PAYLOAD_MANIFEST rows of the given files (path -> length); with ``keep_path``
    their paths, of FAILED ones too, as ``_file``."""
    whole, lines = by_size(files, layout)
    keep = (F.col("landing_path").alias("_file"),) if keep_path else ()
    parts = []

    def hashed(paths):
        listed = spark.createDataFrame([(p,) for p in paths], "path string").select(plain_path("path").alias("path"))
        return hash_files(listed.repartition(min(len(paths), 10_000)))
    if lines and layout == "document":
        counts, _, single, lines, bad = cut_files(spark, {p: files[p] for p in lines})
        whole = whole + single
        known = [(p, True, n) for p, n in counts.items()] + [(p, False, None) for p in bad]
        if known:
            counted = spark.createDataFrame(known, "p string, _ok boolean, _n bigint").select(
                plain_path("p").alias("_path"), "_ok", "_n")
            parts.append(counted_rows(counted, hashed([p for p, _, _ in known]), source_system, api_url, keep))
    if whole:
        texts = read_whole(spark, {p: files[p] for p in whole}).withColumnRenamed("_source_file", "landing_path")
        parts.append(payload_rows(texts, source_system, api_url, keep))
    if lines:
        texts = read_lines(spark, lines).withColumnRenamed("_source_file", "landing_path")
        parts.append(payload_line_rows(texts, hashed(lines), source_system, api_url, keep))
    return reduce(DataFrame.unionByName, parts)


def payload_manifest(spark: SparkSession, landing_dir: str, source_system: str,
                     api_url: str | None = None, suffix: str | None = ".json") -> DataFrame:
    """``suffix=None`` takes every (non-hidden) file, as the JSON ingest does."""
    reader = spark.read
    if suffix:
        reader = reader.option("pathGlobFilter", suffix_glob(suffix))
    texts = reader.text(landing_dir, wholetext=True).select("value", source_path().alias("landing_path"))
    return payload_rows(texts, source_system, api_url)


def landed(manifest: DataFrame, source_system: str, key: str = "file_name") -> DataFrame:
    # distinct: a name recorded many times is pre-aggregated before the join
    return (manifest.filter((F.col("source_system") == source_system) & (F.col("status") == LANDED))
            .select(key).distinct())


def new_files(candidates: DataFrame, manifest: DataFrame, source_system: str,
              suffix: str | None = ".csv", key: str = "file_name") -> DataFrame:
    """Candidates with the suffix (of column ``key``) that are not yet LANDED."""
    c = candidates
    if suffix:
        c = c.filter(F.lower(F.col(key)).endswith(suffix.lower()))
    return c.join(landed(manifest, source_system, key), key, "left_anti")


def flag_duplicate_content(manifest: DataFrame, hash_col: str = "file_hash",
                           skew_guard: SkewGuard | None = SkewGuard()) -> DataFrame:
    """Adds ``n_copies`` and ``is_duplicate_content`` (same hash, other file).

    The join back is salted for hashes shared by a large share of the files.
    """
    copies = (manifest.filter(F.col(hash_col).isNotNull())
              .groupBy(hash_col).agg(F.count(F.lit(1)).alias("n_copies")))
    return (salted_left_join(manifest, copies, hash_col, skew_guard)
            .withColumn("is_duplicate_content", F.coalesce(F.col("n_copies") > 1, F.lit(False))))


def _schema(kind: str) -> T.StructType:
    return FILE_MANIFEST if kind == "file" else PAYLOAD_MANIFEST


def append_manifest(rows: DataFrame, path: str, kind: str = "file", batch_id: int | None = None,
                    page: str | None = None) -> dict:
    """Append manifest rows with the declared schema (types never inferred).

    Rows go to their own ``batch_id=<n>`` folder (default: the current time
    in microseconds; a write takes far longer than that), in the buckets of the
    manifest's table. So a manifest folder is a set of batch folders, and a
    repeated batch id replaces its own rows. With ``page``, a column of small
    numbers, the rows of each page go to a batch of their own, all in one write
    (their new ids count up from the current time). Returns the LANDED and
    FAILED counts, taken in the same pass.
    """
    spark = rows.sparkSession
    bid = batch_id if batch_id is not None else time.time_ns() // 1000
    table, buckets = manifest_table(spark, path, kind), manifest_buckets(spark, path)
    obs = Observation(f"{kind}_ledger")
    own = [F.col(page).alias("_page")] if page else []
    counted = rows.select(*_declared(_schema(kind)), *own).observe(
        obs, F.count_if(F.col("status") == LANDED).alias("landed"), F.count_if(F.col("status") == FAILED).alias("failed"))
    # rows may come from a join with this very manifest: they are read before its folder is written
    folder, view = scratch_dir(spark, "ledger-batch"), f"manifest_rows_{uuid.uuid4().hex}"
    counted.write.mode("overwrite").parquet(folder)
    stored = spark.read.schema(T.StructType(_schema(kind).fields + ([T.StructField("_page", T.LongType())] if page else [])))
    stored.parquet(folder).repartition(buckets, "landing_path").createOrReplaceTempView(view)
    try:
        if page:                                     # into folders that no batch had before
            spark.sql(f"insert into {table} select * except (_page), {bid} + _page from {view}")
        else:
            spark.sql(f"insert overwrite table {table} partition (batch_id = {bid}) select * from {view}")
    finally:
        spark.catalog.dropTempView(view)
    return {k: int(v or 0) for k, v in obs.get.items()}


def manifest_buckets(spark: SparkSession, path: str, buckets: int = BUCKETS) -> int:
    """The number of buckets of a manifest folder, kept beside it from its first run."""
    kept = f"{path.rstrip('/')}/_buckets"
    try:
        return int(spark.read.text(kept).first()[0])
    except AnalysisException:                        # the first run
        spark.createDataFrame([(str(buckets),)], "value string").coalesce(1).write.text(kept)
        return buckets


def manifest_table(spark: SparkSession, path: str, kind: str, buckets: int = BUCKETS) -> str:
    """The name of the external table over a manifest folder: a partition per
    batch, bucketed and sorted by landing path. Made where the catalog does not
    have it; ``manifest_by_name`` finds the batches of other applications."""
    name = f"audit.{kind}_manifest_{hashlib.md5(path.rstrip('/').encode()).hexdigest()[:12]}"
    spark.sql("create schema if not exists audit")
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in stored_schema(_schema(kind)).fields)
        where = path.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"create table if not exists {name} ({columns}) using parquet partitioned by (batch_id) "
                  f"clustered by (landing_path) sorted by (landing_path) into {manifest_buckets(spark, path, buckets)} buckets "
                  f"location '{where}'")
        spark.sql(f"alter table {name} recover partitions")
    return name


def manifest_by_name(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """The manifest read through its table."""
    name = manifest_table(spark, path, kind)
    spark.sql(f"alter table {name} recover partitions")
    spark.sql(f"refresh table {name}")
    return spark.table(name)


def stored_schema(schema: T.StructType) -> T.StructType:
    return T.StructType(schema.fields + [T.StructField("batch_id", T.LongType())])


def read_manifest(spark: SparkSession, path: str, kind: str = "file") -> DataFrame:
    """The manifest rows (declared columns plus ``batch_id``)."""
    return spark.read.schema(stored_schema(_schema(kind))).parquet(path)


def _declared(schema: T.StructType) -> list[Column]:
    return [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]


def unrecorded(files: DataFrame, manifest: DataFrame, source_system: str, buckets: int, by_name: bool = False) -> DataFrame:
    """The listed ``files`` (with ``landing_path``) without a LANDED row in a ``manifest_by_name``.

    The history is not shuffled: the files are dealt to its buckets. With
    ``by_name`` a row without a path (of an earlier manifest) counts for every
    file of its ``file_name``.
    """
    fresh = new_files(files.repartition(buckets, "landing_path"), manifest, source_system, None, key="landing_path")
    if by_name:
        fresh = new_files(fresh, manifest.filter(F.col("landing_path").isNull()), source_system, None)
    return fresh


def pages(fresh: DataFrame, files_per_page: int) -> Iterator[DataFrame]:
    """The files (landing_path, length, page) in pages of about ``files_per_page``, in
    path order; as many whole pages at once as hold about ``FILES_AT_ONCE``.

    Ranged and stored once; a page is then a folder of its own.
    """
    spark = fresh.sparkSession
    listed = scratch_dir(spark, "ledger-fresh")
    fresh.select("landing_path", "length").write.mode("overwrite").parquet(f"{listed}/all")
    stored = spark.read.schema("landing_path string, length bigint").parquet(f"{listed}/all")
    n = -(-stored.count() // files_per_page)
    if not n:
        return
    (stored.repartitionByRange(n, "landing_path").withColumn("page", F.spark_partition_id())
     .write.mode("overwrite").partitionBy("page").parquet(f"{listed}/pages"))
    paged = spark.read.schema("landing_path string, length bigint, page int").parquet(f"{listed}/pages")
    step = max(1, FILES_AT_ONCE // files_per_page)
    for first in range(0, n, step):
        found = paged.filter(F.col("page").between(first, first + step - 1))
        if not found.isEmpty():
            yield found


def collected(found: DataFrame, rows_of: Callable[[dict[str, int]], DataFrame]) -> DataFrame:
    """Ledger rows, with their page, by a function of paths and lengths in the driver."""
    files = {r.landing_path: (r.length, r.page) for r in found.collect()}
    numbers = found.sparkSession.createDataFrame([(path, page) for path, (_, page) in files.items()], "_file string, page bigint")
    return rows_of({path: length for path, (length, _) in files.items()}).join(F.broadcast(numbers), "_file")


def _record(spark: SparkSession, landing_dir: str, manifest_path: str, kind: str, source_system: str, suffix: str | None,
            files_per_page: int, rows_of: Callable[[DataFrame], DataFrame]) -> dict:
    files = list_files(spark, landing_dir, suffix).select(F.col("path").alias("landing_path"), "length", "file_name")
    fresh = unrecorded(files, manifest_by_name(spark, manifest_path, kind), source_system,
                       manifest_buckets(spark, manifest_path), by_name=kind == "file")
    totals = {"landed": 0, "failed": 0}
    for found in pages(fresh, files_per_page):
        run = append_manifest(rows_of(found), manifest_path, kind, page="page")
        totals = {k: totals[k] + run[k] for k in totals}
    return totals


def record_files(spark: SparkSession, landing_dir: str, manifest_path: str, source_system: str,
                 suffix: str = ".csv", remote_dir: str | None = None, files_per_page: int = FILES_PER_PAGE) -> dict:
    """Record the landed files whose paths are not LANDED yet; a FAILED file is
    offered again. Files of one name in several folders have a row each; a
    LANDED row without a path holds for every file of its name. Returns this
    run's ``{"landed": n, "failed": m}``.

    Tasks open the files, and their paths do not reach the driver; other stores'
    files are read by Spark, a page's paths at a time.
    """
    def rows(found: DataFrame) -> DataFrame:
        if store.scheme(located(spark, landing_dir)) not in store.STREAMED_SCHEMES:
            return collected(found, lambda files: page_rows(spark, files, source_system, remote_dir, keep_path=True))
        files = found.select(F.col("landing_path").alias("path"), _base_name(F.col("landing_path")).alias("file_name"),
                             "length", "page")
        hashed = hash_files(dealt(files, inline_bytes(spark)).drop("length"))
        return _row_of(hashed, source_system, remote_dir, (F.col("page").cast("long").alias("page"),))
    return _record(spark, landing_dir, manifest_path, "file", source_system, suffix, files_per_page, rows)


def record_payloads(spark: SparkSession, landing_dir: str, manifest_path: str, source_system: str,
                    api_url: str | None = None, suffix: str | None = None, layout: str = "document",
                    files_per_batch: int = FILES_PER_PAGE) -> dict:
    """Record the landed payloads that are not LANDED yet (hash, record count,
    status), about ``files_per_batch`` at a time."""
    return _record(spark, landing_dir, manifest_path, "payload", source_system, suffix, files_per_batch,
                   lambda found: collected(found, lambda files: payload_file_rows(
                       spark, files, source_system, api_url, layout, keep_path=True)))
