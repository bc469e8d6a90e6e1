"""What grows with the number of files: tasks, listings and passes, not results."""

import hashlib
import os

from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from casegrade.operators import ledger as L
from casegrade.plans import ledger_queries
from casegrade.session import scratch_dir
from casegrade.sources.landing import keyed, land_texts
from casegrade.streaming import large_json
from casegrade.streaming.files import _LISTING, LISTING_TASKS, few_listing_tasks, path_batches
from casegrade.streaming.medical_json import load_payload_files, parse_payloads, read_whole


def landed(spark, texts, folder):
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    land_texts(keyed("text", rows), folder)
    return {r.path: r.length for r in L.list_files(spark, folder, None).collect()}


def test_a_file_per_row_also_for_null_and_repeated_texts(spark):
    d = scratch_dir(spark, "t-land")
    texts = ["a", "a", None, "", "é\nb"]
    landed(spark, texts, f"{d}/l")
    landed(spark, ["a"], f"{d}/l")                               # another drop adds to it
    hashes = sorted(r.file_hash for r in L.scan_files(spark, f"{d}/l", "s", suffix=".txt").collect())
    assert hashes == sorted(hashlib.sha256(((t or "") + "\n").encode()).hexdigest() for t in texts + ["a"])
    latin = spark.createDataFrame([(1, "Mül")], "key int, value string")
    land_texts(latin, f"{d}/latin", ".csv", "ISO-8859-1")
    assert [bytes(r.content) for r in spark.read.format("binaryFile").load(f"{d}/latin").collect()] == ["Mül\n".encode("latin-1")]


def test_many_paths_are_listed_by_few_tasks_and_the_setting_is_restored(spark):
    before = spark.conf.get(_LISTING)
    with few_listing_tasks(spark):
        assert int(spark.conf.get(_LISTING)) <= LISTING_TASKS
    assert spark.conf.get(_LISTING) == before


def test_small_ranges_share_tasks(spark):
    files = {f"file:/p{i}": 1_000_000 for i in range(50)}
    assert large_json.n_ranges(files, 10_000) == 5000
    assert large_json.n_tasks(spark, files, 10_000) == large_json.RANGE_TASKS
    assert large_json.n_tasks(spark, {"file:/p": 100 << 30}, 1 << 20) == 3200        # by bytes


def test_payload_files_are_dealt_evenly_whatever_their_size(spark):
    d = scratch_dir(spark, "t-deal")
    files = landed(spark, ["[%s]" % ",".join(['{"claim_id":"A"}'] * n) for n in [1] * 60], f"{d}/l")
    read = read_whole(spark, files).withColumn("part", F.spark_partition_id())
    assert read.select("part").distinct().count() > 4
    rows = load_payload_files(spark, files).collect()
    assert len(rows) == 60 and {r._source_file for r in rows} == set(files)


def test_pages_are_written_together_as_batches_of_their_own(spark, monkeypatch):
    d = scratch_dir(spark, "t-pages")
    landed(spark, ['{"a":%d}' % i for i in range(20)] + ["{broken", "{broken too"], f"{d}/l")
    calls, append = [], L.append_manifest
    monkeypatch.setattr(L, "append_manifest", lambda *a, **k: calls.append(1) or append(*a, **k))
    assert L.record_payloads(spark, f"{d}/l", f"{d}/m", "api", files_per_batch=3) == {"landed": 20, "failed": 2}
    assert len(calls) == 1
    m = L.manifest_by_name(spark, f"{d}/m", "payload")
    assert m.count() == 22 and m.select("batch_id").distinct().count() >= 6
    monkeypatch.setattr(L, "FILES_AT_ONCE", 4)
    assert L.record_payloads(spark, f"{d}/l", f"{d}/m", "api", files_per_batch=1) == {"landed": 0, "failed": 2}
    assert L.record_files(spark, f"{d}/l", f"{d}/f", "sftp", ".txt", files_per_page=2) == {"landed": 22, "failed": 0}
    assert len(calls) > 4
    assert L.manifest_by_name(spark, f"{d}/f", "file").select("landing_path").distinct().count() == 22


def test_a_scan_lists_its_folder_once(spark, monkeypatch):
    d = scratch_dir(spark, "t-once")
    landed(spark, ["x"], f"{d}/l")
    monkeypatch.setattr(L, "list_files", lambda *a, **k: 1 / 0)
    assert L.scan_files(spark, f"{d}/l", "s", suffix=".txt").count() == 1


def test_a_record_row_does_not_carry_the_text_of_its_file(spark):
    text = spark.createDataFrame([("f", '[{"claim_id":"A"},null]'), ("g", '{"data":[{"claim_id":"B"}]}'), ("h", "{broken")],
                                 "_source_file string, value string")
    rows = parse_payloads(text)
    node = rows._jdf.queryExecution().optimizedPlan()
    while node.nodeName() != "Generate":
        node = node.children().apply(0)
    kept = node.requiredChildOutput()                            # neither the text nor the list of its records
    assert [kept.apply(i).name() for i in range(kept.size())] == ["_source_file"]
    assert sorted((r._source_file, r.claim_id or "", r._rescued_data or "") for r in rows.collect()) == [
        ("f", "", ""), ("f", "A", ""), ("g", "B", ""), ("h", "", '{"_corrupt_record":"{broken"}')]


def test_a_stream_lists_its_paths_in_few_tasks(spark):
    d = scratch_dir(spark, "t-stream")
    landed(spark, ["x"] * 150, f"{d}/l")
    before, got = spark.conf.get(_LISTING), {}
    query = path_batches(spark, f"{d}/l", f"{d}/c", lambda files, *_: got.update(files), max_files_per_trigger=1000)
    query.awaitTermination()
    assert len(got) == 150 and spark.conf.get(_LISTING) == before
    tracker = spark.sparkContext.statusTracker()
    stages = [s for job in tracker.getJobIdsForGroup(str(query.runId)) for s in tracker.getJobInfo(job).stageIds]
    assert stages and max(tracker.getStageInfo(s).numTasks for s in stages) <= LISTING_TASKS


def test_a_folder_is_listed_by_a_task_as_spark_lists_it(spark, monkeypatch):
    d = scratch_dir(spark, "t-entries") + "/a b%20+é"
    os.makedirs(d)
    for name in ("a.csv", "B.CSV", "c.txt", "_h.csv", ".q.csv", "_k=1.csv", "p[1].csv", "x%20+y.csv", "new\nline.csv", "t.csv._COPYING_"):
        with open(f"{d}/{name}", "w") as f:
            f.write(name)
    open(f"{d}/empty.csv", "w").close()
    os.symlink(f"{d}/a.csv", f"{d}/link.csv")
    os.symlink(f"{d}/nothing", f"{d}/dead.csv")
    monkeypatch.setattr(L, "LISTED_AT_ONCE", 2)
    for suffix in (".csv", None):
        found = L.list_files(spark, d, suffix)
        assert "binaryfile" not in found._jdf.queryExecution().executedPlan().toString().lower()
        reader = spark.read.format("binaryFile").option("pathGlobFilter", L.suffix_glob(suffix) if suffix else "*")
        theirs = reader.load(d).selectExpr("path", "length").collect()
        assert sorted((r.path, r.length) for r in found.collect()) == sorted((r.path, r.length) for r in theirs)
    assert {r.file_name for r in L.list_files(spark, d).collect()} == {
        "a.csv", "B.CSV", "_k=1.csv", "p[1].csv", "x%20+y.csv", "new\nline.csv", "link.csv"}
    assert [r.file_name for r in L.list_files(spark, f"{d}/a.csv").collect()] == ["a.csv"]


def test_a_file_run_keeps_paths_out_of_the_driver(spark, monkeypatch):
    d = scratch_dir(spark, "t-far")
    landed(spark, [f"x{i}" for i in range(23)], f"{d}/l")
    monkeypatch.setattr(L, "FILES_AT_ONCE", 8)
    sizes, plain = [], DataFrame.collect
    monkeypatch.setattr(DataFrame, "collect", lambda self: sizes.append(len(rows := plain(self))) or rows)
    assert L.record_files(spark, f"{d}/l", f"{d}/m", "sftp", ".txt", files_per_page=4) == {"landed": 23, "failed": 0}
    assert max(sizes, default=0) <= 1
    monkeypatch.undo()
    m = L.manifest_by_name(spark, f"{d}/m", "file")
    assert {r.file_hash for r in m.collect()} == {hashlib.sha256(f"x{i}\n".encode()).hexdigest() for i in range(23)}
    assert m.count() == 23 and m.select("batch_id").distinct().count() >= 5


def test_the_runs_of_the_ledger_are_numbered_whatever_their_pages(spark, monkeypatch):
    d = scratch_dir(spark, "t-runs")
    spark.createDataFrame([(i, f"text {i}") for i in range(20)], "doc_id bigint, text string").write.parquet(f"{d}/documents.parquet")
    monkeypatch.setattr(ledger_queries, "FILES_PER_PAGE", 2)
    rows = ledger_queries.q_ledger_runs(spark, d).collect()
    assert sorted((r.run, r.file_hash) for r in rows) == sorted(
        (i % 3, hashlib.sha256(f"text {i}\n".encode()).hexdigest()) for i in range(20))


def test_a_scan_keeps_the_files_of_a_folder_out_of_the_driver(spark, monkeypatch):
    d = scratch_dir(spark, "t-scan-far")
    landed(spark, ["a", "a", "b"] + [f"x{i}" for i in range(40)], f"{d}/l")
    monkeypatch.setattr(L, "INLINE_BYTES", 2)
    scan = L.scan_files(spark, f"{d}/l", "s", suffix=".txt")
    assert "binaryfile" not in scan._jdf.queryExecution().executedPlan().toString().lower()
    assert sorted(r.file_hash for r in scan.collect()) == sorted(
        hashlib.sha256(f"{t}\n".encode()).hexdigest() for t in ["a", "a", "b"] + [f"x{i}" for i in range(40)])
    assert sorted(r.n_copies for r in L.flag_duplicate_content(scan).collect()) == [1] * 41 + [2, 2]


def test_few_bytes_in_many_files_are_dealt_to_few_tasks(spark):
    d = scratch_dir(spark, "t-few")
    files = landed(spark, ["[]"] * 300, f"{d}/l")
    before, cores = spark.conf.get("spark.sql.shuffle.partitions"), spark.sparkContext.defaultParallelism
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        assert 4 < read_whole(spark, files).rdd.getNumPartitions() <= max(5, 2 * cores)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
