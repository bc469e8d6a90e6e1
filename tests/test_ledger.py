import hashlib
import json
import os

from pyspark.sql import functions as F

from casegrade.functions.payload import document_texts, is_one_document, payload_record_count
from casegrade.operators import ledger as L
from casegrade.session import scratch_dir


def test_suffix_glob():
    assert L.suffix_glob(".csv") == "*.[cC][sS][vV]"


def test_scan_files_hash_size_and_suffix(spark):
    d = scratch_dir(spark, "t-scan")
    files = {"a.csv": b"x,y\n1,2\n", "B.CSV": "é,ü\n".encode(), "c.txt": b"no", "d.csv": b"x,y\n1,2\n"}
    for n, b in files.items():
        with open(os.path.join(d, n), "wb") as f:
            f.write(b)
    rows = {r.file_name: r for r in L.scan_files(spark, d, "sftp_claims", remote_dir="/outbound/claims").collect()}
    assert set(rows) == {"a.csv", "B.CSV", "d.csv"}
    for n in rows:
        assert rows[n].file_hash == hashlib.sha256(files[n]).hexdigest()
        assert rows[n].file_size_bytes == len(files[n]) and rows[n].status == "LANDED"
        assert rows[n].remote_path == f"/outbound/claims/{n}" and rows[n].source_system == "sftp_claims"
    dup = {r.file_name: (r.n_copies, r.is_duplicate_content)
           for r in L.flag_duplicate_content(L.scan_files(spark, d, "sftp_claims")).collect()}
    assert dup == {"a.csv": (2, True), "d.csv": (2, True), "B.CSV": (1, False)}


def test_file_of_many_pieces(spark, monkeypatch):
    from casegrade.sources import store
    d = scratch_dir(spark, "t-pieces")
    data = os.urandom(1000)
    with open(os.path.join(d, "big.csv"), "wb") as f:
        f.write(data)
    monkeypatch.setattr(store, "PIECE", 7)
    assert store.sha256_of(f"file:{d}/big.csv") == (hashlib.sha256(data).hexdigest(), 1000)


def test_unreadable_file_fails_alone(spark):
    d = scratch_dir(spark, "t-gone")
    with open(os.path.join(d, "a.csv"), "wb") as f:
        f.write(b"x")
    listed = spark.createDataFrame([(f"file:{d}/a.csv", "a.csv"), (f"file:{d}/gone.csv", "gone.csv")],
                                   "path string, file_name string")
    rows = {r.file_name: r for r in L.manifest_rows(listed, "sftp_claims").collect()}
    assert rows["a.csv"].status == "LANDED" and rows["a.csv"].file_size_bytes == 1
    gone = rows["gone.csv"]
    assert gone.status == "FAILED" and gone.file_hash is None and gone.landing_path is None and gone.error_message


def test_new_files_skip_landed_retry_failed(spark):
    cand = spark.createDataFrame([("a.csv",), ("b.csv",), ("c.csv",), ("D.CSV",), ("e.txt",)], "file_name string")
    man = spark.createDataFrame([
        ("sftp_claims", "a.csv", "LANDED"), ("sftp_claims", "b.csv", "FAILED"),
        ("api_medical_activity", "c.csv", "LANDED")], "source_system string, file_name string, status string")
    got = sorted(r.file_name for r in L.new_files(cand, man, "sftp_claims").collect())
    assert got == ["D.CSV", "b.csv", "c.csv"]


def test_payload_record_counts(spark):
    texts = [
        json.dumps([{"a": 1}, {"a": 2}], indent=2),   # list -> 2
        json.dumps({"data": [1, 2, 3]}),                # data -> 3
        json.dumps({"results": [1]}),                   # results -> 1
        json.dumps({"data": 3, "claim_id": "C5"}),      # single -> 1
        "[]",                                           # empty list -> 0
        '{"a":1}\n{"b":2}',                             # JSON Lines -> 2
        "{broken",                                      # not JSON
        "",                                             # blank -> not JSON
        '{"a":1} xx',                                   # trailing junk -> not JSON
    ]
    df = spark.createDataFrame([(t, f"f{i}") for i, t in enumerate(texts)], "value string, landing_path string")
    rows = L.payload_rows(df, "api_medical_activity", "https://api.example/x").collect()
    by = {r.landing_path: r for r in rows}
    counts = [by[f"f{i}"].record_count if f"f{i}" in by else None for i in range(len(texts))]
    status = [r.status for r in sorted(rows, key=lambda r: int((r.landing_path or "f99")[1:]))]
    assert counts[:6] == [2, 3, 1, 1, 0, 2]
    assert sorted(status).count("FAILED") == 3
    ok = [r for r in rows if r.status == "LANDED"]
    assert all(r.payload_hash == hashlib.sha256(texts[int(r.landing_path[1:])].encode()).hexdigest() for r in ok)
    failed = [r for r in rows if r.status == "FAILED"]
    assert all(r.payload_hash is None and r.record_count is None and r.error_message for r in failed)


def test_append_manifest_with_all_null_column(spark):
    d = scratch_dir(spark, "t-manifest")
    rows = spark.createDataFrame([("sftp_claims", "a.csv", "LANDED")], "source_system string, file_name string, status string")
    full = rows.select("source_system", "file_name", F.lit(None).alias("remote_path"), F.lit(None).alias("landing_path"),
                       F.lit(None).alias("file_size_bytes"), F.lit(None).alias("file_hash"),
                       F.current_timestamp().alias("ingested_at"), "status", F.lit(None).alias("error_message"))
    L.append_manifest(full, d)
    L.append_manifest(full, d)
    m = L.read_manifest(spark, d)
    assert m.count() == 2 and dict(m.dtypes)["file_size_bytes"] == "bigint"


def test_one_document_strict(spark):
    df = spark.createDataFrame([('{"a":1}',), ('{"a":1} x',), ('[1] [2]',)], "t string")
    got = [r.ok for r in df.select(is_one_document(F.col("t")).alias("ok")).collect()]
    assert got == [True, False, False]
    n = df.select(payload_record_count(document_texts("t")).alias("n")).collect()
    assert [r.n for r in n] == [1, None, None]


def test_payload_file_name(spark):
    import datetime as dt

    from casegrade.functions.payload import payload_file_name
    df = spark.createDataFrame([(dt.datetime(2026, 5, 1, 7, 8, 9),)], "ts timestamp")
    assert df.select(payload_file_name(F.col("ts")).alias("n")).first().n == "medical_activity_20260501_070809.json"


def test_record_files_hashes_each_file_once(spark):
    d = scratch_dir(spark, "t-record")
    land = f"{d}/landing"
    os.makedirs(land)
    with open(f"{land}/a.csv", "wb") as f:
        f.write(b"claim_id\nA\n")
    assert L.record_files(spark, land, f"{d}/manifest", "sftp_claims") == {"landed": 1, "failed": 0}
    assert L.record_files(spark, land, f"{d}/manifest", "sftp_claims") == {"landed": 0, "failed": 0}
    with open(f"{land}/b.CSV", "wb") as f:
        f.write(b"claim_id\nB\n")
    with open(f"{land}/c.txt", "wb") as f:
        f.write(b"not a claim file")
    assert L.record_files(spark, land, f"{d}/manifest", "sftp_claims") == {"landed": 1, "failed": 0}
    m = L.read_manifest(spark, f"{d}/manifest")
    assert sorted(r.file_name for r in m.collect()) == ["a.csv", "b.CSV"]
    assert {r.file_hash for r in m.collect()} == {hashlib.sha256(b"claim_id\nA\n").hexdigest(),
                                                 hashlib.sha256(b"claim_id\nB\n").hexdigest()}


def test_failed_names_are_offered_again_and_landed_ones_are_not(spark):
    d = scratch_dir(spark, "t-retry")
    land = f"{d}/landing"
    os.makedirs(f"{land}/other")
    for name in ("a.csv", "b.csv"):
        with open(f"{land}/{name}", "wb") as f:
            f.write(name.encode())
    failed = spark.createDataFrame([("sftp_claims", "a.csv", "FAILED"), ("sftp_claims", "b.csv", "LANDED")],
                                   "source_system string, file_name string, status string")
    for c, t in (("remote_path", "string"), ("landing_path", "string"), ("file_size_bytes", "bigint"), ("file_hash", "string"),
                 ("ingested_at", "timestamp"), ("error_message", "string")):
        failed = failed.withColumn(c, F.lit(None).cast(t))
    assert L.append_manifest(failed, f"{d}/manifest") == {"landed": 1, "failed": 1}
    assert L.record_files(spark, land, f"{d}/manifest", "sftp_claims") == {"landed": 1, "failed": 0}
    with open(f"{land}/other/b.csv", "wb") as f:              # a new path with a LANDED name
        f.write(b"again")
    assert L.record_files(spark, land, f"{d}/manifest", "sftp_claims") == {"landed": 0, "failed": 0}
    got = sorted((r.file_name, r.status) for r in L.read_manifest(spark, f"{d}/manifest").collect())
    assert got == [("a.csv", "FAILED"), ("a.csv", "LANDED"), ("b.csv", "LANDED")]


def test_payload_runs_in_pages_and_line_mode(spark):
    d = scratch_dir(spark, "t-payload-pages")
    land = f"{d}/landing"
    os.makedirs(land)
    for i in range(5):
        with open(f"{land}/p{i}.json", "w") as f:
            f.write('{"a":1}\n[1,2,3]\n' if i != 3 else '{"a":1}\n{broken\n')
    for layout in ("document", "lines"):
        m = f"{d}/{layout}"
        assert L.record_payloads(spark, land, m, "api", layout=layout, files_per_batch=2) == {"landed": 4, "failed": 1}
        assert L.record_payloads(spark, land, m, "api", layout=layout) == {"landed": 0, "failed": 1}
        rows = [r for r in L.read_manifest(spark, m, "payload").collect() if r.status == "LANDED"]
        assert {r.record_count for r in rows} == {4}
        assert {r.payload_hash for r in rows} == {hashlib.sha256(b'{"a":1}\n[1,2,3]\n').hexdigest()}


def test_record_files_with_glob_characters_in_names(spark):
    d = scratch_dir(spark, "t-record-glob")
    land = f"{d}/landing"
    os.makedirs(land)
    for name in ("a[1].csv", "b{x,y}.csv", "plain.csv"):
        with open(f"{land}/{name}", "wb") as f:
            f.write(name.encode())
    assert L.record_files(spark, land, f"{d}/manifest", "sftp_claims") == {"landed": 3, "failed": 0}
    m = L.read_manifest(spark, f"{d}/manifest").collect()
    assert sorted(r.file_name for r in m) == ["a[1].csv", "b{x,y}.csv", "plain.csv"]
    assert sorted(r.file_size_bytes for r in m) == sorted(len(n) for n in ("a[1].csv", "b{x,y}.csv", "plain.csv"))


def test_one_name_in_two_folders_has_a_row_each(spark):
    from casegrade.operators import ledger as L
    from casegrade.session import scratch_dir
    d = scratch_dir(spark, "t-same-name")

    def land(day, text):
        os.makedirs(f"{d}/landing/date={day}")
        with open(f"{d}/landing/date={day}/claims.csv", "w", encoding="utf-8") as f:
            f.write(text)
    land("a", "claim_id\nA\n")
    land("b", "claim_id\nB\n")
    assert L.record_files(spark, f"{d}/landing", f"{d}/m", "sftp") == {"landed": 2, "failed": 0}
    land("c", "claim_id\nC\n")
    assert L.record_files(spark, f"{d}/landing", f"{d}/m", "sftp") == {"landed": 1, "failed": 0}
    assert L.record_files(spark, f"{d}/landing", f"{d}/m", "sftp") == {"landed": 0, "failed": 0}
    rows = L.read_manifest(spark, f"{d}/m").collect()
    assert sorted(r.landing_path.split("/")[-2] for r in rows) == ["date=a", "date=b", "date=c"]
    assert len({r.file_hash for r in rows}) == 3 and {r.file_name for r in rows} == {"claims.csv"}


def test_hashes_are_the_same_around_the_inline_bound(spark, monkeypatch):
    d = scratch_dir(spark, "t-inline")
    for i, data in enumerate((b"1", b"12345", b"123456", b"1234567")):
        with open(f"{d}/f{i}.csv", "wb") as f:
            f.write(data)
    files = {f"file:{d}/f{i}.csv": os.path.getsize(f"{d}/f{i}.csv") for i in range(4)}

    def rows(df):
        return sorted((r.file_name, r.landing_path, r.file_size_bytes, r.file_hash, r.status, r.error_message) for r in df.collect())
    results = []
    for bound in (0, 1, 6, 1 << 20):
        monkeypatch.setattr(L, "INLINE_BYTES", bound)
        results += [rows(L.scan_files(spark, d, "s")), rows(L.page_rows(spark, files, "s"))]
    assert all(r == results[0] for r in results) and len(results[0]) == 4
    assert [r[3] for r in results[0]] == [hashlib.sha256(b).hexdigest() for b in (b"1", b"12345", b"123456", b"1234567")]
    gone = rows(L.page_rows(spark, files | {f"file:{d}/gone.csv": 3}, "s"))
    assert [r[4] for r in gone] == ["LANDED"] * 4 + ["FAILED"] and gone[:4] == results[0]


def test_history_is_not_shuffled_and_a_run_lists_once(spark, monkeypatch):
    d = scratch_dir(spark, "t-buckets")
    os.makedirs(f"{d}/landing")
    for i in range(30):
        with open(f"{d}/landing/p{i}.json", "w") as f:
            f.write('{"a":%d}' % i)
    calls = []
    for name in ("list_files", "new_files"):
        plain = getattr(L, name)
        monkeypatch.setattr(L, name, lambda *a, _f=plain, _n=name, **k: calls.append(_n) or _f(*a, **k))
    assert L.record_payloads(spark, f"{d}/landing", f"{d}/m", "api", files_per_batch=7) == {"landed": 30, "failed": 0}
    assert calls == ["list_files", "new_files"]              # one listing and one join, whatever the pages
    manifest = L.manifest_by_name(spark, f"{d}/m", "payload")
    assert manifest.select("batch_id").distinct().count() >= 4
    assert manifest.count() == L.read_manifest(spark, f"{d}/m", "payload").count() == 30
    files = L.list_files(spark, f"{d}/landing", None).withColumnRenamed("path", "landing_path")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fresh = L.unrecorded(files, manifest, "api", L.manifest_buckets(spark, f"{d}/m"))
        plan = fresh._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1 and "Bucketed: true" in plan          # the listing's own
        assert fresh.count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert L.manifest_buckets(spark, f"{d}/m", 7) == L.BUCKETS                   # kept from the first run


def test_a_compressed_file_is_hashed_as_it_is_stored(tmp_path):
    import gzip

    from casegrade.sources.store import first_line, sha256_of
    stored = gzip.compress(b"\nclaim_id,body_part\nA,knee\n")
    (tmp_path / "claims.csv.gz").write_bytes(stored)
    assert sha256_of(f"file:{tmp_path}/claims.csv.gz") == (hashlib.sha256(stored).hexdigest(), len(stored))
    assert first_line(f"file:{tmp_path}/claims.csv.gz") == "claim_id,body_part"
