import json
import os

from pyspark.sql import functions as F

from casegrade.session import scratch_dir
from casegrade.streaming.claims_csv import (cells, column_names, ingest_claims_csv, load_claim_files,
                                            read_bronze_claims)
from casegrade.streaming.files import batch_folder
from casegrade.streaming.medical_json import ingest_medical_json, read_bronze_medical


def _put(d, name, text):
    with open(os.path.join(d, name), "w") as f:
        f.write(text)


def _run_json(spark, d):
    ingest_medical_json(spark, f"{d}/landing", f"{d}/bronze", f"{d}/ckpt").awaitTermination()
    return read_bronze_medical(spark, f"{d}/bronze")


def test_json_shapes_rescue_and_corrupt(spark):
    d = scratch_dir(spark, "t-json")
    land = f"{d}/landing"
    os.makedirs(land)
    _put(land, "a.json", json.dumps([
        {"claim_id": "C1", "medical_events": [{"type": "surgery", "date": "2026-01-01"}]},
        {"claim_id": "C2", "provider": "x", "medical_events": "oops"}], indent=2, ensure_ascii=False))
    _put(land, "b.json", json.dumps({"data": [{"claim_id": "C3", "medical_events": []}]}, indent=2))
    _put(land, "c.json", "{broken")
    _put(land, "d.json", json.dumps({"claim_id": "C5", "data": 3}, indent=2))
    _put(land, "e.json", '{"claim_id":"C6"}\n{"claim_id":7, "medical_events": null}\n')
    _put(land, "f.json", "[]")
    _put(land, "g.json", json.dumps({"results": [{"claim_id": "C8", "medical_events": [{"type": "X", "date": "d"}]}]}))
    _put(land, "h.json", '{"claim_id":"C9"} trailing')
    rows = _run_json(spark, d).collect()
    by_id = {r.claim_id: r for r in rows}
    assert set(by_id) == {"C1", "C2", "C3", None, "C5", "C6", "7", "C8"}
    assert by_id["C1"].medical_events[0].type == "surgery" and by_id["C1"]._rescued_data is None
    assert json.loads(by_id["C2"]._rescued_data) == {"provider": "x", "medical_events": "oops"}
    assert by_id["C2"].medical_events is None
    assert by_id["C3"].medical_events == []
    assert json.loads(by_id["C5"]._rescued_data) == {"data": 3}
    assert by_id["7"]._rescued_data is None          # explicit JSON null is not rescued
    corrupt = sorted(json.loads(r._rescued_data)["_corrupt_record"] for r in rows if r.claim_id is None)
    assert corrupt == sorted(["{broken", '{"claim_id":"C9"} trailing'])
    assert all(r._source_file.endswith(".json") and r._ingested_at is not None for r in rows)


def test_json_each_file_once_over_runs(spark):
    d = scratch_dir(spark, "t-json-inc")
    land = f"{d}/landing"
    os.makedirs(land)
    _put(land, "a.json", json.dumps([{"claim_id": "A"}]))
    assert _run_json(spark, d).count() == 1
    _put(land, "b.json", json.dumps([{"claim_id": "B"}, {"claim_id": "C"}]))
    assert _run_json(spark, d).count() == 3
    assert _run_json(spark, d).count() == 3


def test_column_names(spark):
    cases = {'a,"b,c", d ,a,': ["a", "b,c", "d", "a_3", "_c4"],
             "claim_id,Claim_ID": ["claim_id", "Claim_ID"],
             "claim_id,x,x_3,x": ["claim_id", "x", "x_3", "x__3"],
             "x,x,x": ["x", "x_1", "x_2"], "_corrupt_record": ["_corrupt_record_0"]}
    df = spark.createDataFrame([(h,) for h in cases], "header string")
    got = {r.header: r.names for r in df.select("header", column_names(cells(F.col("header"), 8, ",")).alias("names")).collect()}
    assert got == cases


def test_headers_that_look_alike_do_not_stop_the_feed(spark):
    d = scratch_dir(spark, "t-csv-alike")
    land = f"{d}/landing"
    os.makedirs(land)
    _put(land, "a.csv", "claim_id,Claim_ID\nA1,A2\n")
    _put(land, "b.csv", "claim_id,x,x_3,x\nB1,1,2,3\n")
    _put(land, "c.csv", "claim_id\nC1\n")
    _put(land, "d.csv", 'claim_id,body_part\n"D1,knee\nD2,"a\nD3,arm,more,cells,than,any,header\nD4,arm\n')
    ingest_claims_csv(spark, land, f"{d}/bronze", f"{d}/ckpt").awaitTermination()
    rows = read_bronze_claims(spark, f"{d}/bronze").collect()
    by_id = {r.claim_id: r._rescued_data and json.loads(r._rescued_data) for r in rows}
    assert by_id["A1"] == {"Claim_ID": "A2"} and by_id["B1"] == {"x": "1", "x_3": "2", "x__3": "3"}
    assert by_id["C1"] is None and by_id["D4"] is None
    lost = sorted(json.loads(r._rescued_data)["_corrupt_record"] for r in rows if r.claim_id is None)
    assert lost == sorted(['"D1,knee', 'D2,"a', "D3,arm,more,cells,than,any,header"])


def test_one_scan_for_any_number_of_headers(spark):
    d = scratch_dir(spark, "t-csv-many")
    for i in range(30):
        _put(d, f"f{i}.csv", f"x{i},claim_id\nv,C{i}\n")
    df = load_claim_files(spark, [f"file:{d}/f{i}.csv" for i in range(30)])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("FileScan csv") == 1
    got = {r.claim_id: json.loads(r._rescued_data) for r in df.collect()}
    assert got == {f"C{i}": {f"x{i}": "v"} for i in range(30)}


def test_each_file_loses_its_header_and_no_other_line(spark, monkeypatch):
    from casegrade.sources import store
    from casegrade.streaming import claims_csv as C
    d = scratch_dir(spark, "t-csv-lines")
    header = "claim_id,body_part," + ",".join(f"x{i}" for i in range(40))
    rest = "," * 40
    texts = {"again.csv": f"{header}\nA{rest},\n{header}\nB,{rest}\n{header}\n",
             "blank.csv": f"\n \t\n\r\n{header}\r\n\t\r\nC,{rest}\r\n",
             "mac.csv": f"{header}\rD,{rest}\rE,{rest}", "only.csv": header, "none.csv": "\n\n",
             "odd.csv": f"{header}\n F ,\x00\x01,{rest[1:]}\n\x00G{rest},\n\x01uncut\x01H,{rest}\nI\x01uncut\x01,{rest}\n"
                        f"J,é ,{rest[1:]}\n" + "," * 30_000 + "\n"}
    for name, text in texts.items():
        with open(f"{d}/{name}", "w", newline="", encoding="utf-8-sig" if name == "again.csv" else "utf-8") as f:
            f.write(text)
    paths = [f"file:{d}/{name}" for name in texts]

    def rows():
        found = C.load_claim_files(spark, paths).collect()
        return sorted((r._source_file.rpartition("/")[2], r.claim_id or "", r.body_part or "") for r in found)
    want = sorted([("again.csv", c, b) for c, b in (("A", ""), ("B", ""), *[("claim_id", "body_part")] * 2)]
                  + [("blank.csv", "C", ""), ("mac.csv", "D", ""), ("mac.csv", "E", ""), ("odd.csv", " F ", "\x00\x01"),
                     ("odd.csv", "\x00G", ""), ("odd.csv", "\x01uncut\x01H", ""), ("odd.csv", "I\x01uncut\x01", ""),
                     ("odd.csv", "J", "é "), ("odd.csv", "", "")])
    assert rows() == want
    read = {r._file: r.header for r in C.file_headers(spark, paths).collect()}
    assert read == {r._file: r.header for r in C.scanned_headers(spark, paths).collect()} and len(read) == 5
    monkeypatch.setattr(store, "FIRST_PIECE", 5)     # a header longer than what is read first
    assert {store.first_line(p) for p in paths} == {header, None}


def test_csv_by_name_rescue_and_ids(spark):
    d = scratch_dir(spark, "t-csv")
    land = f"{d}/landing"
    os.makedirs(land)
    _put(land, "a.csv", "claim_id,date_of_loss,body_part,is_litigated,number_of_priors\n"
                        "007,2026-01-05, Spine ,true,3\nC2,2026-01-06,knee\nC3,2026-01-07,back,false,1,EXTRA\n")
    _put(land, "b.CSV", "number_of_priors,claim_id,body_part,date_of_loss,is_litigated,adjuster\n"
                        "4,C4,head,2026-02-01,no,Ann\n")
    _put(land, "c.csv", "claim_id,body_part\nC5,arm\n")
    ingest_claims_csv(spark, land, f"{d}/bronze", f"{d}/ckpt").awaitTermination()
    rows = {r.claim_id: r for r in read_bronze_claims(spark, f"{d}/bronze").collect()}
    assert set(rows) == {"007", "C2", "C3", "C4", "C5"}
    assert rows["007"].body_part == " Spine " and rows["007"].number_of_priors == "3"
    assert rows["C4"].number_of_priors == "4" and rows["C4"].date_of_loss == "2026-02-01"
    assert json.loads(rows["C4"]._rescued_data) == {"adjuster": "Ann"}
    assert rows["C2"].is_litigated is None and "_corrupt_record" in json.loads(rows["C2"]._rescued_data)
    assert json.loads(rows["C3"]._rescued_data)["_corrupt_record"].endswith("EXTRA")
    assert rows["C5"].date_of_loss is None and rows["C5"]._rescued_data is None


def test_csv_exactly_once_and_replay_idempotent(spark):
    d = scratch_dir(spark, "t-csv-inc")
    land = f"{d}/landing"
    os.makedirs(land)
    _put(land, "a.csv", "claim_id\nA\n")
    ingest_claims_csv(spark, land, f"{d}/bronze", f"{d}/ckpt").awaitTermination()
    _put(land, "b.csv", "claim_id\nB\nC\n")
    ingest_claims_csv(spark, land, f"{d}/bronze", f"{d}/ckpt").awaitTermination()
    ingest_claims_csv(spark, land, f"{d}/bronze", f"{d}/ckpt").awaitTermination()
    bronze = read_bronze_claims(spark, f"{d}/bronze")
    assert sorted(r.claim_id for r in bronze.collect()) == ["A", "B", "C"]
    # a batch replayed after a failure replaces its own output
    stream = bronze.select("stream_id").distinct().collect()
    assert len(stream) == 1
    load_claim_files(spark, [f"file:{land}/b.csv"]).write.mode("overwrite").parquet(
        batch_folder(f"{d}/bronze", stream[0].stream_id, 1))
    bronze = read_bronze_claims(spark, f"{d}/bronze")
    assert sorted(r.claim_id for r in bronze.collect()) == ["A", "B", "C"]
    assert {r.batch_id: r.n for r in bronze.groupBy("batch_id").agg(F.count("*").alias("n")).collect()} == {0: 1, 1: 2}


def test_schema_registry_detects_code_change(spark):
    import pytest
    from pyspark.sql import types as T

    from casegrade.streaming.schema_registry import SchemaChanged, read_schema, track_schema
    d = scratch_dir(spark, "t-schema")
    s1 = T.StructType([T.StructField("a", T.StringType())])
    assert read_schema(spark, d) is None
    track_schema(spark, d, s1)
    assert read_schema(spark, d) == s1
    track_schema(spark, d, s1)
    with pytest.raises(SchemaChanged):
        track_schema(spark, d, T.StructType([T.StructField("a", T.IntegerType())]))


def test_csv_odd_header_names_and_blank_lines(spark):
    d = scratch_dir(spark, "t-csv-odd")
    land = f"{d}/landing"
    os.makedirs(land)
    _put(land, "a.csv", '\n claim_id ,"note, free",`x`.y,claim_id\n\nC1,hello,z,dup\n\n')
    ingest_claims_csv(spark, land, f"{d}/bronze", f"{d}/ckpt").awaitTermination()
    rows = read_bronze_claims(spark, f"{d}/bronze").collect()
    assert len(rows) == 1 and rows[0].claim_id == "C1"
    assert json.loads(rows[0]._rescued_data) == {"note, free": "hello", "`x`.y": "z", "claim_id_3": "dup"}


def test_second_checkpoint_destroys_nothing(spark):
    d = scratch_dir(spark, "t-second-ckpt")
    for name in ("old", "new"):
        os.makedirs(f"{d}/{name}")
        _put(f"{d}/{name}", "a.csv", f"claim_id\n{name.upper()}\n")
        ingest_claims_csv(spark, f"{d}/{name}", f"{d}/bronze", f"{d}/ckpt-{name}").awaitTermination()
    assert sorted(r.claim_id for r in read_bronze_claims(spark, f"{d}/bronze").collect()) == ["NEW", "OLD"]


def test_no_record_is_lost_and_no_file_stops_the_feed(spark):
    from casegrade.operators import ledger as L
    d = scratch_dir(spark, "t-json-dirty")
    land = f"{d}/landing"
    os.makedirs(land)
    _put(land, "again.json", '[{"claim_id":"A"},{"claim_id":"B","claim_id":"B2"},{"claim_id":"C"}]')
    _put(land, "data.json", '{"data":[{"claim_id":"D"},{"x":1,"x":2}]}')
    _put(land, "single.json", '{"claim_id":"E","claim_id":"E2","medical_events":[{"type":"surgery"}]}')
    _put(land, "events.json", '{"claim_id":"F","medical_events":[{"type":"surgery","date":"d","dose":5},"text",null]}')
    with open(f"{land}/latin.json", "wb") as f:
        f.write('[{"claim_id":"é"}]'.encode("latin-1"))
    _put(land, "good.json", '[{"claim_id":"G"}]')
    rows = _run_json(spark, d).collect()
    assert sorted(r.claim_id for r in rows if r.claim_id) == ["A", "B2", "C", "D", "E2", "F", "G"]
    by_id = {r.claim_id: r for r in rows}
    assert json.loads(by_id["B2"]._rescued_data) == {"_record": '{"claim_id":"B","claim_id":"B2"}'}
    assert by_id["E2"].medical_events[0].type == "surgery"
    assert json.loads(by_id["F"]._rescued_data) == {
        "medical_events": [{"event": 0, "rest": {"dose": 5}}, {"event": 1, "rest": {"_value": "text"}}]}
    L.record_payloads(spark, land, f"{d}/manifest", "api")
    ledger = {r.landing_path.rpartition("/")[2]: r.record_count
              for r in L.read_manifest(spark, f"{d}/manifest", "payload").collect() if r.status == "LANDED"}
    counts = {}
    for r in rows:
        name = r._source_file.rpartition("/")[2]
        counts[name] = counts.get(name, 0) + 1
    assert ledger == {k: v for k, v in counts.items() if k != "latin.json"} and counts["latin.json"] == 1


def test_file_above_the_row_limit(spark, monkeypatch):
    from casegrade.operators import ledger as L
    from casegrade.streaming import medical_json as M
    d = scratch_dir(spark, "t-big")
    os.makedirs(f"{d}/landing")
    os.makedirs(f"{d}/csv")
    _put(f"{d}/landing", "big.json", '{"claim_id":"A"}\n{"claim_id":"B"}\n')
    _put(f"{d}/landing", "indented.json", '{\n "claim_id":"Z"\n}\n' + " " * 10)
    _put(f"{d}/landing", "s.json", '{"claim_id":"C"}')
    _put(f"{d}/csv", "c.csv", "claim_id,body_part\nA,knee and more\n")
    monkeypatch.setattr(M, "WHOLE_FILE_BYTES", 20)
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", "10")
    try:
        rows = _run_json(spark, d).collect()
        ingest_claims_csv(spark, f"{d}/csv", f"{d}/cb", f"{d}/cc").awaitTermination()
        assert L.record_payloads(spark, f"{d}/landing", f"{d}/pm", "api") == {"landed": 3, "failed": 0}
        assert L.record_files(spark, f"{d}/csv", f"{d}/fm", "sftp") == {"landed": 1, "failed": 0}
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")
    assert sorted(r.claim_id for r in rows) == ["A", "B", "C", "Z"]
    assert read_bronze_claims(spark, f"{d}/cb").count() == 1


def test_size_of_a_json_file_does_not_change_its_rows(spark, monkeypatch):
    from casegrade.operators import ledger as L
    from casegrade.streaming import large_json as J
    from casegrade.streaming import medical_json as M
    from casegrade.schemas import RAW_MEDICAL
    a, b = '{"claim_id":"A","medical_events":[{"type":"x,]}","date":"\\\\"}],"n":{"k":[1,2]}}', '{"claim_id":"B\\"[{","x":null}'
    texts = [f"[\n {a},\n {b}\n]\n", f'{{"data": [{a},\n{b}], "next": [1, {{"a": 2}}]}}', f'{{"results":[{b}],"data":null}}',
             f'{{"results":[{b}], "data":[{a}] }}', '{"data":[]}', "[]", "[ ]", "{}", f"{a}\n{b}\n", f"\ufeff[{a}]",
             '{\n "claim_id": "Z"\n}\n', f"[{a}, 3, null, \"s\", [1], {{\"claim_id\":1,\"claim_id\":2}}]", f'{{"data":{{"a":[{a}]}}}}',
             "['x', {'claim_id': 'q,]'}]", f'{{"data":[{a}],"data":[{b},{b}]}}']
    bad = [f"[{a},\n{b}", f"[{a},]", f"[{a}}}", f'{{"data":[{a}],}}', f'{{"data":[{a}] [1]}}', f"[{a} {b}]", "[,]", f'{{"x",:[{a}]}}',
           f"[{a}, x]", f'{{"data":[{a}], "m": y}}', f'{{"data" "z":[{a}]}}', f"{a}\nbroken\n", f"{a}\n{a[:-1]}\n", "word"]
    d = scratch_dir(spark, "t-sizes")
    os.makedirs(f"{d}/landing")
    for i, text in enumerate(texts + bad):
        _put(f"{d}/landing", f"p{i:02}.json", text)
    files = {f"file:{d}/landing/p{i:02}.json": len(t.encode()) for i, t in enumerate(texts + bad)}

    def loaded():
        rows = M.load_payload_files(spark, files).select(*[c for c in RAW_MEDICAL.fieldNames() if c != "_ingested_at"]).collect()
        ledger = L.payload_file_rows(spark, files, "api").collect()
        failed = {r._source_file for r in rows if '_corrupt_record' in (r._rescued_data or "")}
        return (sorted(map(str, (r for r in rows if r._source_file not in failed))), failed,
                sorted((str(r.landing_path), r.payload_hash, r.record_count, r.status, r.error_message) for r in ledger))
    small = loaded()
    assert {p[-8:-5] for p in small[1]} == {f"p{i:02}" for i in range(len(texts), len(texts + bad))}
    monkeypatch.setattr(M, "WHOLE_FILE_BYTES", 0)
    large = loaded()
    assert large[0] == small[0] and large[1] == small[1] and large[2] == small[2]
    # where ranges, pieces and runs end does not matter
    for text, path in zip(texts + bad, files):
        found = {_cut_here(monkeypatch, J, path, *sizes) for sizes in ((1, 1, 1), (2, 9, 3), (5, 1, 2), (7, 40, 64), (1000, 1000, 1000))}
        assert len(found) == 1, (text, found)


def _cut_here(monkeypatch, J, path, split, run, piece):
    """The steps of ``cut_files`` on one file in this process: what it is, and its records' text."""
    import pandas as pd
    monkeypatch.setattr(J, "RUN_BYTES", run)
    monkeypatch.setattr(J, "PIECE_BYTES", piece)
    size = os.path.getsize(path.removeprefix("file:"))
    names = [part.split()[0] for part in J._TRANSITIONS.split(", ")]
    ranges = [{"path": path, "size": size, "start": at, "stop": min(size, at + split)} for at in range(0, size, split)]
    entered = J._compose(pd.DataFrame([next(J._transition(r)) for r in ranges], columns=names)).to_dict("records")
    near = [r for r in entered if r["lowest"] <= (r["top"] == "{")]
    marks = [part.split()[0] for part in J._MARKS.split(", ")]
    out = J._outcome(pd.DataFrame([next(J._mark(r)) for r in near], columns=marks)).iloc[0]
    if out.kind != J.LIST:
        return out.kind, 0, b""
    opened, closed = int(out.open), int(out.close)
    runs = [x for r in entered if r["start"] < closed and r["stop"] > opened
            for x in J._run(r | {"open": opened, "close": closed, "level": 1 + (r["top"] == "{")})]
    bare = next(J._bare({"path": path, "open": opened, "close": closed, "size": size}))[2]
    return out.kind, sum(n for _, n, _ in runs), b",".join(text for _, _, text in runs), bare


def test_a_large_document_is_read_by_many_tasks(spark, monkeypatch):
    from casegrade.operators import ledger as L
    from casegrade.streaming import large_json as J
    from casegrade.streaming import medical_json as M
    d = scratch_dir(spark, "t-split")
    os.makedirs(f"{d}/landing")
    records = [{"claim_id": f"C{i}", "medical_events": [{"type": "it's \\\"[{", "date": None}] * (i % 4), "n": {"k": [i]}} for i in range(400)]
    _put(f"{d}/landing", "list.json", json.dumps(records, indent=2))
    _put(f"{d}/landing", "data.json", json.dumps({"page": {"data": [1]}, "results": [3], "data": records, "next": None}, indent=1))
    _put(f"{d}/landing", "lines.json", "\n".join(map(json.dumps, records)))
    _put(f"{d}/landing", "cut.json", json.dumps(records)[:-9])
    files = {f"file:{d}/landing/{n}.json": os.path.getsize(f"{d}/landing/{n}.json") for n in ("list", "data", "lines", "cut")}
    ranges = J.transitions(spark, files, 1000)
    assert ranges.count() == J.n_ranges(files, 1000) > 150
    assert ranges.rdd.getNumPartitions() == J.n_ranges(files, 1000)
    split = M.load_payload_files(spark, files, whole_bytes=0, split_bytes=1000).collect()
    whole = M.load_payload_files(spark, files).collect()

    def claims(rows):
        return sorted((r._source_file, r.claim_id, str(r.medical_events), r._rescued_data) for r in rows if r.claim_id)
    assert claims(split) == claims(whole) and len(claims(whole)) == 1200
    monkeypatch.setattr(M, "WHOLE_FILE_BYTES", 0)
    monkeypatch.setattr(J, "SPLIT_BYTES", 3000)
    ledger = {r.landing_path.rpartition("/")[2]: r.record_count for r in L.payload_file_rows(spark, files, "api").collect() if r.landing_path}
    assert ledger == {"list.json": 400, "data.json": 400, "lines.json": 400}


def test_json_list_elements_keep_their_json_type(spark):
    from casegrade.streaming.medical_json import parse_payloads
    df = spark.createDataFrame([('[{"claim_id": "A"}, "x", 3, "{\\"claim_id\\": \\"B\\"} junk", null]', "f")],
                               "value string, _source_file string")
    rows = parse_payloads(df).collect()
    assert [r.claim_id for r in rows] == ["A", None, None, None, None]
    assert [r._rescued_data for r in rows[1:4]] == ['{"_value":"x"}', '{"_value":3}',
                                                      '{"_value":"{\\"claim_id\\": \\"B\\"} junk"}']


def test_byte_order_marks_are_ignored(spark):
    d = scratch_dir(spark, "t-bom")
    land = f"{d}/landing"
    os.makedirs(land)
    with open(f"{land}/a.csv", "w", encoding="utf-8-sig") as f:
        f.write("claim_id,body_part\nC1,knee\n")
    ingest_claims_csv(spark, land, f"{d}/bronze", f"{d}/ckpt").awaitTermination()
    rows = read_bronze_claims(spark, f"{d}/bronze").collect()
    assert [(r.claim_id, r.body_part, r._rescued_data) for r in rows] == [("C1", "knee", None)]
    jland = f"{d}/json"
    os.makedirs(jland)
    with open(f"{jland}/a.json", "w", encoding="utf-8-sig") as f:
        f.write(json.dumps([{"claim_id": "J1"}]))
    ingest_medical_json(spark, jland, f"{d}/jbronze", f"{d}/jckpt").awaitTermination()
    assert [r.claim_id for r in read_bronze_medical(spark, f"{d}/jbronze").collect()] == ["J1"]


def test_json_lines_layout_reads_line_by_line(spark):
    d = scratch_dir(spark, "t-jsonl")
    land = f"{d}/landing"
    os.makedirs(land)
    lines = [json.dumps({"claim_id": f"C{i}", "medical_events": [{"type": "surgery", "date": None}]}) for i in range(500)]
    _put(land, "feed.jsonl", "\n".join(lines[:250]) + "\n\n" + "\n".join(lines[250:]) + "\n{broken\n")
    ingest_medical_json(spark, land, f"{d}/bronze", f"{d}/ckpt", layout="lines").awaitTermination()
    rows = read_bronze_medical(spark, f"{d}/bronze").collect()
    assert sorted(r.claim_id for r in rows if r.claim_id) == sorted(f"C{i}" for i in range(500))
    bad = [r for r in rows if r.claim_id is None]
    assert len(bad) == 1 and json.loads(bad[0]._rescued_data) == {"_corrupt_record": "{broken"}


def test_csv_file_names_with_glob_characters(spark):
    d = scratch_dir(spark, "t-glob")
    land = f"{d}/landing"
    os.makedirs(land)
    _put(land, "claims[1].csv", "claim_id\nG1\n")
    _put(land, "claims{a,b}.csv", "claim_id\nG2\n")
    ingest_claims_csv(spark, land, f"{d}/bronze", f"{d}/ckpt").awaitTermination()
    rows = read_bronze_claims(spark, f"{d}/bronze").collect()
    assert sorted(r.claim_id for r in rows) == ["G1", "G2"]
    assert all(r._source_file.endswith(".csv") for r in rows)


def test_json_and_csv_glob_file_names_each_once(spark):
    d = scratch_dir(spark, "t-glob-json")
    land = f"{d}/landing"
    os.makedirs(land)
    _put(land, "p[1].json", '[{"claim_id": "A"}]')
    _put(land, "p{a,b}.json", '[{"claim_id": "B"}]')
    _put(land, "plain.json", '[{"claim_id": "C"}]')
    assert sorted(r.claim_id for r in _run_json(spark, d).collect()) == ["A", "B", "C"]


def test_width_of_a_csv_file_does_not_change_its_rows(spark, monkeypatch):
    from casegrade.streaming import claims_csv as C
    d = scratch_dir(spark, "t-wide")

    def text(extra):
        names = ["policy", "claim_id", "note", "body_part", "blank", "claim_id", *[f"e{i}" for i in range(extra)]]
        rows = [[f"p{i}", f"C{i}", '"a, b"', '"say \\"hi\\""', "", "x", *map(str, range(extra))] for i in range(4)]
        rows[2], rows[3] = rows[2][:3], [*rows[3], "more"]
        return "\n".join(map(",".join, [names, *rows])) + '\n"open,C9,x\n"a"b,C8,\n'
    paths = []
    for name, extra in (("a", 0), ("b", 4)):
        _put(d, f"{name}.csv", text(extra))
        paths.append(f"file:{d}/{name}.csv")

    def rows():
        return sorted(map(str, C.load_claim_files(spark, paths).drop("_ingested_at").collect()))
    narrow = rows()
    for most in (5, 6, 8, 10):                       # all files wide, one of them, none
        monkeypatch.setattr(C, "MAX_COLUMNS", most)
        assert rows() == narrow
    monkeypatch.undo()
    _put(d, "c.csv", text(3000))
    got = {r.claim_id: r for r in C.load_claim_files(spark, [*paths, f"file:{d}/c.csv"]).collect() if r._source_file.endswith("c.csv")}
    assert set(got) == {"C0", "C1", "C2", "C8", None} and got["C1"].body_part == 'say "hi"'
    assert json.loads(got["C0"]._rescued_data)["e2999"] == "2999"
