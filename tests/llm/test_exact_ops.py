"""Operators whose results a few lines of Python give: brute force on the test tables and on odd rows."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from corpus_fixtures import LONG, ODD_ROWS, docs_df
from pyspark.sql import functions as F

from casegrade.llm.common import stored

SF = "/root/testdata/sf0.001"
WORDS = re.compile("[^\x20\x09-\x0D]+")
ITEM_WORDS = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    from casegrade.session import ship_package
    ship_package(spark)


def lower(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def collected(df):
    return [r.asDict() for r in df.collect()]


@pytest.fixture(scope="module")
def table(spark):
    return {t: collected(spark.read.parquet(f"{SF}/{t}.parquet")) for t in ("documents", "benchmark", "pages", "labels")}


@pytest.fixture(scope="module")
def queries():
    from casegrade.llm.queries import QUERIES
    return QUERIES


# --- decontamination

def decontaminated(docs, items, window=10):
    where = {}
    for item, text in items:
        w = ITEM_WORDS.findall(lower(text))
        for j in range(max(1, len(w) - window + 1) if w else 0):
            where.setdefault(tuple(w[j:j + window]), set()).add("null" if item is None else str(item))
    sizes, out = {len(x) for x in where}, []
    for doc, text in docs:
        w, hit, found = ITEM_WORDS.findall(lower(text)), set(), set()
        for n in sizes:
            for j in range(len(w) - n + 1):
                if tuple(w[j:j + n]) in where:
                    found |= where[tuple(w[j:j + n])]
                    hit.update(range(j, j + n))
        out.append((doc, len(w), len(hit), tuple(sorted(found)), bool(hit)))
    return sorted(out, key=repr)


def spark_decontaminated(spark, docs, items, **options):
    from casegrade.llm import decontamination as D
    got = D.decontaminate(docs, items, **options).collect()
    return sorted([(r.id, r.n_words, r.n_hit, tuple(r["items"]), r.contaminated) for r in got], key=repr)


def test_decontamination_query(spark, queries, table):
    got = queries["op1_decontamination"](spark, SF).collect()
    expected = decontaminated([(r["doc_id"], r["text"]) for r in table["documents"]],
                              [(r["item_id"], r["text"]) for r in table["benchmark"]])
    sha = [(d, n, h, len(i), hashlib.sha256(",".join(i).encode()).hexdigest(), c) for d, n, h, i, c in expected]
    assert sorted([tuple(r) for r in got]) == sorted(sha)


def test_decontamination_odd_rows(spark):
    items = [(1, LONG[:400]), (2, "w0 W906"), (2, "w0 W906"), (None, "some words here"), (3, None), (4, " - "),
             (5, "same row"), (6, "same"), (7, "a term that no text has")]
    docs = ODD_ROWS + [(20, "Same-row, same row! Same")]
    got = spark_decontaminated(spark, docs_df(spark, docs), spark.createDataFrame(items, "item_id long, text string"))
    assert got == decontaminated(docs, items)


def test_decontamination_without_broadcast(spark, monkeypatch):
    from casegrade.llm import decontamination as D
    monkeypatch.setattr(D, "BROADCAST_ROWS", 0)
    items = [(1, LONG[:400]), (5, "same row")]
    got = spark_decontaminated(spark, docs_df(spark, ODD_ROWS), spark.createDataFrame(items, "item_id long, text string"))
    assert got == decontaminated(ODD_ROWS, items)


def test_decontamination_empty_tables(spark):
    items = spark.createDataFrame([], "item_id long, text string")
    assert spark_decontaminated(spark, docs_df(spark, []), items) == []
    got = spark_decontaminated(spark, docs_df(spark, ODD_ROWS), items)
    assert got == decontaminated(ODD_ROWS, [])


def test_proximity_matches(spark):
    from casegrade.llm import decontamination as D
    docs = docs_df(spark, [(1, "alpha beta gamma"), (2, "alpha x beta y gamma"), (3, "alpha x x x x x x gamma beta")])
    items = spark.createDataFrame([(1, "alpha beta gamma")], "item_id long, text string")
    got = {r.id: (r["items"], r.near_items) for r in D.decontaminate(docs, items, slack=2).collect()}
    assert got[1] == (["1"], ["1"]) and got[2] == ([], ["1"]) and got[3][0] == []


def test_proximity_takes_every_term_of_a_window(spark):
    """Every word within the slack of its place, from some start."""
    from casegrade.llm import decontamination as D
    rng = np.random.default_rng(2)
    words = [f"t{i}" for i in range(12)]
    docs = [(i, " ".join(rng.choice(words, 30))) for i in range(60)]
    items = [(i, " ".join(rng.choice(words, n))) for i, n in enumerate((1, 2, 3, 4, 5, 5, 6, 3))]

    def near(text, phrase, slack):
        w, p = text.split(), phrase.split()
        return any(all(p[j] in w[max(0, s + j - slack):max(0, s + j + slack + 1)] for j in range(len(p)))
                   for s in range(-slack, len(w) + slack))
    for slack in (1, 2):
        got = D.decontaminate(docs_df(spark, docs), spark.createDataFrame(items, "item_id long, text string"), window=5, slack=slack)
        found = {r.id: set(r.near_items) for r in got.collect()}
        want = {d: {str(i) for i, phrase in items for at in range(max(1, len(phrase.split()) - 4))
                    if near(t, " ".join(phrase.split()[at:at + 5]), slack)} for d, t in docs}
        assert found == want and any(want.values())


def test_many_equal_rows_stay_linear(spark):
    """A row that repeats 20,000 times meets the windows, and its own repeats, once."""
    from casegrade.llm import decontamination as D
    from casegrade.llm import substring as S
    passage = " ".join(f"p{i}" for i in range(40))
    n = 20_000
    docs = spark.range(n).select(F.lit(7).cast("long").alias("doc_id"), F.lit(f"start {passage} end").alias("text")).unionByName(
        spark.createDataFrame([(3, passage), (9, "other words")], "doc_id long, text string"))
    items = spark.createDataFrame([(1, passage)], "item_id long, text string")
    cut = stored(D.windows(items), "test-windows")
    index = D.postings(docs, cut.select(F.explode("terms").alias("term")))
    met = D.intersect(index, D.ranked_terms(index, cut))
    assert met.count() == 2 * 31                             # 31 windows in two different documents
    found = {(r.doc_id, r.n): r.c for r in D.decontaminate(docs, items).groupBy(F.col("id").alias("doc_id"), F.col("n_hit").alias("n"))
             .agg(F.count(F.lit(1)).alias("c")).collect()}
    assert found == {(7, 40): n, (3, 40): 1, (9, 0): 1}
    starts = S.repeats(docs).collect()
    assert [r.d for r in starts] == [7] and len(starts[0].starts) == 4 * 28      # 28 windows, four bytes each
    kept = S.remove_repeats(docs, keep=["doc_id"]).groupBy("doc_id", "n_removed").count().collect()
    assert {(r.doc_id, r.n_removed, r["count"]) for r in kept} == {(7, 40, n), (3, 0, 1), (9, 0, 1)}


# --- substring dedup

def cut(docs, window=13):
    """docs: (id, text); null ids come last and do not remove each other."""
    order = {i: (i is None, i or 0) for i, _ in docs}
    least, out = {}, []
    for i, text in docs:
        w = WORDS.findall(text or "")
        for j in range(len(w) - window + 1):
            key = tuple(w[j:j + window])
            least[key] = min(least.get(key, order[i]), order[i])
    for i, text in docs:
        w = WORDS.findall(text or "")
        gone = set()
        for j in range(len(w) - window + 1):
            if least[tuple(w[j:j + window])] < order[i]:
                gone.update(range(j, j + window))
        out.append((i, len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
    return sorted(out, key=repr)


def spark_cut(docs, **options):
    from casegrade.llm import substring as S
    got = S.remove_repeats(docs, keep=["doc_id"], **options).collect()
    for r in got:
        spans = [(x.begin, x.end) for x in r.removed]
        assert sum(e - b for b, e in spans) == r.n_removed
        assert all(e < b for (_, e), (b, _) in zip(spans, spans[1:]))          # maximal: none touch
    return sorted([(r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got], key=repr)


def test_substring_query(spark, queries, table):
    got = queries["op2_substring_dedup"](spark, SF).collect()
    expected = cut([(r["doc_id"], r["text"]) for r in table["documents"]])
    assert sorted(map(tuple, got)) == sorted((i, n, g, hashlib.sha256(k.encode()).hexdigest()) for i, n, g, k in expected)


def test_substring_odd_rows(spark):
    rows = ODD_ROWS + [(None, LONG[:2000]), (None, LONG[:2000]), (30, "x " + LONG[500:900] + " y"), (31, "a " * 40),
                       (32, "a " * 14)]
    assert spark_cut(docs_df(spark, rows)) == cut(rows)
    assert spark_cut(docs_df(spark, rows), window=2) == cut(rows, 2)
    assert spark_cut(docs_df(spark, [])) == []


def test_substring_small_blocks_and_cache(spark, monkeypatch):
    from casegrade.llm import substring as S
    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 3, 60)) for _ in range(40)]
    ids, keys = np.arange(40), np.arange(40) % 7
    hashes = S._WordHashes()
    monkeypatch.setattr(S, "_CACHE_WORDS", 2)
    words = [np.fromiter(map(hashes.__getitem__, t.encode().split()), np.uint64) for t in texts]
    rows = list(S._block_rows(ids, keys, words, 5, 4)) + list(S._block_rows(ids + 100, keys, words, 5, 4))
    once = [b for part in range(5) for b in S._range_task(5)(S._batches(iter([r for r in rows if r[0] == part])))]
    out = [x for part in range(5)
           for x in S._gather_task([b.filter(np_part(b, part)) for b in once])]
    got = {int(d): set(np.cumsum(S._unplanes(s, "uint32")).tolist())
           for b in out for d, s in zip(b.column(0).to_pylist(), b.column(2).to_pylist())}
    seen, expected = {}, {}
    for i, t in [*enumerate(texts), *((i + 100, t) for i, t in enumerate(texts))]:
        w = t.split()
        for j in range(len(w) - 3):
            if seen.setdefault(tuple(w[j:j + 4]), i) < i:
                expected.setdefault(i, set()).add(j)
    assert got == expected


def np_part(batch, part):
    import pyarrow.compute as pc
    return pc.equal(batch.column(0), part)


# --- quality measures

def test_quality_measures(spark, queries, table):
    def measure(text):
        text = text or ""
        w = WORDS.findall(text)
        lines = [x for x in text.split("\n") if WORDS.search(x)]
        grams = [tuple(w[j:j + 8]) for j in range(len(w) - 7)]
        n, inside = Counter(grams), set()
        for j, g in enumerate(grams):
            if n[g] > 1:
                inside.update(range(j, j + 8))
        return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside),
                len(w) < 20 or 100 * len(inside) > 30 * len(w))
    from casegrade.llm import quality_rules as Q
    rows = ODD_ROWS + [(40, "a b c d e f g h a b c d e f g h x"), (41, "x\ny\nx\n \nx\n"), (42, "l " * 30)]
    no_labels = spark.createDataFrame([], "doc_id long, quality int")
    got = Q.judge(docs_df(spark, rows), no_labels).collect()
    assert all(r.kept == (not r.base_failed) for r in got)
    assert sorted([tuple(r)[:7] for r in got], key=repr) == sorted([(i, *measure(t)) for i, t in rows], key=repr)
    assert Q.judge(docs_df(spark, []), no_labels).collect() == []
    got = {r.doc_id: tuple(r)[1:7] for r in queries["op3_quality_rules"](spark, SF).collect()}
    assert got == {r["doc_id"]: measure(r["text"]) for r in table["documents"]}


def test_binomial_tail_is_exact_and_never_too_small(spark):
    from casegrade.llm import quality_rules as Q
    cases = [(n, k, rate) for n in (0, 1, 10, 300, 5000) for k in (0, 1, 5, 40, 120) for rate in (0.01, 0.05) if k <= n]
    for rate in (0.01, 0.05):
        own = [c for c in cases if c[2] == rate]
        df = spark.createDataFrame([(n, k) for n, k, _ in own], "n long, k long")
        from pyspark.sql import functions as F
        for terms in (5000, 3):
            got = df.select("n", "k", Q.binomial_tail(F.col("n"), F.col("k"), rate, terms).alias("p")).collect()
            for r in got:
                exact = sum(math.exp(math.lgamma(r.n + 1) - math.lgamma(i + 1) - math.lgamma(r.n - i + 1)
                                     + i * math.log(rate) + (r.n - i) * math.log1p(-rate)) for i in range(r.k + 1))
                if r.k >= r.n * rate:
                    assert r.p == 1.0
                elif terms == 5000:
                    assert r.p == pytest.approx(exact, rel=1e-8)
                else:
                    assert r.p >= exact * (1 - 1e-8)


def test_thresholds_reject_junk_and_keep_the_promise(spark):
    from casegrade.llm import quality_rules as Q
    rng = np.random.default_rng(3)

    def good(i):
        return " ".join(f"wd{x}" for x in rng.integers(0, 10_000, 30)) + (" ### ###" if i % 500 == 0 else "")
    rows = [(i, good(i), "en") for i in range(3000)] + [(9000 + i, "&&&&& %%%%% " * 2 + good(1), "en") for i in range(50)]
    rows += [(9900, "&&&&& %%%%% " * 2 + good(1), "xx"), (9901, "&&&&& %%%%% " * 2 + good(1), None)]
    labels = spark.createDataFrame([(i, 1) for i in range(3000)] + [(9000 + i, 0) for i in range(50)] + [(None, 1)],
                                   "doc_id long, quality int")
    got = {r.id: r for r in Q.judge(docs_df(spark, rows), labels).collect()}
    rejected = sum(not got[i].kept for i in range(3000))
    assert rejected <= Q.MAX_FALSE_REJECTION * 3000
    assert not any(got[9000 + i].kept for i in range(50))
    assert got[9900].kept and got[9901].kept                # strata without labels certify nothing


# --- WARC

def test_warc_query(spark, queries, table):
    got = {r.page_id: r for r in queries["op4_warc_dictionary"](spark, SF).collect()}
    check_pages([(r["page_id"], r["html"]) for r in table["pages"]], got)


def check_pages(pages, got):
    import base64
    first = {}
    for page, html in sorted(pages):
        first.setdefault((html or "").encode(), page)
    assert set(got) == {p for p, _ in pages}
    for page, html in pages:
        data, r = (html or "").encode(), got[page]
        assert (r.payload_bytes, r.payload_digest) == (
            len(data), base64.b32encode(hashlib.sha1(data).digest()).decode())
        assert (r.record_type, r.refers_to) == (
            ("response", None) if first[data] == page else ("revisit", first[data]))


def test_warc_odd_pages(spark, tmp_path):
    from casegrade.llm import warc as W
    pages = [(5, "http://a/\r\nX: y", "same"), (3, None, "same"), (9, "http://b", "same"), (1, "u", None), (2, "u", ""),
             (4, "ü", "\r\n\r\nWARC/1.1\r\n"), (6, "u", "é" * 100_000)] + [(100 + i, "u", "copy") for i in range(300)]
    df = spark.createDataFrame([(*p, "x", "x", "x") for p in pages],
                               "page_id long, url string, html string, id string, sha string, first string")
    manifest = W.write(df, f"file://{tmp_path}")
    got = W.read(manifest).collect()
    assert len(got) == len(pages) == sum(r.records for r in manifest.collect())
    check_pages([(p, h) for p, _, h in pages], {r.page_id: r for r in got})
    (tmp_path / "b").mkdir()
    small = W.read(W.write(df, str(tmp_path / "b"), min_bytes=5)).collect()
    assert {r.record_type for r in small} == {"response"} and len(small) == len(pages)
    nulls = spark.createDataFrame([(None, "u", "x"), (7, "u", "x"), (7, "u", "x")], "page_id long, url string, html string")
    (tmp_path / "c").mkdir()
    got = sorted([(r.page_id, r.record_type, r.refers_to) for r in W.read(W.write(nulls, str(tmp_path / "c"))).collect()],
                 key=repr)
    assert got == [(7, "response", None), (7, "response", None), (None, "revisit", 7)]
    assert W.read(W.write(nulls.limit(0), str(tmp_path / "c"))).collect() == []


def test_warc_dictionary_sample_covers_the_table_and_is_bounded(spark, tmp_path, monkeypatch):
    from casegrade.llm import warc as W
    rows = [(0, "http://big", "A" * 9_000_000)] + [(i, f"http://h/{i}", f"page {i} " * 50) for i in range(1, 400)]
    df = spark.createDataFrame(rows, "id long, url string, payload string").withColumn("payload", F.col("payload").cast("binary"))
    monkeypatch.setattr(W, "SAMPLE_RECORDS", 60)
    sample = W.sample_records(df.coalesce(1), "2020-01-01T00:00:00Z")
    assert 30 < len(sample) <= 120 and max(map(len, sample)) < W.SAMPLE_BYTES + 1000
    ids = sorted(int(s.split(b"Page-ID: ")[1].split(b"\r\n")[0]) for s in sample)
    assert ids[-1] > 300 and sum(i < 200 for i in ids) > 10          # not the first ones
    hot = spark.range(3000).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.when(F.col("id") % 3 > 0, F.concat(
        F.lit("own "), "id")).otherwise(F.lit("error page")).alias("html"))
    from casegrade.operators.skew import SkewGuard
    got = W.read(W.write(hot, str(tmp_path), guard=SkewGuard(sample_fraction=1.0, factor=0.5))).collect()
    assert len(got) == 3000 and sum(r.record_type == "response" for r in got) == 2001
    assert {r.refers_to for r in got if r.record_type == "revisit"} == {0}


def test_warc_archive_round_trip_and_rotation():
    import io
    from casegrade.llm import warc as W
    records = [W.page_record(i, f"http://h/{i}", (f"<p>{i}</p>" * 50).encode(), None, False, "2020-01-01T00:00:00Z")
               for i in range(500)]
    left, ids, known = iter(records), [], W.as_dictionary(W.train(records).as_bytes())
    while True:
        out = io.BytesIO()
        size, n = W.write_archive(out, left, known, limit=3000)
        if not n:
            break
        assert size == len(out.getvalue()) and out.getvalue()[:4] == bytes([0x5D, 0x2A, 0x4D, 0x18])
        out.seek(0)
        ids += [int(f["Page-ID"]) for f, _ in W.read_archive(out)]
    assert ids == list(range(500))
    with pytest.raises(ValueError):
        list(W.read_archive(io.BytesIO(b"12345678")))


# --- token counts

def test_token_counts(spark, queries, table):
    from casegrade.llm import token_counts as T
    scores = T.piece_scores(None)
    unknown, known = min(scores.values()) - T.UNKNOWN_PENALTY, {}

    def count(word):
        if word not in known:
            best = [(0.0, 0)]
            for e in range(1, len(word) + 1):
                ways = [(best[s][0] + scores[word[s:e]], best[s][1] + 1) for s in range(e) if word[s:e] in scores]
                if word[e - 1] not in scores:
                    ways.append((best[e - 1][0] + unknown, best[e - 1][1] + len(word[e - 1].encode())))
                top = max(w[0] for w in ways)
                best.append(next(w for w in ways if w[0] == top))
            known[word] = best[-1][1]
        return known[word]

    def expected(rows):
        return sorted([(i, len(WORDS.findall(t or "")), sum(count("▁" + w) for w in WORDS.findall(t or "")))
                       for i, t in rows], key=repr)
    got = queries["op6_token_counts"](spark, SF).collect()
    assert sorted(map(tuple, got), key=repr) == expected([(r["doc_id"], r["text"]) for r in table["documents"]])
    for nodes in (T.MAX_NODES, 50):
        got = T.count_tokens(docs_df(spark, ODD_ROWS), max_nodes=nodes).collect()
        assert sorted(map(tuple, got), key=repr) == expected(ODD_ROWS)
    assert T.count_tokens(docs_df(spark, [])).collect() == []


# --- SimHash

def fingerprint(text):
    w = WORDS.findall(lower(text))
    grams = [" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def grouped(rows, fps):
    """(id, fingerprint, smallest id of the component), nulls last."""
    distinct = sorted(set(fps))
    root = {f: f for f in distinct}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f
    for i, a in enumerate(distinct):
        for b in distinct[i + 1:]:
            if bin(a ^ b).count("1") <= 2:
                a_, b_ = find(a), find(b)
                root[max(a_, b_)] = min(a_, b_)
    least = {}
    for (i, _), f in zip(rows, fps):
        if i is not None:
            least[find(f)] = min(i, least.get(find(f), i))
    return sorted([(i, f"{f:016x}", least.get(find(f))) for (i, _), f in zip(rows, fps)], key=repr)


def test_simhash_query(spark, queries, table):
    rows = [(r["doc_id"], r["text"]) for r in table["documents"]]
    got = queries["op7_simhash_near_dedup"](spark, SF).collect()
    assert sorted(map(tuple, got), key=repr) == grouped(rows, [fingerprint(t) for _, t in rows])


def test_simhash_odd_rows(spark):
    from casegrade.llm import simhash as H
    df = H.near_duplicates(docs_df(spark, ODD_ROWS))
    got = sorted([(r.id, f"{r.fp & (1 << 64) - 1:016x}", r.component) for r in df.collect()], key=repr)
    assert got == grouped(ODD_ROWS, [fingerprint(t) for _, t in ODD_ROWS])
    assert H.near_duplicates(docs_df(spark, [])).collect() == []


@pytest.mark.parametrize("hot", [64, 2, 0])
def test_links_reach_everything_within_two_bits(spark, hot):
    """Clusters around a few centres: many fingerprints share segments."""
    from casegrade.llm import simhash as H
    from casegrade.llm.components import components
    rng = np.random.default_rng(11)
    fps = {0, (1 << 64) - 1, 1 << 63}
    for centre in rng.integers(0, 1 << 63, 4).tolist():
        for _ in range(60):
            f = centre
            for b in rng.integers(0, 64, rng.integers(0, 5)).tolist():
                f ^= 1 << b
            fps.add(f)
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    got = {r.node: r.component for r in components(H.links(df, hot), 50).collect()}
    root = {f: f for f in signed}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f
    for i, a in enumerate(fps):
        for j in range(i + 1, len(fps)):
            if bin(a ^ fps[j]).count("1") <= 2:
                x, y = find(signed[i]), find(signed[j])
                root[max(x, y)] = min(x, y)
    assert {f: got.get(f, f) for f in signed} == {f: find(f) for f in signed}


def test_first_of_each_keeps_one(spark):
    from casegrade.llm import simhash as H
    rows = [(5, "a b c d"), (3, "A b c D"), (3, "A b c D"), (None, "a b c d"), (7, "quite other words here"),
            (None, "x y z"), (None, "x y z")]
    got = H.first_of_each(docs_df(spark, rows))
    assert got.columns == docs_df(spark, []).columns
    assert sorted([(r.doc_id, r.text) for r in got.collect()], key=repr) == sorted(
        [(3, "A b c D"), (7, "quite other words here"), (None, "x y z")], key=repr)


# --- sharding

def jump(key, n):
    """One key, one step at a time."""
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * ((1 << 31) / ((key >> 33) + 1)))
    return b


def test_jump_hash_matches_and_moves_only_into_the_new_shard():
    from casegrade.llm import sharding as J
    keys = np.random.default_rng(1).integers(0, 1 << 63, 2000).astype(np.uint64)
    for n in (1, 2, 40, 41, 1000):
        assert J.jump_hash(keys, n).tolist() == [jump(int(k), n) for k in keys]
    a, b = J.jump_hash(keys, 40), J.jump_hash(keys, 41)
    assert set(b[a != b]) == {40} and 0.01 < (a != b).mean() < 0.05
    with pytest.raises(ValueError):
        J.jump_hash(keys, 0)


def test_sharding_query(spark, queries, table):
    got = queries["op9_jump_sharding"](spark, SF).collect()
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in table["documents"]}
    assert {r.doc_id for r in got} == set(texts) and len(got) == len(texts)
    slots = {}
    for r in got:
        assert (r["size"], r.text_crc32, r.law) == (len(texts[r.doc_id]) + 16, zlib.crc32(texts[r.doc_id]), "key")
        assert 0 <= r.shard < 40 and r.grown_shard in (r.shard, 40)
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_sharding_odd_rows(spark):
    from casegrade.llm import sharding as J
    rows = J.shard_rows(docs_df(spark, ODD_ROWS * 20), "doc_id", 3).collect()
    assert len(rows) == 20 * len(ODD_ROWS)
    for shard in {r.shard for r in rows}:
        slots = sorted(r.slot for r in rows if r.shard == shard)
        assert slots == list(range(len(slots)))
    assert len({r.shard for r in rows if r.doc_id is None}) == 1
    assert J.shard_rows(docs_df(spark, []), "doc_id", 3).collect() == []
    with pytest.raises(ValueError):
        J.shard_rows(docs_df(spark, []).withColumnRenamed("u", "shard"), "doc_id", 3)


def test_substring_ranges_add_bits_to_the_hash(monkeypatch):
    """Windows whose first hashes collide differ by the hash that deals them out."""
    from casegrade.llm import substring as S
    rng = np.random.default_rng(4)
    texts = [rng.integers(0, 2 ** 63, 60).astype(np.uint64) for _ in range(2)]
    h, plain = S.window_hashes(texts[0], 13), S.window_hashes
    rows = list(S._block_rows(np.array([1, 2]), np.array([0, 0]), texts, 64, 13))
    parts = np.concatenate([np.repeat(r[0], len(r[5]) // 8) for r in rows])
    hashes = np.concatenate([np.frombuffer(r[5], np.uint64) for r in rows])
    assert len(hashes) == 2 * len(h) and np.mean(parts == hashes >> np.uint64(58)) < 0.2
    monkeypatch.setattr(S, "window_hashes", lambda w, n: plain(w, n) if w[0] not in (texts[0][0], texts[1][0]) else h)
    rows = list(S._block_rows(np.array([1, 2]), np.array([0, 0]), texts, 64, 13))
    assert all(r[5] is not None for r in rows)               # no known repeats: these are other words
