"""Trained operators by held-out accuracy, packing by round trip, the pipeline by its promises."""

import math
import random
import zlib

import numpy as np
import pytest
from corpus_fixtures import LONG, ODD_ROWS, docs_df
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    from casegrade.session import ship_package
    ship_package(spark)


@pytest.fixture(scope="module")
def queries():
    from casegrade.llm.queries import QUERIES
    return QUERIES


@pytest.fixture(scope="module")
def documents(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


# --- language ID

def test_language_query(spark, queries, documents):
    got = queries["op5_language_id"](spark, SF).collect()
    assert sorted(r.doc_id for r in got) == sorted(documents)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert len(held) > 100
    assert np.mean([r.lang_pred == documents[r.doc_id].lang for r in held]) > 0.97


def test_language_scores_equal_the_plain_sums():
    """Brute force: n-grams one by one in Python."""
    from casegrade.llm import langid as L
    rng = np.random.default_rng(2)
    matrix = np.log(rng.random((3, L.BUCKETS)) / L.BUCKETS).astype(np.float32)
    model = L.Model(["a", "b", "c"], matrix, np.log(np.array([0.2, 0.3, 0.5])))
    texts = ["Hello, wörld 12!", "", None, " \n", "x", "ÄÖ" * 50, "a b", "İ dotted \U0001F600 中文", "same", "same"]

    def bucket(gram):
        h = len(gram)
        for ch, mix in zip(gram, L._MIX):
            h = (h + ord(ch) * int(mix)) % 2 ** 64
        h ^= h >> 29
        return h * int(L._MIX[0]) % 2 ** 64 >> 64 - L.BUCKET_BITS
    names, scores = L.predict_texts(model, texts)
    for text, name, score in zip(texts, names, scores):
        letters = "".join(c.lower()[0] if c.isalpha() else " " for c in text or "")
        if not letters.strip():
            assert (name, score) == ("und", 0.0)
            continue
        clean = f" {' '.join(letters.split())} "
        grams = [clean[i:i + n] for n in (1, 2, 3) for i in range(len(clean) - n + 1) if clean[i:i + n] != " "]
        total = np.array([sum(float(matrix[k, bucket(g)]) for g in grams) for k in range(3)]) + model.priors
        assert name == "abc"[total.argmax()]
        assert score == pytest.approx(1 / np.exp(total - total.max()).sum(), abs=1e-6)


def test_language_odd_rows_and_segments(spark, monkeypatch):
    from casegrade.llm import langid as L
    docs = docs_df(spark, ODD_ROWS)
    model = L.train(docs.withColumn("lang", F.when(F.col("doc_id") > 5, "en").when(F.col("doc_id").isNotNull(), "de")))
    assert model.languages == ["de", "en"]
    got = L.predict(docs, model, keep=[c for c in docs.columns if c != "score"]).collect()
    assert len(got) == len(ODD_ROWS)
    for r in got:
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in r.text or ""))
    with pytest.raises(ValueError):
        L.predict(docs, model, keep=["score"])
    empty = L.train(docs.filter("false"))
    assert empty.languages == [] and {r.lang_pred for r in L.predict(docs, empty).collect()} == {"und"}
    assert L.train(docs.withColumn("lang", F.lit(None).cast("string"))).languages == []
    assert L.predict(docs.filter("false"), model).collect() == []
    texts = [LONG, "", None, " a\n", "Ab--c  \u00fcber\t1x " * 40, "...", "  ", "x" * 99]

    def grams(of):
        count, lettered = {}, set()
        for bucket, owner, with_letter in L.ngram_buckets(of):
            lettered |= set(with_letter.tolist())
            for b, o in zip(bucket.tolist(), owner.tolist()):
                count[o, b] = count.get((o, b), 0) + 1
        return count, lettered
    whole, scores = grams(texts), L.predict_texts(model, texts)
    for segment in (1000, 64, 7, 1):                 # the n-grams of the whole text, wherever it is cut
        monkeypatch.setattr(L, "SEGMENT", segment)
        assert grams(texts) == whole
        cut = L.predict_texts(model, texts)
        assert cut[0] == scores[0] and np.allclose(cut[1], scores[1])


def test_language_counts_equal_brute_force_with_many_languages(spark, monkeypatch):
    from casegrade.llm import langid as L
    rows = [(i, t, f"l{i % 9}" if i % 4 else None) for i, (_, t) in enumerate([r[:2] for r in ODD_ROWS if r[1] != LONG] * 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(2)
    model = L.train(docs)
    langs = sorted({r[2] for r in rows if r[2]})
    counts, n = np.zeros((len(langs), L.BUCKETS)), np.zeros(len(langs))
    for _, text, lang in rows:
        if lang:
            n[langs.index(lang)] += 1
            for bucket, _, _ in L.ngram_buckets([text]):
                np.add.at(counts[langs.index(lang)], bucket, 1)
    counts += L.SMOOTHING
    assert model.languages == langs and np.allclose(model.priors, np.log(n / n.sum()))
    assert np.allclose(model.matrix, np.log(counts / counts.sum(axis=1, keepdims=True)), atol=1e-5)


# --- quality classifier

def auc(scores, labels):
    order = np.argsort(scores)
    ranks = np.empty(len(scores))
    ranks[order] = np.arange(1, len(scores) + 1)
    good = labels == 1
    return (ranks[good].sum() - good.sum() * (good.sum() + 1) / 2) / (good.sum() * (~good).sum())


def test_quality_query(spark, queries, documents):
    sf = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = queries["op8_quality_classifier"](spark, sf).collect()
    assert len(got) == 10_000
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1
               and r.predicted == int(r.score >= 0.3) for r in got)
    held = [r for r in got if r.held_out and r.doc_id in labels]
    y = np.array([labels[r.doc_id] for r in held])
    assert auc(np.array([r.score for r in held]), y) > 0.95
    assert np.mean([r.predicted for r, q in zip(held, y) if q == 1]) > 0.98


def test_gam_learns_an_interaction():
    from casegrade.llm import quality_gam as G
    rng = np.random.default_rng(4)
    x = rng.random((4000, 5))
    y = ((x[:, 0] > 0.5) ^ (x[:, 3] > 0.5)).astype(float)        # no feature says anything alone
    model = G.fit(x[:3000], y[:3000])
    assert (0, 3) in model.pairs
    assert auc(model.score(x[3000:]), y[3000:]) > 0.9
    again = G.fit(x[:3000], y[:3000])
    assert np.array_equal(model.score(x), again.score(x))


def test_gam_score_is_the_sum_of_its_tables():
    from casegrade.llm import quality_gam as G
    rng = np.random.default_rng(6)
    x, y = rng.random((500, 3)), rng.integers(0, 2, 500).astype(float)
    model = G.fit(x, y)
    for row, score in zip(x[:50], model.score(x[:50])):
        bins = [sum(v >= cut for cut in e) for v, e in zip(row, model.edges)]
        total = model.intercept + sum(t[b] for t, b in zip(model.tables, bins))
        total += sum(t[model.coarse[i][bins[i]], model.coarse[j][bins[j]]]
                     for (i, j), t in zip(model.pairs, model.pair_tables))
        assert score == pytest.approx(1 / (1 + np.exp(-total)))


def test_quality_odd_rows(spark):
    from casegrade.llm import quality_gam as G
    docs = docs_df(spark, ODD_ROWS)
    labels = spark.createDataFrame([(i, q) for i, q in ((1, 0), (2, 1), (3, 1), (8, 0), (8, 1), (None, 1), (6, None))],
                                   "doc_id long, quality int")
    model = G.train(docs, labels)
    keep = [c for c in docs.columns if c != "score"]
    got = G.score(docs, model, keep=keep).collect()
    assert len(got) == len(ODD_ROWS) and all(0 <= r.score <= 1 for r in got)
    same = {}
    for r in got:
        assert same.setdefault(r.text or "", r.score) == r.score or not (r.text or "").strip()
    nothing = G.train(docs, labels.filter("false"))
    assert {r.score for r in G.score(docs, nothing).collect()} == {0.5}
    assert G.score(docs.filter("false"), model).collect() == []


# --- packing

def check_packing(rows, pieces, capacity, tokens):
    """pieces: (id, piece, start, length, crc, sequence, offset); rows: (id, text)."""
    want = sorted((r[0] is None, r[0] or 0, len(t), zlib.crc32(t.tobytes())) for r, t in zip(rows, tokens))
    left = {}
    for p in pieces:
        left.setdefault(p[5], []).append(p)
    for parts in left.values():
        at = 0
        for p in sorted(parts, key=lambda p: p[6]):
            assert p[6] == at and p[3] >= 1
            at += p[3]
        assert at <= capacity
    assert sum(p[3] for p in pieces) == sum(w[2] for w in want)
    expected = []
    for r, t in zip(rows, tokens):
        n = len(t)
        first = n if n <= capacity else n % capacity or capacity
        bounds = [0, *range(first, n + 1, capacity)] if n > capacity else [0, n]
        expected += [(r[0], i, a, b - a, zlib.crc32(t[a:b].tobytes())) for i, (a, b) in enumerate(zip(bounds, bounds[1:]))]
    assert sorted([p[:5] for p in pieces], key=repr) == sorted(expected, key=repr)
    return len(left)


@pytest.fixture(scope="module")
def library_tokens():
    """Token ids by the tokenizers library, with the end id."""
    import public_tokenizers
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))

    def ids(texts):
        return [np.array([*e.ids, 2], "<u4") for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    return ids


def test_packing_query(spark, queries, documents, library_tokens):
    got = [tuple(r) for r in queries["op10_best_fit_packing"](spark, SF).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset").collect()]
    rows = [(i, r.text) for i, r in documents.items()]
    used = check_packing(rows, got, 1024, library_tokens([t for _, t in rows]))
    lengths = [p[3] for p in got]
    least = max(-(-sum(lengths) // 1024), sum(n > 512 for n in lengths))
    assert used <= 1.01 * least + 1


def test_packing_odd_rows(spark, library_tokens):
    from casegrade.llm import packing as K
    rows = ODD_ROWS + [(40, "word " * 3000)] + [(50, f"copy {'x ' * 40}") for _ in range(100)]
    got = [tuple(r)[:7] for r in K.pack(docs_df(spark, rows), capacity=64).select(
        "id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset").collect()]
    check_packing(rows, got, 64, library_tokens([t for _, t in rows]))
    assert K.pack(docs_df(spark, [])).collect() == []
    ids = K.pack(docs_df(spark, ODD_ROWS), with_ids=True).collect()
    assert all(zlib.crc32(r["ids"]) == r.ids_crc32 and len(r["ids"]) == 4 * r["length"] for r in ids)


def test_tokenizer_equals_the_library(library_tokens):
    from casegrade.llm import packing as K
    random.seed(9)
    alphabet = [" ", "\n", "a", "B", "'", "s", "1", ".", "é", "\t", "  ", "\xa0", "re", "<|", "日", "\x1c", "\r\n", "\U0001F600"]
    texts = ["".join(random.choices(alphabet, k=random.randrange(30))) for _ in range(1500)]
    texts += [" ".join(random.choices(["the", "cat's", "x.\ny", "12ab", "日本", "e"], k=20)) for _ in range(200)] + [None, LONG]
    expected = [t[:-1].tobytes() for t in library_tokens(texts)]
    assert K.tokenizer(None).encode(texts) == expected


def test_other_tokenizers_go_through_the_library(tmp_path):
    import json

    import public_tokenizers
    from casegrade.llm import packing as K
    from tokenizers import Tokenizer
    texts = ["The Cat's  hat\n\n in 12 boxes", "", " x", "É日本 ab" * 5, "naïve the"]
    with open(K.default_tokenizer(), encoding="utf-8") as f:
        spec = json.load(f)
    assert K.plain_byte_bpe(spec)
    model, split = spec["model"], spec["pre_tokenizer"]
    shuffled = model["merges"][:]
    shuffled[0], shuffled[2] = shuffled[2], shuffled[0]
    paths = [public_tokenizers.path("word_bpe_49k.json")]
    for name, change in (("lower", {"normalizer": {"type": "Lowercase"}}), ("prefix", {"pre_tokenizer": split | {"add_prefix_space": True}}),
                         ("plain", {"pre_tokenizer": split | {"use_regex": False}}), ("merges", {"model": model | {"merges": shuffled}}),
                         ("whole", {"model": model | {"ignore_merges": True}})):
        path = tmp_path / f"{name}.json"
        path.write_text(json.dumps(spec | change), encoding="utf-8")
        assert not K.plain_byte_bpe(spec | change)
        paths.append(str(path))
    for path in paths:
        library = Tokenizer.from_file(path)
        assert K.Tokenizer(path).encode([*texts, None]) == [
            *(np.array(e.ids, "<u4").tobytes() for e in library.encode_batch(texts, add_special_tokens=False)), b""]


def test_added_tokens_equal_the_library(library_tokens, tmp_path):
    import json

    from casegrade.llm import packing as K
    from tokenizers import Tokenizer
    end = "<|endoftext|>"
    random.seed(10)
    alphabet = [" ", "\n", "a", "B", "'s", "1", "\t", "  ", "é", "<|", "|>", "endoftext", end, end]
    texts = ["".join(random.choices(alphabet, k=random.randrange(20))) for _ in range(1500)]
    for text in ["end of", " a  b\n", "x", "", LONG]:
        texts += [end + text, text + end, f"{text}{end}{text}", f"{text} {end} {text}", f"{end}{end}{text}<{end}", text]
    expected = [t[:-1].tobytes() for t in library_tokens(texts)]
    assert np.frombuffer(K.tokenizer(None).encode([f"end {end} of"])[0], "<u4").tolist() == [437, 220, 50256, 286]
    assert K.tokenizer(None).encode([*texts, None]) == [*expected, b""]
    with open(K.default_tokenizer(), encoding="utf-8") as f:
        spec = json.load(f)
    plain = spec["added_tokens"][0]
    for rules in ({}, {"lstrip": True}, {"rstrip": True}, {"single_word": True}):       # one literal begins another
        spec["added_tokens"] = [plain, plain | {"id": 50257, "content": end + "<|"}, plain | {"id": 50258, "content": "a", **rules}]
        path = tmp_path / f"{'-'.join(rules)}.json"
        path.write_text(json.dumps(spec), encoding="utf-8")
        library = Tokenizer.from_file(str(path))
        assert K.Tokenizer(str(path)).encode(texts) == [
            np.array(e.ids, "<u4").tobytes() for e in library.encode_batch(texts, add_special_tokens=False)]


def best_fit_decreasing(counts, capacity):
    """Sequences that best fit takes, longest items first."""
    bins, n = {}, 0
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            room = next((r for r in range(length, capacity + 1) if bins.get(r)), None)
            if room is None:
                room, new = capacity, -(-left // (capacity // length))
                bins[room] = bins.get(room, 0) + new
                n += new
            m = min(left, bins[room])
            bins[room] -= m
            bins[room - length] = bins.get(room - length, 0) + m
            left -= m
    return n


@pytest.mark.parametrize("seed", range(6))
def test_plan_places_every_item_once(seed):
    from casegrade.llm import packing as K
    rng = np.random.default_rng(seed)
    capacity = [1024, 100, 64, 10, 1024, 1][seed]
    counts = {int(s): int(n) for s, n in zip(rng.integers(1, capacity + 1, 300), rng.integers(1, 10 ** (seed + 1), 300))}
    runs, n_bins = K.plan(counts, capacity)
    for length, n in counts.items():
        own = sorted((first, number) for s, first, number, _, _ in runs if s == length)
        assert own[0][0] == 0 and sum(k for _, k in own) == n
        assert all(a + k == b for (a, k), (b, _) in zip(own, own[1:]))
    edges = sorted({q for _, _, k, q, _ in runs for q in (q, q + k)})
    for at in edges[:-1][:400]:                              # sequences between two edges are alike
        inside = sorted((o, s) for s, _, k, q, o in runs if q <= at < q + k)
        assert inside[0][0] == 0 and all(o + s == p for (o, s), (p, _) in zip(inside, inside[1:]))
        assert inside[-1][0] + inside[-1][1] <= capacity
    assert edges[-1] == n_bins and edges[0] == 0
    assert n_bins <= 1.005 * best_fit_decreasing(counts, capacity) + 1
    assert len(runs) < 40 * capacity + 100                   # bounded by the capacity, not by the items


def test_equal_groups_round_to_few_sizes():
    from casegrade.llm import packing as K
    groups = K.equal_groups({s: 10 for s in range(1, 101)}, 10)
    assert groups == [[[s, 10] for s in range(high, high - 10, -1)] for high in range(100, 0, -10)]
    assert K.equal_groups({}, 5) == [] and K.equal_groups({7: 3}, 3) == [[[7, 1], [7, 1], [7, 1]]]
    assert K.equal_groups({9: 3, 5: 4, 4: 1}, 2) == [[[9, 3], [5, 1]], [[5, 3], [4, 1]]]     # 5 in two groups


def test_configurations_meet_the_demand_at_the_optimum():
    from itertools import combinations_with_replacement

    from casegrade.llm import packing as K
    rng = np.random.default_rng(4)
    for room, n in ((100, 6), (60, 4), (100, 12)):
        sizes = sorted(rng.choice(np.arange(room // 4 + 1, room), n, replace=False).tolist(), reverse=True)
        demand = rng.integers(1, 500, n).tolist()
        found = K.configurations(sizes, demand, room)
        met, total = np.zeros(n), 0.0
        for config, amount in found:
            assert sum(sizes[i] for i in config) <= room and amount > -1e-6
            met += amount * np.bincount(config, minlength=n)
            total += amount
        assert np.allclose(met, demand)
        # weak duality: prices that no configuration exceeds bound every plan from below
        worth = np.linalg.solve(np.array([np.bincount(c, minlength=n) for c, _ in found], float), np.ones(n))
        every = [c for k in range(1, 4) for c in combinations_with_replacement(range(n), k) if sum(sizes[i] for i in c) <= room]
        best = max(sum(worth[i] for i in c) for c in every)
        assert best <= 1 + 1e-6 and abs(worth @ demand - total) < 1e-5 * total
        value, config = K.knapsack(sizes, worth, room)
        assert abs(value - max(0, best)) < 1e-9 and sum(sizes[i] for i in config) <= room


# --- pipeline

def test_pipeline_stages(spark, documents):
    import corpus_pipeline as P
    from casegrade.llm import simhash, substring
    from casegrade.llm.common import stored
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept, columns = {}, docs.columns
    for name, stage in P.STAGES:
        before = docs
        docs = stored(stage(spark, docs, SF), f"test-{name}")
        kept[name] = docs
        if name != "best_fit_packing":
            assert docs.columns == columns
            assert docs.join(before.select("doc_id"), "doc_id", "left_anti").count() == 0
    assert [n for n, _ in P.STAGES] == list(kept)
    # language: clean prose stays; near copies: one of each component; passages: none left to cut
    assert kept["language_id"].count() >= 0.98 * len(documents)
    found = simhash.near_duplicates(kept["language_id"])
    assert kept["simhash_near_dedup"].count() == found.select("component").distinct().count()
    left = {r.doc_id: r.text for r in kept["substring_dedup"].collect()}
    cuts = substring.remove_repeats(kept["simhash_near_dedup"], keep=["doc_id"]).collect()
    for r in cuts:
        if r.n_removed == 0:
            assert left[r.doc_id] == documents[r.doc_id].text
        elif r.n_removed < r.n_words:
            assert left[r.doc_id] == r.kept_text
        else:
            assert r.doc_id not in left
    from casegrade.llm import decontamination as D
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    again = D.decontaminate(kept["benchmark_decontamination"], items)
    assert again.filter("contaminated").count() == 0
    lost = kept["substring_dedup"].join(kept["benchmark_decontamination"].select("doc_id"), "doc_id", "left_anti")
    assert D.decontaminate(lost, items).filter("not contaminated").count() == 0
    packed = docs.select("doc_id").distinct().count()
    assert packed == kept["benchmark_decontamination"].count()


def test_pipeline_odd_rows(spark):
    import corpus_pipeline as P
    from casegrade.llm.common import stored
    rows = [(i, t, None if i == 4 else "en") for i, t in ODD_ROWS]
    for table in (rows, []):
        docs = docs_df(spark, table)
        columns = docs.columns
        for name, stage in P.STAGES:
            assert docs.columns == columns
            docs = stored(stage(spark, docs, SF), f"odd-{name}")
        assert (docs.count() > 0) == bool(table)


def test_language_stage_without_labels(spark):
    import corpus_pipeline as P
    docs = docs_df(spark, ODD_ROWS).withColumn("lang", F.lit(None).cast("string"))
    kept = P.language_id(spark, docs, SF)
    assert kept.columns == docs.columns
    lettered = [r.text for r in docs.collect() if any(c.isalpha() for c in r.text or "")]
    assert lettered and sorted(r.text for r in kept.collect()) == sorted(lettered)


def boosted_by_hand(x, y, rounds, pair_rounds, n_pairs, bins, pair_bins):
    """Cyclic boosting row by row: the score of each row."""
    rows, m = range(len(x)), x.shape[1]
    share = (sum(y) + 1) / (len(y) + 2)
    total = [math.log(share / (1 - share))] * len(x)
    edges = [sorted(set(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1]).tolist())) for j in range(m)]
    fine = [[sum(e <= x[r, j] for e in edges[j]) for r in rows] for j in range(m)]
    coarse = [[fine[j][r] * pair_bins // (len(edges[j]) + 1) for r in rows] for j in range(m)]

    def slopes():
        p = [1 / (1 + math.exp(-t)) for t in total]
        return [y[r] - p[r] for r in rows], [p[r] * (1 - p[r]) for r in rows]

    def worth(some, g, h):
        return sum(g[r] for r in some) ** 2 / (sum(h[r] for r in some) + 1.0)

    def grow(some, box, cells, g, h, depth, out):
        best = (0.0, 0, 0)
        for axis, (low, high) in enumerate(box) if depth else ():
            top = (0.0, 0)
            for cut in range(low + 1, high):
                sides = [[r for r in some if cells[axis][r] < cut], [r for r in some if cells[axis][r] >= cut]]
                if all(sum(h[r] for r in side) >= 1.0 for side in sides):
                    gain = sum(worth(side, g, h) for side in sides) - worth(some, g, h)
                    if gain > top[0] + 1e-12:
                        top = gain, cut
            if top[0] > 1e-9:
                best = max(best, (top[0], axis, top[1]))
        if not best[2]:
            for r in some:
                out[r] = sum(g[q] for q in some) / (sum(h[q] for q in some) + 1.0)
            return
        _, axis, cut = best
        for low, high, keep in ((box[axis][0], cut, lambda c: c < cut), (cut, box[axis][1], lambda c: c >= cut)):
            inside = [b if a != axis else (low, high) for a, b in enumerate(box)]
            grow([r for r in some if keep(cells[axis][r])], inside, cells, g, h, depth - 1, out)

    def step(cells, box):
        g, h = slopes()
        out = [0.0] * len(x)
        grow(list(rows), box, cells, g, h, 2, out)
        for r in rows:
            total[r] += 0.1 * out[r]
    for _ in range(rounds):
        for j in range(m):
            step([fine[j]], [(0, len(edges[j]) + 1)])
    g, h = slopes()

    def strength(pair):
        cells = {}
        for r in rows:
            cells.setdefault((coarse[pair[0]][r], coarse[pair[1]][r]), []).append(r)
        return sum(worth(c, g, h) for c in cells.values())
    chosen = sorted([(i, j) for i in range(m) for j in range(i + 1, m)], key=lambda p: -strength(p))[:n_pairs]
    for _ in range(pair_rounds):
        for i, j in chosen:
            step([coarse[i], coarse[j]], [(0, pair_bins)] * 2)
    return [1 / (1 + math.exp(-t)) for t in total]


def test_gam_equals_boosting_by_hand(monkeypatch):
    from casegrade.llm import quality_gam as Q
    for name, value in (("ROUNDS", 5), ("PAIR_ROUNDS", 4), ("PAIRS", 2), ("BINS", 12), ("PAIR_BINS", 5)):
        monkeypatch.setattr(Q, name, value)
    rng = np.random.default_rng(7)
    x = np.round(rng.normal(size=(90, 4)), 2)
    x[:, 3] = rng.integers(0, 3, 90)                 # few values: fewer bins
    y = ((x[:, 0] * x[:, 1] > 0) ^ (rng.random(90) < 0.2)).astype(float)
    assert np.allclose(Q.fit(x, y).score(x), boosted_by_hand(x, y, 5, 4, 2, 12, 5), atol=1e-9)


def test_quality_labels_of_other_corpora_take_no_place(spark, monkeypatch):
    from casegrade.llm import quality_gam as Q
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(20)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2, "x") for i in range(3000)], "doc_id bigint, quality int, held string")
    seen, fit = [], Q.fit
    monkeypatch.setattr(Q, "fit", lambda x, y: seen.append(len(y)) or fit(x, y))
    Q.train(docs, labels, rows=50)
    assert seen == [20]


def test_quality_trains_on_one_row_of_an_id(spark, monkeypatch):
    from casegrade.llm import quality_gam as Q
    rows = [(1, f"clean words number {i}") for i in range(300)] + [(1, None), (2, "## $$ %%"), (3, "some text"), (None, "none")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1), (None, 1)], "doc_id bigint, quality int")
    seen, fit = [], Q.fit
    monkeypatch.setattr(Q, "fit", lambda x, y: seen.append((x.tolist(), y.tolist())) or fit(x, y))
    Q.train(docs, labels)
    Q.train(docs.orderBy(F.desc("text")).repartition(7), labels)
    assert len(seen[0][1]) == 3 and sorted(seen[0][1]) == [0.0, 1.0, 1.0] and seen[0] == seen[1]
