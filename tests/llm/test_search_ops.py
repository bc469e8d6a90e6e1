"""URL filter, lexical search and hard negatives against brute force, and on odd rows."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from corpus_fixtures import LONG, ODD_ROWS, docs_df
from pyspark.sql import functions as F

from casegrade.llm import hard_negatives as H
from casegrade.llm import lexical as X
from casegrade.llm import url_filter as U
from casegrade.operators.skew import SkewGuard

# ---------------------------------------------------------------- URL filter

RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]
PAGES_DDL = "page_id long, url string, html string, host string, rule string, verdict string, id string, resource string, `a.b` string"


def judged(spark, pages, redirects=None, rules=RULES):
    rows = spark.createDataFrame([(p[0], p[1], p[2] if len(p) > 2 else None, *"xxxxxx") for p in pages], PAGES_DDL)
    edges = spark.createDataFrame(redirects, "source string, target string") if redirects else None
    found = U.judge(rows, U.rule_table(spark, rules), redirects=edges)
    return sorted((tuple(r) for r in found.select("id", "host", "path", "rule", "verdict", "propagated").collect()), key=repr)


def test_hosts_paths_and_rules(spark):
    got = judged(spark, [
        (1, "http://A.Example.NET/en/x?q#f"), (2, "https://example.net/de/"), (3, "http://net"), (4, "http://net/"),
        (5, "http://xnet/"), (6, "https://www.example.com/de/1"), (7, "https://example.com/d"), (8, None), (9, "no scheme"),
        (10, "http://É.org/fr/"), (11, "http://example.net?x=/en/"), (12, "ftp://u@h.net:80/"), (12, "ftp://u@h.net:80/"),
        (None, "http://a.net/://b"), (13, "://x.net/"), (14, "http://x.net\n/y")])
    assert got == sorted([
        (1, "a.example.net", "/en/x", "example.net/en/", "allow", False), (2, "example.net", "/de/", "net/", "block", False),
        (3, "net", "", None, "allow", False), (4, "net", "/", "net/", "block", False), (5, "xnet", "/", None, "allow", False),
        (6, "www.example.com", "/de/1", "example.com/de/", "block", False), (7, "example.com", "/d", None, "allow", False),
        (8, "", "", None, "allow", False), (9, "", "", None, "allow", False), (10, "É.org", "/fr/", "org/fr/", "allow", False),
        (11, "example.net", "", None, "allow", False), (12, "u@h.net:80", "/", None, "allow", False),
        (12, "u@h.net:80", "/", None, "allow", False), (None, "a.net", "/://b", "net/", "block", False),
        (13, "x.net", "/", "net/", "block", False), (14, "x.net\n", "/y", None, "allow", False)], key=repr)


def test_blocks_reach_aliases_and_allows_hold(spark):
    def canonical(url):
        return f"<html><HEAD><link data-x='1' REL=\"canonical nofollow\" href='{url}'></head>"
    got = judged(spark, [
        (1, "http://a.com/1", canonical("http://b.com/2")), (2, "https://b.com/2#top", canonical("/3")),
        (3, "http://b.com/3", '<meta http-equiv="Refresh" content="0; URL=\'http://bad.net/&amp;\'">'),
        (4, "http://x.org/fr/ok", canonical("http://a.com/1")),                       # allowed by its own rule
        (5, "http://c.com/", "<!-- " + canonical("http://bad.net/") + " -->"),          # in a comment
        (6, "http://d.com/", "<script>'" + canonical("http://bad.net/") + "'</script>"),
        (7, "http://e.com/", canonical("http://f.com/") + canonical("http://[bad")), (8, "http://f.com/"),
        (9, "http://a.com/1?x"), (10, "http://b.com/dir/4", canonical("../3")), (11, None, canonical("http://bad.net/")),
        (12, "http://g.com/"), (1, "http://a.com/1", None)],
        [("http://g.com/", "http://far.example.com/de/"), (None, "http://bad.net/"), ("http://far.example.com/de/", "nowhere")])
    assert {(r[0], r[4], r[5]) for r in got} == {
        (1, "block", True), (2, "block", True), (3, "block", True), (4, "allow", False), (5, "allow", False),
        (6, "allow", False), (7, "allow", False), (8, "allow", False), (9, "allow", False), (10, "block", True),
        (11, "allow", False), (12, "block", True)} and len(got) == 13


def test_rules_in_blocks_and_ties(spark, monkeypatch):
    rules = [("block", "com/"), ("allow", "com/"), ("block", "b.com/"), ("allow", "com/ab"), ("block", "com/x")]
    urls = [(1, "http://a.com/"), (2, "http://b.com/ab"), (3, "http://a.com/x"), (4, "http://a.com/ab")]
    whole = judged(spark, urls, rules=rules)
    assert [(r[3], r[4]) for r in whole] == [("com/", "allow"), ("b.com/", "block"), ("com/x", "block"), ("com/ab", "allow")]
    monkeypatch.setattr(U, "BLOCK_RULES", 1)
    assert judged(spark, urls, rules=rules) == whole
    assert [r[4] for r in judged(spark, urls, rules=[])] == ["allow"] * 4 and judged(spark, []) == []


def test_chain_and_star_with_a_hot_resource(spark):
    """A third of the pages names one home page; a chain of aliases ends in a blocked one."""
    n = 3000
    pages = [(i, f"http://s.com/{i}", '<link rel=canonical href="http://home.com/">') for i in range(n)]
    pages += [(n + i, f"http://chain.com/{i}", f'<link rel=canonical href="http://chain.com/{i + 1}">') for i in range(200)]
    pages += [(2 * n, "http://home.com/", None), (2 * n + 1, "http://chain.com/200", '<link rel=canonical href="//z.net/">')]
    rows = spark.createDataFrame(pages, "page_id long, url string, html string")
    guard = SkewGuard(sample_fraction=1.0, factor=0.5)
    found = {r.id: r.verdict for r in U.judge(rows, U.rule_table(spark, RULES), guard=guard).collect()}
    assert {i for i, v in found.items() if v == "block"} == {n + i for i in range(200)} | {2 * n + 1} and len(found) == n + 202
    kept = U.allowed_rows(rows, U.rule_table(spark, RULES), guard=guard)
    assert kept.count() == n + 1 and kept.columns == rows.columns


# ------------------------------------------------------------ lexical search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def cut(text):
    return TERM.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def brute_search(docs, items, k=10):
    docs = [(d, cut(t)) for d, t in docs]
    n_docs, length = sum(bool(w) for _, w in docs), sum(len(w) for _, w in docs)
    df = Counter(t for _, w in docs for t in set(w))
    out = []
    for item, text in items:
        query = Counter(t for t in cut(text) if df[t])
        weights = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) for t in query}
        found = []
        for d, w in docs:
            tf = Counter(w)
            s = sum(r * weights[t] * (10 ** 9 * tf[t] // (1000 * tf[t] + 8 * (25 + 75 * len(w) * n_docs // length)))
                    for t, r in query.items() if tf[t])
            if s > 0:
                found.append((-s, d is None, d or 0, d))
        out += [(item, i + 1, row[3], -row[0]) for i, row in enumerate(sorted(found, key=lambda r: r[:3])[:k])]
    return sorted(out, key=repr)


def searched(spark, docs, items, **options):
    frame = spark.createDataFrame(items, "item_id string, text string")
    got = X.search(docs_df(spark, docs), frame, **options)
    return sorted((tuple(r) for r in got.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


ITEMS = [("a", "some words Here w7 w7 W919"), ("b", None), ("c", " .,; "), ("a", "same row"), (None, "Zwei wörter nowhere"),
         ("d", "no-such-term"), ("e", "é emoji İ id 😀"), ("f", "same same row text one")]


def test_search_equals_brute_force_on_odd_rows(spark):
    assert searched(spark, ODD_ROWS, ITEMS) == brute_search([(d, t) for d, t, *_ in ODD_ROWS], ITEMS)
    assert searched(spark, [], ITEMS) == searched(spark, ODD_ROWS, []) == searched(spark, [(1, None)], ITEMS) == []


def test_search_equals_brute_force_in_many_blocks(spark, monkeypatch):
    rng = random.Random(3)
    words = [f"t{min(int(rng.expovariate(0.05)), 300)}" for _ in range(5000)]
    docs = [(i, " ".join(rng.choices(words, k=rng.choice([1, 5, 40, 200])))) for i in range(700)]
    docs += [(1000 + i, docs[5][1]) for i in range(300)] + [(5, docs[5][1]), (2000, LONG)]
    items = [(str(i), " ".join(rng.choices(words, k=rng.choice([1, 3, 30])))) for i in range(40)] + [("copy", docs[5][1])]
    for name, value in (("BLOCK_ROWS", 97), ("LEAF_ROWS", 8), ("BLOCK_ITEMS", 15), ("_DENSE", 1000)):
        monkeypatch.setattr(X, name, value)
    assert searched(spark, docs, items) == brute_search(docs, items)
    assert searched(spark, docs, items, top=3) == brute_search(docs, items, 3)


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(1)
    n_terms, sizes = 60, rng.integers(1, 12, 400)
    terms = [np.sort(rng.choice(n_terms, s, replace=False)) for s in sizes]
    values = [rng.integers(1, 10 ** 6, s) for s in sizes]
    block = X.Block(np.arange(400), np.r_[0, np.cumsum(sizes)], np.concatenate(terms), np.concatenate(values))
    tree = X.Tree(block, n_terms, 10)
    q = np.sort(rng.choice(n_terms, 5, replace=False))
    w = rng.integers(1, 20_000, 5)
    bounds = tree.bounds(np.array([0, 5]), q, w)[:, 0]
    dense = np.zeros(n_terms, np.int64)
    dense[q] = w
    opened = []

    def under(node):
        if tree.leaves[node] is not None:
            return tree.leaves[node].dot(dense).max()
        return max(under(c) for c in tree.children[node])
    assert all(under(node) <= bounds[node] for node in range(len(bounds)))
    for leaf in filter(None, tree.leaves):
        leaf.dot, plain = lambda d, leaf=leaf: opened.append(leaf) or X.Block.dot(leaf, d), leaf.dot
    found = tree.search(bounds, dense, [], 5)
    scores = block.dot(dense)
    assert found == sorted(zip((-scores).tolist(), range(400)))[:5]
    assert 0 < len(opened) < sum(leaf is not None for leaf in tree.leaves)


# ------------------------------------------------------------ hard negatives

VECTORS_DDL = "vec_id long, embedding array<float>, label int, id string, score string, width string"


def brute_negatives(rows):
    rows = [(i, [math.floor(256 * float(x)) for x in v], label) for i, v, label in rows
            if label is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, va, la in rows:
        if a is None or a % 100:
            continue
        scored = [(sum(x * y for x, y in zip(va, v)), i, label) for i, v, label in rows if i != a]

        def order(r):
            return -r[0], r[1] is None, r[1] or 0
        for p in sorted((r for r in scored if r[2] == la), key=order)[:5]:
            fits = sorted((r for r in scored if r[2] != la and 80 * p[0] <= 100 * r[0] <= 100 * p[0]), key=order)[:5]
            out += [(a, p[1], k + 1, n[1], p[0], n[0]) for k, n in enumerate(fits)]
    return sorted(out, key=repr)


def mined(spark, rows, parts=3):
    frame = spark.createDataFrame([(*r, "x", "x", "x") for r in rows], VECTORS_DDL).repartition(parts)
    got = H.mine(frame, F.col("id") % 100 == 0)
    names = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    return sorted((tuple(r) for r in got.select(*names).collect()), key=repr)


def clustered(n, width, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(4, width))
    return [(i, (centres[i % 4] * 0.4 + rng.normal(size=width) * 0.3).astype(np.float32).tolist(), i % 3) for i in range(n)]


def test_negatives_equal_brute_force_on_odd_rows(spark):
    rows = clustered(260, 20, 1)
    v = rows[100][1]
    rows += [(100, v, 1), (300, v, 0), (301, v, 1), (301, v, 1), (None, v, 0), (None, v, 2), (400, None, 1), (500, [], 1),
             (600, [float("nan")] * 20, 1), (700, v, None), (302, [1.0, float("inf")], 1), (800, v[:7], 0),
             (303, v[:7], 1), (304, [*v, 9.0], 1), (900, [0.0] * 20, 0), (305, [None, 1.0], 1), (1000, [2e6] * 3, 0), (306, [1e30], 1)]
    want = brute_negatives([r for r in rows if r[0] not in (306, 1000)])
    assert mined(spark, [r for r in rows if r[0] not in (306, 1000)]) == want and len(want) > 50
    huge = {r for r in mined(spark, rows) if r[0] == 1000}               # limited to 2^31 a component, no overflow
    assert all(abs(r[4]) < 2 ** 63 and abs(r[5]) < 2 ** 63 for r in huge)
    assert mined(spark, []) == [] and mined(spark, rows[:1]) == []


def test_negatives_equal_brute_force_in_many_blocks(spark, monkeypatch):
    rows = clustered(900, 64, 2) + [(2000 + i, clustered(900, 64, 2)[7][1], 1) for i in range(300)]
    for name, value in (("BLOCK_ANCHORS", 4), ("TILE_ROWS", 50), ("TILE_QUERIES", 3), ("SEED_STEP", 4), ("_DENSE_SHARE", 0.3)):
        monkeypatch.setattr(H, name, value)
    want = brute_negatives(rows)
    assert mined(spark, rows, 5) == want and len(want) > 100


@pytest.mark.parametrize("width", [1, 3, 17, 64])
def test_segment_bounds_hold(width):
    rng = np.random.default_rng(width)
    vectors = rng.integers(-500, 500, (60, width))
    vectors[::7] = 31                                # flat segments: the bound is the score
    rows = H.rows_of(np.arange(60), np.zeros(60), vectors)
    exact = vectors @ vectors.T
    reach = []
    for means, deviations in rows.levels:
        middle, off = means @ means.T, deviations @ deviations.T
        assert (np.abs(exact - middle) <= off + 1e-6).all()
        reach.append(off.sum())
    assert reach[1] <= reach[0] + 1e-6               # finer segments bound no worse
    low, high = np.full(60, 1000), np.full(60, 40_000)
    q, r, s = H.in_band(rows, rows, np.ones((60, 60), bool), low, high)
    assert sorted(zip(q, r, s)) == sorted((i, j, exact[i, j]) for i, j in zip(*np.nonzero((exact >= 1000) & (exact <= 40_000))))


def test_scores_beyond_the_exact_range_of_doubles():
    vectors = np.array([[2 ** 31, -(2 ** 31), 7], [2 ** 31, 2 ** 31 - 1, 1]])
    rows = H.rows_of([1, 2], [0, 0], vectors)
    want = [int(a @ b.astype(object)) for a in vectors.astype(object) for b in vectors.astype(object)]
    q, r = np.repeat([0, 1], 2), np.tile([0, 1], 2)
    assert H.scores(rows, rows, q, r).tolist() == [min(max(w, -2 ** 63), 2 ** 63 - 1) for w in want]
