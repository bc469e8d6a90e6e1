"""URL filter: allow and block rules, and redirect equivalence.

* ``match_rules``: the longest rule (host and path prefix) that fits each URL.
  Rules are read partition by partition in blocks of at most ``BLOCK_RULES``;
  each block is broadcast as a table of hosts and looked up by the URL's host
  and its parent domains.
* ``page_links``: what pages declare about themselves, as edges between
  resources: ``<link rel=canonical href>`` and ``<meta http-equiv=refresh>``
  with a URL. Comments and scripts are not looked at; relative URLs are
  resolved. Redirects seen by a crawler are given as further edges.
* ``blocked_aliases``: connected components of the edges (``components.py``). A
  block rule on any resource of a component, in the table or only a target,
  blocks all its resources.
* ``judge``: a page's own rule decides, so an explicit allow holds against a
  block that reached it; without a rule the page is blocked if its component
  is, else allowed. Allows do not spread.

A resource is a URL's host (A-Z lower-cased), path and query; schemes and
fragments do not tell resources apart. Resources of edges get the numbers of
their places in a stored table, so no hash can merge two of them. Joins to hot
resources (a home page that a third of all pages name) are salted.

Defined cases: a URL that is null or without ``://`` has an empty host and
path, fits no rule and is no resource (verdict allow); a null html declares
nothing; repeated pages and edges count once for the components, and every page
row gets its row; of rules of one length the one with the longer host wins, and
an allow over a block of the same text; empty tables give no rows.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.skew import SkewGuard, salted_left_join
from .common import named, stored
from .components import components

BLOCK_RULES = 100_000
RULES = "verdict string, host string, path string"
ALLOW, BLOCK = "allow", "block"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_SILENT = r"(?is)<!--.*?-->|<script\b.*?</script\s*>"
_TAGS = r"(?is)<(?:link|meta)\b[^>]*>"
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_REFRESH = re.compile(r"""^\s*[0-9.]*\s*[;,]\s*url\s*=\s*(?:"([^"]*)"?|'([^']*)'?|(\S+))""", re.I)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host(url: Column) -> Column:
    found = F.regexp_extract(_after_scheme(url), "^[^/?#]*", 0)
    return F.coalesce(F.translate(found, _UPPER, _UPPER.lower()), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_after_scheme(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def resource(url: Column) -> Column:
    """Host, path and query of a URL; null if it has no scheme."""
    rest = F.regexp_extract(_after_scheme(url), "^[^/?#]*([^#]*)", 1)
    return F.when(F.instr(url, "://") > 0, F.concat(host(url), rest))


def rule_table(spark: SparkSession, rules: list[tuple[str, str]]) -> DataFrame:
    """Rules as (verdict, ``host/path``) -> verdict, host, path."""
    rows = [(verdict, text.partition("/")[0], "/" + text.partition("/")[2]) for verdict, text in rules]
    return spark.createDataFrame(rows, RULES)


def _rule_blocks(rules: DataFrame) -> Iterator[dict[str, list[tuple[str, str]]]]:
    block: dict[str, list] = {}
    n = 0
    for r in rules.select("verdict", "host", "path").toLocalIterator():
        if r.host is not None and r.path is not None:
            block.setdefault(r.host.lower(), []).append((r.path, r.verdict))
            n += 1
        if n == BLOCK_RULES:
            yield block
            block, n = {}, 0
    if block:
        yield block


def fitting(hosts: dict[str, list[tuple[str, str]]], host_name: str, path_text: str) -> tuple[str, str, int] | None:
    """(rule, verdict, length of its host) of the longest rule that fits."""
    best = None
    labels = host_name.split(".")
    for i in range(len(labels)):
        name = ".".join(labels[i:])
        for prefix, verdict in hosts.get(name, ()):
            if path_text.startswith(prefix):
                found = len(name) + len(prefix), len(name), verdict == ALLOW, name + prefix, verdict
                best = max(best, found) if best else found
    return best and (best[3], best[4], best[1])


def _lookup(shared):
    @F.pandas_udf("rule string, verdict string, depth int")
    def look(hosts: pd.Series, paths: pd.Series) -> pd.DataFrame:
        found = [fitting(shared.value, h, p) or (None, None, None) for h, p in zip(hosts, paths)]
        return pd.DataFrame(found, columns=["rule", "verdict", "depth"]).astype({"depth": "Int32"})
    return look("host", "path")


def match_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``urls`` (with columns ``host`` and ``path``) and ``rule``, ``rule_verdict``; null without a rule."""
    context = urls.sparkSession.sparkContext

    def order(best):
        return F.struct(F.length(best["rule"]), best["depth"], best["verdict"] == ALLOW)
    rows = urls.withColumn("__best", F.lit(None).cast("struct<rule:string,verdict:string,depth:int>"))
    for block in _rule_blocks(rules):
        rows = rows.withColumn("__found", _lookup(context.broadcast(block)))
        old, new = F.col("__best"), F.col("__found")
        better = new["rule"].isNotNull() & (old["rule"].isNull() | (order(new) > order(old)))
        rows = rows.withColumn("__best", F.when(better, new).otherwise(old)).drop("__found")
    return rows.withColumns({"rule": F.col("__best.rule"), "rule_verdict": F.col("__best.verdict")}).drop("__best")


def _targets(url: str, tags: list[str]) -> list[str]:
    found = []
    for tag in tags:
        own = {}
        for name, *values in _ATTRIBUTE.findall(tag):
            own.setdefault(name.lower(), html.unescape("".join(values)).strip())
        target = None
        if tag[1:5].lower() == "link" and "canonical" in own.get("rel", "").lower().split():
            target = own.get("href")
        elif tag[1:5].lower() == "meta" and own.get("http-equiv", "").lower() == "refresh":
            m = _REFRESH.match(own.get("content", ""))
            target = m and next((g for g in m.groups() if g is not None), None)
        if target:
            try:
                found.append(urljoin(url, target.strip()))
            except ValueError:                       # not a URL: declares nothing
                continue
    return found


def page_links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(source, target): URLs that pages declare to be the same resource."""
    lowered = F.lower(F.col(html_col))
    speaks = lowered.contains("canonical") | lowered.contains("refresh")
    tags = F.regexp_extract_all(F.regexp_replace(html_col, _SILENT, " "), F.lit(_TAGS), F.lit(0))

    @F.pandas_udf("array<string>")
    def targets(urls: pd.Series, found: pd.Series) -> pd.Series:
        return pd.Series([_targets(u, list(t)) for u, t in zip(urls, found)])
    own = pages.filter(F.instr(url_col, "://") > 0).filter(speaks).select(F.col(url_col).alias("source"), tags.alias("tags"))
    return own.filter(F.size("tags") > 0).select("source", F.explode(targets("source", "tags")).alias("target"))


def blocked_aliases(links: DataFrame, rules: DataFrame, guard: SkewGuard = SkewGuard()) -> DataFrame | None:
    """(resource): what a block rule reaches over (source, target) URLs; None without edges."""
    edges = stored(links.select(resource(F.col("source")).alias("a"), resource(F.col("target")).alias("b"))
                   .filter("a is not null and b is not null and a <> b").distinct(), "url-edges")
    if edges.isEmpty():
        return None
    ends = edges.select(F.explode(F.array("a", "b")).alias("resource")).distinct()
    nodes = stored(ends.withColumn("node", F.monotonically_increasing_id()), "url-nodes")
    for name in ("a", "b"):                          # a resource named by very many others is a hot key
        number = nodes.select(F.col("resource").alias(name), F.col("node").alias(f"node_{name}"))
        edges = stored(salted_left_join(edges, number, name, guard), "url-edges")
    group = components(edges.select(F.col("node_a").alias("u"), F.col("node_b").alias("v")))
    address = F.concat(F.lit("://"), "resource")
    judged = match_rules(nodes.select("node", "resource", host(address).alias("host"), path(address).alias("path")), rules)
    members = stored(judged.join(group, "node").select("resource", "component", "rule_verdict"), "url-members")
    bad = members.filter(F.col("rule_verdict") == BLOCK).select("component").distinct()
    hit = salted_left_join(members, bad.withColumn("bad", F.lit(True)), "component", guard)
    return stored(hit.filter("bad").select("resource"), "url-blocked")


def judge(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
          redirects: DataFrame | None = None, guard: SkewGuard = SkewGuard()) -> DataFrame:
    """(id, host, path, rule, verdict, propagated): one row per page.

    ``redirects`` has further edges as columns source and target, both URLs.
    ``propagated`` tells blocks that came over an edge.
    """
    url = F.col(url_col)
    links = page_links(pages, url_col, html_col)
    if redirects is not None:
        links = links.unionByName(redirects.select("source", "target"))
    blocked = blocked_aliases(links, rules, guard)
    rows = pages.select(F.col(id_col).alias("id"), host(url).alias("host"), path(url).alias("path"),
                        resource(url).alias("resource"))
    rows = match_rules(rows, rules)
    if blocked is None:
        rows = rows.withColumn("reached", F.lit(False))
    else:
        rows = salted_left_join(rows, blocked.withColumn("hit", F.lit(True)), "resource", guard)
        rows = rows.withColumn("reached", F.coalesce("hit", F.lit(False)))
    propagated = F.col("rule").isNull() & F.col("reached")
    return rows.select("id", "host", "path", "rule",
                       F.coalesce("rule_verdict", F.when(propagated, F.lit(BLOCK)).otherwise(F.lit(ALLOW))).alias("verdict"),
                       propagated.alias("propagated"))


def allowed_rows(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", **options) -> DataFrame:
    """The rows of ``pages`` whose id has an allow verdict only."""
    bad = judge(pages, rules, id_col, **options).filter(F.col("verdict") == BLOCK).select(F.col("id").alias("__bad")).distinct()
    return pages.join(bad, F.col(id_col).eqNullSafe(F.col("__bad")), "left_anti").select(*named(pages.columns))
