"""Benchmark decontamination by a distributed positional inverted index.

DataFrame functions only; no Python runs on the executors.

* ``postings``: the training tokens that are test terms, as (term, document,
  position), written to the shared folder with a closing posting per document
  that holds its word count. Only test terms are kept: another benchmark needs
  another pass, but the index stays a fraction of the text.
* ``windows``: the benchmark's runs of ``WINDOW`` consecutive words (an item of
  fewer words is one window), with their terms ordered by frequency in the
  stored postings.
* ``intersect``: the posting lists of a window's terms, each moved by the term's
  offset, are intersected from the rarest on: the two rarest meet first, and the
  starts that both hold are looked up in the lists of all others. What is left
  holds the whole phrase; the texts are not read again. With ``slack`` every term
  may lie that many words from its place: a proximity match.

Scale: postings are never grouped by term, so a term in every document is just
many rows. The term table joins by broadcast while it is measured small, else
by a join salted on the position; rarest terms make short lists. Lists meet on
(document, position) keys and are made distinct before they meet, so rows that
repeat do not multiply. The outcome of a document goes back to its rows by a
join that salts hot documents. Nothing reaches the driver but row counts.

Words: A-Z lower-cased; runs of digits, letters a-z and characters above 0x7F.

Defined cases: a null or wordless text has no words and no hits; a null or
wordless item has no window; a null item id is named ``null``; repeated items
and rows count once for each document; rows of one id with other texts are
separate documents, equal rows get equal results; empty tables are allowed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.skew import SkewGuard, salted_left_join
from .common import id_order, named, stored, text_key

WINDOW = 10
#: A table with at most this many rows (of about 100 bytes) is broadcast.
BROADCAST_ROWS = 200_000
SALTS = 64
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The term of the closing posting; no word contains a space.
_END = " end"


def words(text: Column) -> Column:
    lowered = F.translate(F.coalesce(text, F.lit("")), _UPPER, _UPPER.lower())
    return F.array_remove(F.split(lowered, _BETWEEN), "")


def small(df: DataFrame) -> DataFrame:
    """``df`` with a broadcast hint if its rows are few enough; counted first."""
    few = df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return F.broadcast(df) if few else df


def windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """(item, window, terms): one row per distinct window of an item."""
    found = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("item"),
                         words(F.col(text_col)).alias("w")).filter(F.size("w") > 0)
    last = F.greatest(F.lit(0), F.size("w") - window)
    cut = found.select("item", F.explode(F.transform(F.sequence(F.lit(0), last),
                                                     lambda i: F.slice("w", i + 1, window))).alias("terms")).distinct()
    return cut.withColumn("window", F.array_join("terms", " "))


def postings(docs: DataFrame, terms: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The stored index (term, d, k, pos) for the column ``term`` of ``terms``."""
    tokens = docs.select(
        id_order(id_col).alias("d"), text_key(id_col, text_col).alias("k"),
        F.posexplode(F.array_append(words(F.col(text_col)), F.lit(_END))).alias("pos", "token"))
    closing = docs.sparkSession.range(1).select(F.lit(_END).alias("term"))
    known = stored(terms.select("term").distinct().unionByName(closing), "decontamination-terms")
    hinted = small(known)
    if hinted is known:                       # too many terms to broadcast: spread frequent tokens
        salt = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
        hits = tokens.join(known.withColumn("salt", salt), (F.col("token") == F.col("term"))
                           & (F.col("pos") % SALTS == F.col("salt")))
    else:
        hits = tokens.join(hinted, F.col("token") == F.col("term"))
    return stored(hits.select("term", "d", "k", "pos"), "decontamination-postings")


def lengths(index: DataFrame) -> DataFrame:
    """(d, k, n_words) from the closing postings."""
    return index.filter(F.col("term") == _END).select("d", "k", F.col("pos").cast("long").alias("n_words")).distinct()


def ranked_terms(index: DataFrame, cut: DataFrame) -> DataFrame:
    """(window, size, rank, term, off): each window's places, those with rare terms first.

    A window with a term that no document holds is left out.
    """
    counts = small(stored(index.filter(F.col("term") != _END).groupBy("term").agg(F.count(F.lit(1)).alias("n")),
                          "decontamination-counts"))
    places = (cut.select("window", "terms").distinct()
              .select("window", F.size("terms").alias("size"), F.posexplode("terms").alias("off", "term")))
    rarest = Window.partitionBy("window").orderBy("n", "term", "off")
    ranked = (places.join(counts, "term")
              .withColumn("rank", F.row_number().over(rarest))
              .withColumn("held", F.count(F.lit(1)).over(Window.partitionBy("window"))))
    return stored(ranked.filter(F.col("held") == F.col("size")).select("window", "size", "rank", "term", "off"),
                  "decontamination-ranked")


def intersect(index: DataFrame, ranked: DataFrame, slack: int = 0) -> DataFrame:
    """(window, d, k, start): where all terms of a window lie within ``slack`` of their places."""
    near = F.sequence(F.lit(-slack), F.lit(slack))

    def starts(rank):
        own = ranked.filter(F.col("rank") == rank).select("window", "size", F.col("term").alias("anchor"), "off")
        found = (index.join(small(own), F.col("term") == F.col("anchor"))
                 .select("window", "size", "d", "k", (F.col("pos") - F.col("off")).alias("start")))
        if slack:
            found = found.select("*", F.explode(near).alias("shift")).withColumn("start", F.col("start") + F.col("shift"))
        # equal rows, and starts reached twice, meet the other lists once
        return found.groupBy("window", "d", "k", "start").agg(F.first("size").alias("size"))
    first = starts(1)
    second = starts(2).drop("size")
    both = first.filter("size > 1").join(second, ["window", "d", "k", "start"])
    both = stored(both, "decontamination-pairs")
    left = both.filter("size > 2")
    documents = small(stored(left.select("d", "k").distinct(), "decontamination-documents"))
    others = ranked.filter("rank > 2").select("window", "rank", "term", "off")
    needed = left.join(small(others), "window").select(
        "window", "d", "k", "start", "size", "rank", "term", (F.col("start") + F.col("off")).alias("pos"))
    if slack:
        needed = needed.select("*", F.explode(near).alias("shift")).withColumn("pos", F.col("pos") + F.col("shift"))
    terms = small(others.select("term").distinct())
    held = (index.join(documents, ["d", "k"], "left_semi").join(terms, "term", "left_semi")
            .select("d", "k", "term", "pos").distinct())
    met = needed.join(held, ["d", "k", "term", "pos"])
    if slack:
        met = met.groupBy("window", "d", "k", "start", "rank").agg(F.first("size").alias("size"))
    whole = (met.groupBy("window", "d", "k", "start").agg(F.count(F.lit(1)).alias("n"), F.first("size").alias("size"))
             .filter(F.col("n") == F.col("size") - 2))
    columns = ["window", "d", "k", "start"]
    return (whole.select(*columns).unionByName(both.filter("size = 2").select(*columns))
            .unionByName(first.filter("size = 1").select(*columns)))


def phrases(index: DataFrame, cut: DataFrame, slack: int = 0) -> DataFrame:
    """(d, k, start, size, item): the stored matches of the items' windows."""
    own = small(cut.select("window", "item", F.size("terms").alias("size")))
    met = intersect(index, ranked_terms(index, cut), slack).join(own, "window")
    return stored(met.select("d", "k", "start", "size", "item"), "decontamination-phrases")


def covered(phrases: DataFrame) -> DataFrame:
    """(d, k, n_hit, items): words inside any phrase, and the sorted item ids."""
    spans = phrases.groupBy("d", "k", "start").agg(F.max(F.col("start") + F.col("size")).alias("end"))
    before = Window.partitionBy("d", "k").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.coalesce(F.max("end").over(before), F.lit(0))
    hit = (spans.withColumn("fresh", F.greatest(F.lit(0), F.col("end") - F.greatest("start", reached)))
           .groupBy("d", "k").agg(F.sum("fresh").cast("long").alias("n_hit")))
    items = phrases.groupBy("d", "k").agg(F.array_sort(F.collect_set("item")).alias("items"))
    return hit.join(items, ["d", "k"])


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_id_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
                  slack: int = 0, guard: SkewGuard = SkewGuard()) -> DataFrame:
    """(id, d, k, n_words, n_hit, items, contaminated[, near_items]) per row.

    ``d`` and ``k`` identify the row as ``id_order`` and ``text_key`` do. With
    ``slack``, near_items lists the items with a window all of whose words lie
    within that many words of their places.
    """
    cut = stored(windows(items, item_id_col, item_text_col, window), "decontamination-windows")
    index = postings(docs, cut.select(F.explode("terms").alias("term")), id_col, text_col)
    found = lengths(index).join(covered(phrases(index, cut)), ["d", "k"], "left")
    if slack:
        close = (phrases(index, cut, slack).groupBy("d", "k")
                 .agg(F.array_sort(F.collect_set("item")).alias("near_items")))
        found = found.join(close, ["d", "k"], "left")

    def key(d, k):
        return F.concat_ws(":", d, k)
    rows = docs.select(F.col(id_col).alias("id"), id_order(id_col).alias("d"), text_key(id_col, text_col).alias("k"))
    out = salted_left_join(rows.withColumn("dk", key("d", "k")), found.withColumn("dk", key("d", "k")).drop("d", "k"),
                           "dk", guard)
    none = F.array().cast("array<string>")
    near = [F.coalesce("near_items", none).alias("near_items")] if slack else []
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return out.select("id", "d", "k", F.coalesce("n_words", F.lit(0)).cast("long").alias("n_words"),
                      n_hit.alias("n_hit"), F.coalesce("items", none).alias("items"),
                      (n_hit > 0).alias("contaminated"), *near)


def clean_rows(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark window."""
    d, k = "__decontamination_id", "__decontamination_text"
    found = decontaminate(docs, items, id_col, text_col, **options)
    bad = found.filter("contaminated").select(F.col("d").alias(d), F.col("k").alias(k)).distinct()
    rows = docs.withColumns({d: id_order(id_col), k: text_key(id_col, text_col)})
    return rows.join(bad, [d, k], "left_anti").select(*named(docs.columns))
