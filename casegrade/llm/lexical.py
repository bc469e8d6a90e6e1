"""Ranked lexical search: exact best-first search in sparse ball trees.

A document is a sparse vector of saturated term frequencies over the terms of
the queries, a query is the vector of its terms' weights (times their repeats),
and the score is their inner product, an integer.

1. ``vectors``: one pass cuts every whole text into terms and stores, for each
   document, its length and the frequencies of query terms.
2. ``statistics``: documents, length and document frequencies over all of them,
   pre-aggregated in each task.
3. ``search``: each task builds a ball tree over blocks of its vectors. A node
   holds the centroid and the radius of its documents. For a query q, a
   document of the node scores at most ``q.c + |q'| r``, where q' is the query
   on the terms that occur in the node at all: a document differs from the
   centroid on these alone. Sums of n doubles are raised by more than their
   rounding error, so a bound is never below the largest score. Nodes are
   opened best bound first until the bound falls below the query's k-th best
   score so far, which a task carries from block to block; leaves are scored in
   integers.
4. The tasks' best k of each query are ranked by a window whose partial limit
   runs before the shuffle, first inside groups of tasks, then over them.

Memory: queries are read partition by partition and searched in blocks of at
most ``BLOCK_ITEMS`` items and about ``BLOCK_TERMS`` terms (one item at least),
which are broadcast. A task holds one block of ``BLOCK_ROWS`` documents.

Terms: maximal runs of ASCII letters, digits and characters above 0x7F, A-Z
lower-cased.

Defined cases: a null text has no term and ranks nowhere; a null or wordless
item has no rows; every row of the items is an item of its own, also with an id
that came before or is null, and every row of the documents a document; null
document ids come last among equal scores; scores of 0 are left out; empty
tables give no rows. 75 times the documents times a document's length has no
bound here, a score has 63 bits.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import LAST_ID, id_order, slices, stored

TOP = 10
BLOCK_ITEMS = 2000
BLOCK_TERMS = 200_000
BLOCK_ROWS = 8192
LEAF_ROWS = 48
MERGE_GROUPS = 64
#: Entries of a dense slice of centroids.
_DENSE = 1 << 21
_UNIT = 2.0 ** -53
#: ASCII letters in lower case and digits stay, other ASCII becomes a space.
_TERM_BYTES = bytes(b if b > 0x7F or chr(b).isdigit() or chr(b).islower() else b + 32 if chr(b).isupper() else 32
                    for b in range(256))


def terms_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_TERM_BYTES).split()


class Queries:
    """A block of items: their distinct terms, and the items' terms with repeats."""

    def __init__(self):
        self.ids: list = []
        self.terms: dict[bytes, int] = {}
        self.counts: list[Counter] = []

    def add(self, item_id, terms: list[bytes]) -> None:
        self.ids.append(item_id)
        self.counts.append(Counter(self.terms.setdefault(t, len(self.terms)) for t in terms))

    def full(self) -> bool:
        return len(self.ids) >= BLOCK_ITEMS or len(self.terms) >= BLOCK_TERMS


def query_blocks(items: DataFrame, id_col: str, text_col: str) -> Iterator[Queries]:
    block = Queries()
    for row in items.select(F.col(id_col), F.col(text_col).cast("binary")).toLocalIterator():
        terms = terms_of(row[1])
        if terms:
            block.add(row[0], terms)
        if block.full():
            yield block
            block = Queries()
    if block.ids:
        yield block


def vectors(docs: DataFrame, vocabulary, id_col: str, text_col: str) -> DataFrame:
    """(id, n, terms, tf): lengths and frequencies of the documents with a term.

    ``vocabulary`` is a broadcast dict of terms; ``terms`` and ``tf`` are packed
    32- and 64-bit integers in the order of the terms.
    """
    rows = docs.select(id_order(id_col).alias("id"), F.col(text_col).cast("binary").alias("t"))
    kinds = [("id", pa.int64()), ("n", pa.int64()), ("terms", pa.binary()), ("tf", pa.binary())]

    def task(batches):
        number = vocabulary.value.get
        for run in slices(batches, 1):
            out = []
            for d, t in zip(run.column(0).to_pylist(), run.column(1)):
                words = terms_of(t.as_py())
                if words:
                    held = np.array([k for k in map(number, words) if k is not None], np.int32)
                    which, tf = np.unique(held, return_counts=True)
                    out.append((d, len(words), which.tobytes(), tf.astype(np.int64).tobytes()))
            columns = zip(*out) if out else ([],) * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(columns, kinds)],
                                             [name for name, _ in kinds])
    return rows.mapInArrow(task, "id bigint, n bigint, terms binary, tf binary")


def statistics(found: DataFrame) -> tuple[int, int, dict[int, int]]:
    """Documents with a term, their length, and each query term's documents."""
    def task(batches):
        df, n_docs, length = np.zeros(0, np.int64), 0, 0
        for batch in batches:
            n_docs += batch.num_rows
            length += sum(batch.column(0).to_pylist())
            held = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.int32)
            seen = np.bincount(held, minlength=len(df)).astype(np.int64)
            seen[:len(df)] += df
            df = seen
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array([-1, -2, *some.tolist()], pa.int64()),
                                          pa.array([n_docs, length, *df[some].tolist()], pa.int64())], ["term", "n"])
    counted = found.select("n", "terms").mapInArrow(task, "term bigint, n bigint")
    total = {r.term: r.n for r in counted.groupBy("term").agg(F.sum("n").alias("n")).collect()}
    return total.pop(-1, 0), total.pop(-2, 0), total


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Block:
    """Documents as sparse rows: ids, and the values of each one's terms."""

    def __init__(self, ids, ptr, terms, values):
        self.ids, self.ptr, self.terms, self.values = ids, ptr, terms, values

    def take(self, rows: np.ndarray) -> Block:
        sizes = self.ptr[rows + 1] - self.ptr[rows]
        ptr = np.r_[0, np.cumsum(sizes)]
        at = np.arange(ptr[-1]) + np.repeat(self.ptr[rows] - ptr[:-1], sizes)
        return Block(self.ids[rows], ptr, self.terms[at], self.values[at])

    def dot(self, dense: np.ndarray) -> np.ndarray:
        """Inner products of the rows, each of which has a term, with a dense vector."""
        return np.add.reduceat(dense[self.terms] * self.values, self.ptr[:-1])


class Tree:
    """Ball tree over the rows of a block; inner nodes have two children."""

    def __init__(self, block: Block, n_terms: int, leaf_rows: int = LEAF_ROWS):
        self.n_terms, self.leaf_rows = n_terms, leaf_rows
        self.children: list[tuple[int, int] | None] = []
        self.leaves: list[Block | None] = []
        self.centroids: list[tuple[np.ndarray, np.ndarray]] = []       # terms of the node, and their means
        self.radius: list[float] = []
        self._grow(block)

    def _grow(self, rows: Block) -> int:
        node = len(self.radius)
        n = len(rows.ids)
        values = rows.values.astype(np.float64)
        centre = np.bincount(rows.terms, values, self.n_terms) / n
        support = np.flatnonzero(np.bincount(rows.terms, minlength=self.n_terms))
        square = np.add.reduceat(values * values, rows.ptr[:-1])
        across = rows.dot(centre)
        whole = float(centre @ centre)
        # the three terms cancel: what their rounding may hide is added
        slack = 8 * _UNIT * (len(support) + n + 8) * (square + whole + 2 * across)
        away = np.maximum(square + whole - 2 * across, 0) + slack
        self.centroids.append((support, centre[support]))
        self.radius.append(math.sqrt(float(away.max())) * (1 + 4 * _UNIT))
        self.children.append(None)
        self.leaves.append(None)
        if n <= self.leaf_rows:
            self.leaves[node] = rows
            return node
        far = int(away.argmax())                     # split along the line from the centroid to the farthest row
        line = -centre
        own = slice(rows.ptr[far], rows.ptr[far + 1])
        line[rows.terms[own]] += values[own]
        order = np.argsort(rows.dot(line), kind="stable")
        halves = [rows.take(np.sort(part)) for part in (order[:n // 2], order[n // 2:])]
        del rows, values, centre, line
        self.children[node] = self._grow(halves[0]), self._grow(halves[1])
        return node

    def bounds(self, ptr: np.ndarray, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """(nodes, queries): no document of the node scores higher.

        The queries are sparse rows, none of them empty.
        """
        weights = weights.astype(np.float64)
        out = np.empty((len(self.radius), len(ptr) - 1))
        step = max(1, _DENSE // max(1, self.n_terms))
        for at in range(0, len(out), step):
            part = self.centroids[at:at + step]
            means, held = np.zeros((len(part), self.n_terms)), np.zeros((len(part), self.n_terms), bool)
            for i, (support, mean) in enumerate(part):
                means[i, support], held[i, support] = mean, True
            middle = np.add.reduceat(means[:, terms] * weights, ptr[:-1], axis=1)
            reach = np.sqrt(np.add.reduceat(held[:, terms] * (weights * weights), ptr[:-1], axis=1))
            out[at:at + step] = middle + reach * np.array(self.radius[at:at + step])[:, None]
        longest = int(np.diff(ptr).max()) + len(self.leaves) + 16
        return out * (1 + 16 * _UNIT * longest) + 1

    def search(self, bounds: np.ndarray, dense: np.ndarray, best: list[tuple[int, int]], k: int) -> list[tuple[int, int]]:
        """The best ``k`` of ``best`` and the tree's documents, as (-score, id), for one query."""
        queue = [(-bounds[0], 0)]
        while queue:
            bound, node = heapq.heappop(queue)
            if len(best) == k and -bound < -best[-1][0]:
                break
            if self.children[node]:
                for child in self.children[node]:
                    heapq.heappush(queue, (-bounds[child], child))
                continue
            leaf = self.leaves[node]
            scores = leaf.dot(dense)
            good = np.flatnonzero(scores >= (-best[-1][0] if len(best) == k else 1))
            if len(good):
                best = sorted([*best, *zip((-scores[good]).tolist(), leaf.ids[good].tolist())])[:k]
        return best


def _search_task(shared, k: int):
    def task(batches):
        n_docs, length, ptr, terms, weights, n_terms = shared.value
        best: list[list] = [[] for _ in ptr[1:]]
        dense = np.zeros(n_terms, np.int64)

        def look(ids, sizes, held, values):
            sizes = np.array(sizes)
            tree = Tree(Block(np.array(ids, np.int64), np.r_[0, np.cumsum(sizes)], np.concatenate(held),
                              np.concatenate(values)), n_terms)
            bounds = tree.bounds(ptr, terms, weights)
            for i, (a, b) in enumerate(zip(ptr[:-1], ptr[1:])):
                dense[terms[a:b]] = weights[a:b]
                best[i] = tree.search(bounds[:, i], dense, best[i], k)
                dense[terms[a:b]] = 0
        ids, sizes, held, values = [], [], [], []
        for batch in batches:
            for d, n, t, tf in zip(*(c.to_pylist() for c in batch.columns)):
                tf = np.frombuffer(tf, np.int64)
                m = 25 + 75 * n * n_docs // length               # in integers of any size
                # 8 m above 10^9 tf leaves 0 in any case
                value = 10 ** 9 * tf // (1000 * tf + min(8 * m, 1 << 62))
                some = value > 0
                if some.any():
                    ids.append(d)
                    held.append(np.frombuffer(t, np.int32)[some])
                    values.append(value[some])
                    sizes.append(len(values[-1]))
                if len(ids) == BLOCK_ROWS:
                    look(ids, sizes, held, values)
                    ids, sizes, held, values = [], [], [], []
        if ids:
            look(ids, sizes, held, values)
        rows = [(i, -s, d) for i, found in enumerate(best) for s, d in found]
        columns = zip(*rows) if rows else ([],) * 3
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["item", "score", "id"])
    return task


def best_of(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The ``k`` best rows (score, then id) of each key, with their rank."""
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _block_results(docs: DataFrame, block: Queries, id_col: str, text_col: str, item_type: T.DataType, k: int) -> DataFrame:
    spark = docs.sparkSession
    context = spark.sparkContext
    found = stored(vectors(docs, context.broadcast(block.terms), id_col, text_col), "lexical-vectors")
    n_docs, length, df = statistics(found)
    weights = {t: weight(n_docs, n) for t, n in df.items()}
    rows = [(i, sorted((t, r * weights[t]) for t, r in own.items() if weights.get(t)))
            for i, own in enumerate(block.counts)]
    rows = [(i, own) for i, own in rows if own]                  # the others score 0 everywhere
    ids = spark.createDataFrame([(j, block.ids[i]) for j, (i, _) in enumerate(rows)],
                                T.StructType([T.StructField("item", T.LongType()), T.StructField("item_id", item_type)]))
    flat = [pair for _, own in rows for pair in own]
    ptr = np.r_[0, np.cumsum([len(own) for _, own in rows])].astype(np.int64)
    shared = context.broadcast((n_docs, length, ptr, np.array([t for t, _ in flat], np.int64),
                                np.array([w for _, w in flat], np.int64), len(block.terms)))
    if not rows:
        found = found.limit(0)
    hits = found.mapInArrow(_search_task(shared, k), "item bigint, score bigint, id bigint")
    hits = hits.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(MERGE_GROUPS)))
    ranked = best_of(best_of(hits, ["item", "part"], k).drop("rank", "part"), ["item"], k)
    return ranked.join(F.broadcast(ids), "item").select(
        "item_id", "rank", F.nullif(F.col("id"), F.lit(LAST_ID)).alias("doc_id"), "score")


def search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           item_id_col: str = "item_id", item_text_col: str = "text", top: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` documents of each item."""
    kind = items.select(F.col(item_id_col)).schema.fields[0].dataType
    out = None
    for block in query_blocks(items, item_id_col, item_text_col):
        part = _block_results(docs, block, id_col, text_col, kind, top)
        out = part if out is None else out.unionByName(part)
    if out is None:
        schema = T.StructType([T.StructField("item_id", kind), T.StructField("rank", T.IntegerType()),
                               T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())])
        out = docs.sparkSession.createDataFrame([], schema)
    return out
