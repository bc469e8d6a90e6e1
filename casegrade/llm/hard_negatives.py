"""Hard negatives by segment summaries.

Vectors are scaled to integers; a score is an integer inner product. Of a
segment of n components with means a, b and deviations s, t of two vectors, the
products sum to ``n (a b + r)`` with ``|r| <= s t``. So the summaries of the
segments, added up, bound a score from both sides.

1. ``summaries`` stores each vector with the means and deviations of its
   segments, at every level of ``LEVELS`` (few long segments, then more short
   ones). Rows that take no part are left out here.
2. ``best_in_band`` finds, for each query (an anchor with a band of scores), the
   best rows inside the band. A task compares a tile of rows with a tile of
   queries: pairs whose bounds miss the band, or lie below the query's k-th best
   score so far, are dropped level by level, and only the pairs that are left
   get their exact score. Bounds are widened by more than their rounding error.
3. A first search over every ``SEED_STEP``-th row (by a hash of the id) gives
   each query a score that its k-th best cannot fall below; the search over all
   rows starts from it, so tasks emit few rows more than the result holds. The
   tasks' rows are ranked by a window with a partial limit.
4. ``mine`` runs the search twice: the anchors' positives (same label, no band),
   then the negatives (other label) in the band of each positive.

Scale: anchors are read partition by partition and searched in blocks of at
most ``BLOCK_ANCHORS`` anchors and ``BLOCK_VALUES`` components, broadcast with
their positives; a block's positives are all that reaches the driver. All rows
are compared with all anchors, in blocks.

Defined cases: rows with a null label, a null vector, or a null or non-finite
component take no part, neither do empty vectors; of two vectors the shorter
counts as ended by zeros; scaled components are limited to 2^31 in magnitude;
rows that repeat are rows of their own, and a repeated anchor has its rows
again; a row with the anchor's id is no other row; null ids come last among
equal scores, and no anchor has one; fewer rows than asked for are all given;
empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import LAST_ID, id_order, stored

SCALE = 256.0
LEVELS = (4, 16)
POSITIVES = NEGATIVES = 5
#: A negative scores from 80 % of its positive's score to all of it.
LOW_PERCENT = 80
SEED_STEP = 32
BLOCK_ANCHORS = 8192
BLOCK_VALUES = 1 << 21
TILE_ROWS = 4096
TILE_QUERIES = 128
LIMIT = 2 ** 31
_LOWEST, _HIGHEST = -(2 ** 63), 2 ** 63 - 1
#: Share of a tile above which pairs are scored as one matrix product.
_DENSE_SHARE = 0.05


def scaled(values: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(SCALE * values), -LIMIT, LIMIT).astype(np.int64)


def segment_starts(width: int, segments: int) -> np.ndarray:
    return np.unique(np.arange(segments) * width // segments)


def summary(vectors: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Means and deviations of the segments of integer vectors (rows)."""
    starts = segment_starts(vectors.shape[1], segments)
    n = np.diff(np.r_[starts, vectors.shape[1]])
    values = vectors.astype(np.float64)
    mean = np.add.reduceat(values, starts, axis=1) / n
    values -= np.repeat(mean, n, axis=1)
    return mean, np.sqrt(np.add.reduceat(values * values, starts, axis=1) / n)


def summaries(rows: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(id, label, width, vector, means, deviations): the rows that take part.

    ``vector`` holds 64-bit integers, the others doubles, level after level.
    """
    values = F.col(vector_col).cast("array<double>")
    usable = F.col(label_col).isNotNull() & (F.size(values) > 0) & ~F.exists(
        values, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    given = rows.filter(usable).select(id_order(id_col).alias("id"), F.col(label_col).cast("long").alias("label"),
                                       values.alias("v"))
    names = ["id", "label", "width", "vector", "means", "deviations"]

    def task(batches):
        for batch in batches:
            lists = batch.column(2)
            flat = scaled(lists.flatten().to_numpy(zero_copy_only=False))
            widths = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.cumsum(widths)
            packed = [b""] * len(widths), [b""] * len(widths), [b""] * len(widths)
            for width in np.unique(widths).tolist():             # rows of one width together
                own = np.flatnonzero(widths == width)
                vectors = flat[(ends[own] - width)[:, None] + np.arange(width)]
                parts = [summary(vectors, s) for s in LEVELS]
                means, deviations = (np.concatenate([p[i] for p in parts], axis=1) for i in (0, 1))
                for place, v, m, s in zip(own.tolist(), vectors, means, deviations):
                    packed[0][place], packed[1][place], packed[2][place] = v.tobytes(), m.tobytes(), s.tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(widths.astype(np.int32)),
                 *(pa.array(p, pa.binary()) for p in packed)], names)
    return given.mapInArrow(task, "id bigint, label bigint, width int, vector binary, means binary, deviations binary")


def _matrix(packed: list[bytes], kind) -> np.ndarray:
    return np.frombuffer(b"".join(packed), kind).reshape(len(packed), -1)


class Rows:
    """Vectors of one width with their summaries.

    ``levels`` has the means and deviations of each level, times the root of the
    segments' lengths: a score is a product of means, give or take a product of
    deviations.
    """

    def __init__(self, ids, labels, vectors, means, deviations):
        self.ids, self.labels, self.vectors = ids, labels, vectors
        self.exact = vectors.astype(np.float64)
        self.largest = float(np.abs(self.exact).max(initial=0))
        self.norms = np.sqrt((self.exact * self.exact).sum(axis=1))
        self.levels, at = [], 0
        for segments in LEVELS:
            starts = segment_starts(vectors.shape[1], segments)
            root = np.sqrt(np.diff(np.r_[starts, vectors.shape[1]]))
            part = slice(at, at + len(starts))
            self.levels.append((means[:, part] * root, deviations[:, part] * root))
            at += len(starts)

    def take(self, at) -> Rows:
        out = object.__new__(Rows)
        out.ids, out.labels, out.vectors, out.exact = self.ids[at], self.labels[at], self.vectors[at], self.exact[at]
        out.largest, out.norms = self.largest, self.norms[at]
        out.levels = [(m[at], s[at]) for m, s in self.levels]
        return out


def rows_of(ids, labels, vectors: np.ndarray) -> Rows:
    parts = [summary(vectors, s) for s in LEVELS]
    return Rows(np.array(ids, np.int64), np.array(labels, np.int64), vectors,
                *(np.concatenate([p[i] for p in parts], axis=1) for i in (0, 1)))


def fitted(vectors: np.ndarray, width: int) -> np.ndarray:
    """Vectors cut, or ended by zeros, to a width; what is cut off meets zeros."""
    out = np.zeros((len(vectors), width), np.int64)
    n = min(width, vectors.shape[1])
    out[:, :n] = vectors[:, :n]
    return out


def scores(queries: Rows, rows: Rows, q: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Exact scores of pairs."""
    width = rows.vectors.shape[1]
    largest = queries.largest * rows.largest * width
    if largest >= 2 ** 62:                           # beyond 64 bits on the way
        found = (queries.vectors[q].astype(object) * rows.vectors[r].astype(object)).sum(axis=1)
        return np.array([min(max(s, _LOWEST), _HIGHEST) for s in found], np.int64)
    if largest >= 2 ** 53:
        return np.einsum("ij,ij->i", queries.vectors[q], rows.vectors[r])
    if len(q) > _DENSE_SHARE * len(queries.ids) * len(rows.ids):
        return (queries.exact @ rows.exact.T)[q, r].astype(np.int64)
    return np.einsum("ij,ij->i", queries.exact[q], rows.exact[r]).astype(np.int64)


def in_band(queries: Rows, rows: Rows, allowed: np.ndarray, low: np.ndarray, high: np.ndarray):
    """(query, row, score) of the allowed pairs whose score is from ``low`` to ``high`` of the query."""
    slack = 16 * 2.0 ** -53 * (rows.vectors.shape[1] + 16) * queries.norms.max(initial=0) * rows.norms.max(initial=0) + 1e-6
    least, most = low.astype(np.float64), high.astype(np.float64)
    least, most = least - slack - np.abs(least) * 2.0 ** -50, most + slack + np.abs(most) * 2.0 ** -50
    (qm, qs), (rm, rs) = queries.levels[0], rows.levels[0]
    middle, reach = qm @ rm.T, qs @ rs.T
    q, r = np.nonzero(allowed & (middle + reach >= least[:, None]) & (middle - reach <= most[:, None]))
    for (qm, qs), (rm, rs) in zip(queries.levels[1:], rows.levels[1:]):
        if len(q) > _DENSE_SHARE * allowed.size:
            middle, reach = (qm @ rm.T)[q, r], (qs @ rs.T)[q, r]
        else:
            middle, reach = np.einsum("ij,ij->i", qm[q], rm[r]), np.einsum("ij,ij->i", qs[q], rs[r])
        stay = (middle + reach >= least[q]) & (middle - reach <= most[q])
        q, r = q[stay], r[stay]
    found = scores(queries, rows, q, r)
    stay = (found >= low[q]) & (found <= high[q])
    return q[stay], r[stay], found[stay]


def first_of(group: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of each group's first ``k`` by score (falling), then id."""
    order = np.lexsort((ids, -score, group))
    start = np.flatnonzero(np.r_[True, np.diff(group[order]) != 0]) if len(order) else np.zeros(0, np.int64)
    rank = np.arange(len(order)) - np.repeat(start, np.diff(np.r_[start, len(order)]))
    return order[rank < k]


class Bands:
    """For each query, bands with a lowest and a highest score; the best k of each are sought.

    Arrays have one row per query and one column per band; an unused band ends
    below its start.
    """

    def __init__(self, low: np.ndarray, high: np.ndarray, same_label: bool, k: int):
        self.low, self.high, self.same_label, self.k = low, high, same_label, k


def _band_task(queries_shared, bands_shared):
    def task(batches):
        queries, bands = queries_shared.value, bands_shared.value
        n_bands, k = bands.low.shape[1], bands.k
        floor = bands.low.copy()                     # rises to each band's k-th best
        kept = tuple(np.zeros(0, np.int64) for _ in range(3))                  # query * n_bands + band, score, id
        by_width: dict[int, Rows] = {}
        for batch in batches:
            widths = batch.column(2).to_numpy(zero_copy_only=False)
            for width in np.unique(widths).tolist():
                own = batch.filter(pa.array(widths == width))
                if width not in by_width:
                    by_width[width] = rows_of(queries.ids, queries.labels, fitted(queries.vectors, width))
                for at in range(0, own.num_rows, TILE_ROWS):
                    part = own.slice(at, TILE_ROWS)
                    rows = Rows(part.column(0).to_numpy(), part.column(1).to_numpy(), *(
                        _matrix(part.column(i).to_pylist(), kind)
                        for i, kind in ((3, np.int64), (4, np.float64), (5, np.float64))))
                    found = [np.zeros((3, 0), np.int64)]
                    for q0 in range(0, len(queries.ids), TILE_QUERIES):
                        tile = slice(q0, q0 + TILE_QUERIES)
                        some = by_width[width].take(tile)
                        open_ = floor[tile] <= bands.high[tile]
                        low = np.where(open_, floor[tile], _HIGHEST).min(axis=1)
                        high = np.where(open_, bands.high[tile], _LOWEST).max(axis=1)
                        allowed = ((some.labels[:, None] == rows.labels) == bands.same_label) & (
                            some.ids[:, None] != rows.ids) & (low <= high)[:, None]
                        q, r, s = in_band(some, rows, allowed, low, high)
                        for band in range(n_bands):
                            fits = np.flatnonzero((s >= floor[tile][q, band]) & (s <= bands.high[tile][q, band]))
                            fits = fits[first_of(q[fits], s[fits], rows.ids[r[fits]], k)]
                            found.append(np.stack([(q[fits] + q0) * n_bands + band, s[fits], rows.ids[r[fits]]]))
                    kept = tuple(np.concatenate([old, new]) for old, new in zip(kept, np.concatenate(found, axis=1)))
                    best = first_of(*kept, k)
                    kept = tuple(column[best] for column in kept)
                    group, n = np.unique(kept[0], return_counts=True)
                    full = group[n == k]
                    floor.flat[full] = np.maximum(floor.flat[full], kept[1][np.cumsum(n) - 1][n == k])
        yield pa.RecordBatch.from_arrays([pa.array(kept[0] // n_bands), pa.array(kept[0] % n_bands),
                                          pa.array(kept[1]), pa.array(kept[2])], ["query", "band", "score", "id"])
    return task


def best_in_band(table: DataFrame, queries, bands: Bands) -> DataFrame:
    """(query, band, rank, score, id): the first ``bands.k`` rows of each band."""
    context = table.sparkSession.sparkContext
    columns = ["id", "label", "width", "vector", "means", "deviations"]

    def ranked(rows, low):
        shared = context.broadcast(Bands(low, bands.high, bands.same_label, bands.k))
        found = rows.select(*columns).mapInArrow(_band_task(queries, shared), "query bigint, band bigint, score bigint, id bigint")
        order = Window.partitionBy("query", "band").orderBy(F.col("score").desc(), "id")
        return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= bands.k)
    low = bands.low.copy()
    seed = table.filter(F.pmod(F.xxhash64(F.lit(5), "id"), F.lit(SEED_STEP)) == 0)
    for r in ranked(seed, bands.low).filter(F.col("rank") == bands.k).select("query", "band", "score").collect():
        low[r.query, r.band] = r.score
    return ranked(table, low)


def anchor_blocks(anchors: DataFrame) -> Iterator[tuple[list, list, list]]:
    """Blocks of (ids, labels, vectors) of the stored rows ``anchors``."""
    ids, labels, vectors, total = [], [], [], 0
    for row in anchors.select("id", "label", "vector").toLocalIterator():
        vector = np.frombuffer(row.vector, np.int64)
        ids.append(row.id)
        labels.append(row.label)
        vectors.append(vector)
        total += len(vector)
        if len(ids) >= BLOCK_ANCHORS or total >= BLOCK_VALUES:
            yield ids, labels, vectors
            ids, labels, vectors, total = [], [], [], 0
    if ids:
        yield ids, labels, vectors


def _of_block(table: DataFrame, ids, labels, vectors, positives: int, negatives: int, low_percent: int) -> DataFrame:
    spark = table.sparkSession
    width = max(map(len, vectors))
    shared = spark.sparkContext.broadcast(
        rows_of(ids, labels, np.concatenate([fitted(v[None, :], width) for v in vectors])))
    n = len(ids)
    everything = Bands(np.full((n, 1), _LOWEST), np.full((n, 1), _HIGHEST), True, positives)
    low, high = np.full((n, positives), _HIGHEST), np.full((n, positives), _LOWEST)
    found = best_in_band(table, shared, everything).collect()                # at most `positives` for each anchor
    for r in found:
        high[r.query, r["rank"] - 1] = r.score
        low[r.query, r["rank"] - 1] = -(-low_percent * r.score // 100)
    pairs = spark.createDataFrame([(r.query, r["rank"] - 1, ids[r.query], r.id, r.score) for r in found],
                                  "query bigint, band bigint, anchor_id bigint, positive_id bigint, positive_score bigint")
    hits = best_in_band(table, shared, Bands(low, high, False, negatives))
    null = F.lit(LAST_ID)
    return hits.join(F.broadcast(pairs), ["query", "band"]).select(
        "anchor_id", F.nullif(F.col("positive_id"), null).alias("positive_id"), "rank",
        F.nullif(F.col("id"), null).alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def mine(rows: DataFrame, is_anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding",
         label_col: str = "label", positives: int = POSITIVES, negatives: int = NEGATIVES,
         low_percent: int = LOW_PERCENT) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``is_anchor`` is a condition on the column ``id`` of the rows' ids.
    """
    table = stored(summaries(rows, id_col, vector_col, label_col), "negatives-summaries")
    out = None
    for ids, labels, vectors in anchor_blocks(table.filter(is_anchor & (F.col("id") != LAST_ID))):
        part = _of_block(table, ids, labels, vectors, positives, negatives, low_percent)
        out = part if out is None else out.unionByName(part)
    if out is None:
        names = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
        out = rows.sparkSession.createDataFrame([], T.StructType([
            T.StructField(c, T.IntegerType() if c == "rank" else T.LongType()) for c in names]))
    return out
