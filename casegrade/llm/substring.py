"""Substring dedup: repeated fixed-length word windows, removed as maximal intervals.

Every window of ``WINDOW`` consecutive words gets a Rabin-Karp hash: a
polynomial over 64-bit word hashes, rolled along the text. The windows are
counted in Spark:

1. Each task hashes blocks of documents and pre-aggregates: of a window that
   several documents of the block hold, only the smallest document's
   occurrences go on; the others are known repeats already. So a passage that a
   third of all documents share costs one entry per block, not per document.
2. The rest is dealt out by ranges of a second hash (``repartitionById``). An entry is the
   hash, the document and the position, packed per (block, range) as arrays.
   Each range finds the smallest document of every hash; occurrences in larger
   documents are repeats.
3. Repeats are dealt out by document, packed likewise, and gathered to one row
   per document, which meets its text again; overlapping and touching windows
   merge into maximal intervals, and the covered words go.

A window is repeated if the same word sequence starts in a document with a
smaller id; all windows are judged on the input. Windows are equal if their
64-bit hashes are and they lie in one range of the second hash, so the ranges
add bits: of n windows in P ranges, n^2 / (2^65 P) false matches are expected.
With 3 million windows to a range that is under one in 10^13 windows. Both
hashes rest on the 64-bit hashes of the words: v different words give another
v^2 / 2^65 pairs of words that count as equal.

Memory: a task holds one block (``BLOCK_WORDS`` words or one document) or one
range; there is a range for every ``RANGE_BYTES`` of measured text, at least.

Defined cases: a null text has no words; a text shorter than a window has no
windows; null ids come after all others and null-id rows do not remove each
other; rows of one id do not remove each other; equal rows get equal results;
an empty table gives no rows. Words are separated by ASCII white space.
"""

from __future__ import annotations

from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_order, map_arrow, named, shuffle_partitions, slices, text_key

WINDOW = 13
BLOCK_WORDS = 1 << 20
RANGE_BYTES = 32 << 20
BASE = np.uint64(0x9E3779B97F4A7C15)
_CACHE_WORDS = 300_000

#: Entries of one target partition, as arrays: runs of entries of a document
#: (docs, keys, counts), positions inside the documents (at), and the hashes,
#: or null where the entries are known to be repeats.
_PACKED = "part int, docs binary, keys binary, counts binary, at binary, hashes binary"


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= _CACHE_WORDS:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


def window_hashes(words: np.ndarray, window: int) -> np.ndarray:
    """Rabin-Karp hashes of all windows of an array of word hashes."""
    n = len(words) - window + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for j in range(window):
        h = h * BASE + words[j:j + n]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def range_hashes(words: np.ndarray, window: int) -> np.ndarray:
    """Hashes of the same windows that do not depend on ``window_hashes``."""
    mixed = words ^ (words >> np.uint64(29))
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(32)
    return window_hashes(mixed, window)


def _planes(values: np.ndarray) -> bytes:
    """Unsigned integers as byte planes: the planes of leading zeros compress away."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes()


def _unplanes(data: bytes, kind: str) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, -1).T).view(kind).ravel()


def _steps(doc: np.ndarray, at: np.ndarray) -> bytes:
    """Positions as differences inside each document's run."""
    step = at.astype(np.uint32)
    same = np.flatnonzero(doc[1:] == doc[:-1]) + 1
    step[same] -= at[same - 1].astype(np.uint32)
    return _planes(step)


def _positions(step: np.ndarray, counts: np.ndarray) -> np.ndarray:
    total = np.cumsum(step, dtype=np.int64)
    first = np.cumsum(counts) - counts
    return total - np.repeat(np.where(first > 0, total[first - 1], 0), counts)


def _runs(doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    first = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]]) if len(doc) else np.zeros(0, np.int64)
    return first, np.diff(np.r_[first, len(doc)])


def _by_part(part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stable order by part, and the parts in that order."""
    order = np.argsort(part.astype(np.uint16) if part.max(initial=0) < 65536 else part, kind="stable")
    return order, part[order]


def _spread(ids: np.ndarray, keys: np.ndarray, parts: int) -> np.ndarray:
    """The part that gathers a document's repeats."""
    mixed = (ids.astype(np.uint64) ^ (keys.astype(np.uint64) << np.uint64(32))) * BASE
    return ((mixed >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _packed(part, doc, ids, keys, at, hashes=None):
    """One row per part: ``doc`` numbers the documents of ``ids`` and ``keys``,
    entries lie by document and position."""
    order, part = _by_part(part)
    for i, n in zip(*_runs(part)):
        e = order[i:i + n]
        first, counts = _runs(doc[e])
        own = doc[e[first]]
        yield (int(part[i]), _planes(ids[own]), _planes(keys[own].astype(np.uint32)),
               _planes(counts.astype(np.uint32)), _steps(doc[e], at[e]), None if hashes is None else hashes[e].tobytes())


def _unpacked(d, k, c, a):
    counts = _unplanes(c, "uint32").astype(np.int64)
    return _unplanes(d, "int64"), _unplanes(k, "uint32"), counts, _positions(_unplanes(a, "uint32"), counts)


def _block_rows(ids, keys, texts, parts: int, window: int):
    """Packed rows of one block; ``texts`` are arrays of word hashes."""
    order = np.argsort(ids, kind="stable")
    ids, keys = ids[order], keys[order]
    texts = [texts[i] for i in order]
    found = [window_hashes(t, window) for t in texts]
    h = np.concatenate(found) if found else np.zeros(0, np.uint64)
    if not len(h):
        return
    sizes = np.array([len(f) for f in found])
    del found
    deal = np.concatenate([range_hashes(t, window) for t in texts])
    doc = np.repeat(np.arange(len(sizes)), sizes)
    at = np.arange(len(h)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    by_hash = np.argsort(h, kind="stable")                     # inside a hash: by document, then position
    ordered = h[by_hash]
    differs = np.r_[True, ordered[1:] != ordered[:-1]]
    del ordered
    same = np.flatnonzero(~differs)
    differs[same] = deal[by_hash[same]] != deal[by_hash[same - 1]]
    first = np.flatnonzero(differs)
    count = np.diff(np.r_[first, len(h)])
    least = np.repeat(ids[doc[by_hash[first]]], count)
    known = np.zeros(len(h), bool)
    known[by_hash] = ids[doc[by_hash]] > least
    again, rest = np.flatnonzero(known), np.flatnonzero(~known)
    if len(again):                                             # repeats inside the block
        yield from _packed(_spread(ids, keys, parts)[doc[again]], doc[again], ids, keys, at[again])
    part = ((deal[rest] >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
    yield from _packed(part, doc[rest], ids, keys, at[rest], h[rest])


def _batches(rows, size: int = 1000):
    kinds = [pa.int32()] + [pa.binary()] * 5
    names = ["part", "docs", "keys", "counts", "at", "hashes"]
    while some := list(islice(rows, size)):
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*some), kinds)], names)


def _hash_task(parts: int, window: int):
    def task(batches):
        hashes, ids, keys, texts, total, seen = _WordHashes(), [], [], [], 0, set()

        def flush():
            return _batches(_block_rows(np.array(ids, np.int64), np.array(keys, np.int64), texts, parts, window))
        for run in slices(batches, 2):
            for d, k, t in zip(run.column(0).to_pylist(), run.column(1).to_pylist(), run.column(2)):
                if (d, k) in seen:                   # an equal row: its repeats are found once
                    continue
                words = (t.as_py() or b"").split()
                if len(words) < window:
                    continue
                seen.add((d, k))
                ids.append(d)
                keys.append(k)
                texts.append(np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words)))
                total += len(words)
                if total >= BLOCK_WORDS:
                    yield from flush()
                    ids, keys, texts, total, seen = [], [], [], 0, set()
        yield from flush()
    return task


def _range_task(parts: int):
    def task(batches):
        """Repeats among the entries of the range; those known before pass through."""
        hashes, docs, keys, at, runs = [], [], [], [], []
        for batch in batches:
            known = batch.filter(pc.is_null(batch.column(5)))
            if known.num_rows:
                yield known
            for _, d, k, c, a, h in zip(*(col.to_pylist() for col in batch.columns)):
                if h is not None:
                    d, k, c, a = _unpacked(d, k, c, a)
                    hashes.append(np.frombuffer(h, np.uint64))
                    docs.append(d)
                    keys.append(k)
                    runs.append(c)
                    at.append(a.astype(np.uint32))
        if not hashes:
            return
        h, counts = np.concatenate(hashes), np.concatenate(runs)
        hashes.clear()
        owner = np.repeat(np.arange(len(counts), dtype=np.int32), counts)
        ids, own_keys, position = np.concatenate(docs), np.concatenate(keys), np.concatenate(at)
        at.clear()
        by_hash = np.argsort(h)
        _, n = _runs(h[by_hash])
        by_hash, n = by_hash[np.repeat(n > 1, n)], n[n > 1]
        del h
        if not len(n):
            return
        doc = ids[owner[by_hash]]
        hit = by_hash[doc > np.repeat(np.minimum.reduceat(doc, np.cumsum(n) - n), n)]
        hit = hit[np.lexsort((position[hit], own_keys[owner[hit]], ids[owner[hit]]))]
        yield from _batches(_packed(_spread(ids, own_keys, parts)[owner[hit]], owner[hit], ids, own_keys, position[hit]))
    return task


def _gather_task(batches):
    """One row per document with all of its repeats' positions."""
    docs, keys, at = [], [], []
    for batch in batches:
        for d, k, c, a in zip(*(batch.column(i).to_pylist() for i in range(1, 5))):
            d, k, c, a = _unpacked(d, k, c, a)
            docs.append(np.repeat(d, c))
            keys.append(np.repeat(k, c))
            at.append(a.astype(np.uint32))
    if not docs:
        return
    doc, key, at = np.concatenate(docs), np.concatenate(keys), np.concatenate(at)
    order = np.lexsort((at, key, doc))
    doc, key, at = doc[order], key[order], at[order]
    other = np.r_[True, (doc[1:] != doc[:-1]) | (key[1:] != key[:-1]) | (at[1:] != at[:-1])]
    doc, key, at = doc[other], key[other], at[other]           # positions of equal rows: once
    first = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (key[1:] != key[:-1])])
    ends = np.r_[first[1:], len(doc)]
    for i in range(0, len(first), 2000):
        rows = [(doc[b], key[b], _steps(doc[b:e], at[b:e])) for b, e in zip(first[i:i + 2000], ends[i:i + 2000])]
        d, k, a = zip(*rows)
        yield pa.RecordBatch.from_arrays([pa.array(d, pa.int64()), pa.array(k, pa.int64()), pa.array(a, pa.binary())],
                                         ["d", "k", "starts"])


def n_ranges(docs: DataFrame, text_col: str) -> int:
    """Ranges of about ``RANGE_BYTES`` of text each, as many as shuffle partitions at least."""
    total = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    return max(shuffle_partitions(docs.sparkSession), -(-total // RANGE_BYTES))


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
            parts: int | None = None) -> DataFrame:
    """(d, k, starts): the repeated window starts of each document that has any.

    ``d`` and ``k`` identify rows as ``id_order`` and ``text_key`` do; ``starts``
    is the packed list of positions.
    """
    parts = parts or n_ranges(docs, text_col)
    rows = docs.select(id_order(id_col).alias("d"), text_key(id_col, text_col).alias("k"),
                       F.col(text_col).cast("binary").alias("t"))
    packed = rows.mapInArrow(_hash_task(parts, window), _PACKED)
    found = packed.repartitionById(parts, F.col("part")).mapInArrow(_range_task(parts), _PACKED)
    return found.repartitionById(parts, F.col("part")).mapInArrow(_gather_task, "d bigint, k bigint, starts binary")


def intervals(starts: np.ndarray, window: int) -> np.ndarray:
    """Maximal [begin, end) word intervals covered by windows at ``starts``."""
    starts = np.unique(starts)
    if not len(starts):
        return np.zeros((0, 2), np.int64)
    first = np.flatnonzero(np.r_[True, starts[1:] > starts[:-1] + window])
    last = np.r_[first[1:], len(starts)] - 1
    return np.stack([starts[first], starts[last] + window], axis=1)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                   keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (all by default, without the text) with the outcome.

    Adds n_words, n_removed, removed (maximal word intervals, end exclusive)
    and kept_text (the words left, one space apart).
    """
    keep = [c for c in docs.columns if c != text_col] if keep is None else list(keep)
    clash = {"n_words", "n_removed", "removed", "kept_text"} & set(keep)
    if clash:
        raise ValueError(f"output columns exist already: {sorted(clash)}")
    carried = list(dict.fromkeys([*keep, text_col]))
    rows = docs.select(id_order(id_col).alias("__d"), text_key(id_col, text_col).alias("__k"), *named(carried))
    found = repeats(docs, id_col, text_col, window).select(
        F.col("d").alias("__rd"), F.col("k").alias("__rk"), F.col("starts").alias("__starts"))
    met = rows.join(found, (F.col("__d") == F.col("__rd")) & (F.col("__k") == F.col("__rk")), "left").select(
        F.col(text_col).cast("binary").alias("__t"), "__starts", *named(keep))
    names = [*keep, "n_words", "n_removed", "removed", "kept_text"]
    out = met.select(*named(keep)).withColumns({
        "n_words": F.lit(0).cast("long"), "n_removed": F.lit(0).cast("long"),
        "removed": F.expr("cast(array() as array<struct<begin:bigint,end:bigint>>)"), "kept_text": F.lit("")})
    span = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))

    def cut(batches):
        for run in slices(batches, 0):
            n_words, n_removed, removed, kept = [], [], [], []
            for t, packed in zip(run.column(0), run.column(1).to_pylist()):
                words = (t.as_py() or b"").split()
                spans = np.zeros((0, 2), np.int64)
                if packed:
                    spans = intervals(np.cumsum(_unplanes(packed, "uint32"), dtype=np.int64), window)
                left, at = [], 0
                for begin, end in spans.tolist():
                    left += words[at:begin]
                    at = end
                left += words[at:]
                n_words.append(len(words))
                n_removed.append(len(words) - len(left))
                removed.append([{"begin": b, "end": e} for b, e in spans.tolist()])
                kept.append(b" ".join(left).decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays(
                [*run.columns[2:], pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                 pa.array(removed, span), pa.array(kept, pa.string())], names)
    return map_arrow(met, cut, out.schema)
