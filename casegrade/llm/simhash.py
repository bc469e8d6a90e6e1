"""SimHash near-duplicates by multi-index hashing.

Fingerprint: texts with A-Z lower-cased, words between ASCII white space,
three-word shingles (repeats count), XXH64 of each shingle; a bit is set if it
is set in over half of the shingle hashes. Fewer words than a shingle are one
shingle, no words give fingerprint zero.

Search, over *distinct* fingerprints (copies collapse first):

* A fingerprint has two 32-bit segments. Two fingerprints at distance 2 or less
  differ by at most one bit in one of the segments, so each probes the segment
  tables with its segments' Hamming balls of radius 1 (only flips that set a
  bit: of two values one bit apart, one reaches the other by setting it).
* A matched fingerprint links if the complete distance is 2 or less.
* A segment value held by over ``HOT_SEGMENT`` fingerprints would pair all of
  them. Fingerprints that reach such a value are instead grouped by the 65
  points within one bit of the whole fingerprint: any two within distance 2
  share such a point, and any two that share one are within distance 2, so
  linking each group to its smallest member gives exactly the same components.
  A group has 65 members at most.

Components are found by star rounds (components.py). Fingerprints, links and
components stay in Spark.

Defined cases: a null text has no words (fingerprint zero, linked like any
other); rows of one id are separate rows; null ids never name a component
unless all of its ids are null; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.skew import SkewGuard, salted_left_join
from .common import id_order, map_arrow, named, slices, stored, text_key
from .components import components

SHINGLE_WORDS = 3
MAX_DISTANCE = 2
SEED = 42
HOT_SEGMENT = 64
_BLOCK = 1 << 17
_LOW = 0xFFFFFFFF


def fingerprint(text: bytes | None, width: int = SHINGLE_WORDS) -> int:
    words = (text or b"").lower().split()        # bytes: ASCII case and ASCII white space only
    if not words:
        return 0
    n = max(1, len(words) - width + 1)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, _BLOCK):               # bounded memory on very long texts
        part = words[at:at + _BLOCK + width - 1] if len(words) >= width else words
        grams = map(b" ".join, zip(*(part[j:] for j in range(width)))) if len(words) >= width else [b" ".join(words)]
        digests = b"".join([xxhash.xxh64_digest(g, SEED) for g in grams])
        bits = np.unpackbits(np.frombuffer(digests, np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big")


def with_fingerprints(docs: DataFrame, id_col: str, text_col: str, width: int = SHINGLE_WORDS,
                      keep: list[str] = ()) -> DataFrame:
    """(id, fp) and the ``keep`` columns: the fingerprint is a signed long."""
    rows = docs.select(F.col(text_col).cast("binary").alias("t"), F.col(id_col).alias("id"), *named(keep))
    out = rows.drop("t").withColumn("fp", F.lit(0).cast("long"))
    names = out.columns

    def task(batches):
        for run in slices(batches, 0):
            fps = np.array([fingerprint(t.as_py(), width) for t in run.column(0)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*run.columns[1:], pa.array(fps)], names)
    return map_arrow(rows, task, out.schema)


def _segments() -> list[Column]:
    fp = F.col("fp")
    return [fp.bitwiseAND(F.lit(_LOW)), F.shiftrightunsigned(fp, 32)]


def _segment_key(number: int, value: Column) -> Column:
    return F.shiftleft(F.lit(number).cast("long"), 32).bitwiseOR(value)


def links(fps: DataFrame, hot_segment: int = HOT_SEGMENT) -> DataFrame:
    """Edges (u, v) whose components are those of all pairs at distance <= 2.

    ``fps`` has one distinct long column ``fp``.
    """
    low, high = _segments()
    table = fps.select("fp", F.explode(F.array(_segment_key(0, low), _segment_key(1, high))).alias("key"))

    def ball(value: Column) -> Column:
        flips = [value.bitwiseOR(F.lit(1 << i)) for i in range(32)]
        return F.array_distinct(F.array(value, *flips))
    probes = fps.select("fp", F.explode(F.concat(
        F.transform(ball(low), lambda v: _segment_key(0, v)),
        F.transform(ball(high), lambda v: _segment_key(1, v)))).alias("key"))
    hot = stored(table.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > hot_segment)
                 .select(F.col("key").alias("hot_key")), "simhash-hot")
    met = F.col("key") == F.col("hot_key")
    apart = F.bit_count(F.col("u").bitwiseXOR(F.col("v")))
    pairs = (probes.join(hot, met, "left_anti").select(F.col("fp").alias("u"), F.col("key").alias("probe"))
             .join(table.join(hot, met, "left_anti").select(F.col("fp").alias("v"), "key"),
                   F.col("probe") == F.col("key"))
             .filter((F.col("u") != F.col("v")) & (apart <= MAX_DISTANCE)).select("u", "v"))
    around = F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit((1 << i) - (1 << 64) * (i == 63))) for i in range(64)])
    stars = (probes.join(hot, met, "left_semi").select("fp").distinct()
             .select("fp", F.explode(around).alias("point"))
             .groupBy("point").agg(F.collect_set("fp").alias("members")).filter(F.size("members") > 1)
             .select(F.array_min("members").alias("u"), F.explode("members").alias("v")).filter("u != v"))
    return pairs.unionByName(stars)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    width: int = SHINGLE_WORDS, keep: list[str] = ()) -> DataFrame:
    """(id, fp, component) and the ``keep`` columns: one row per input row.

    ``component`` is the smallest id reachable over links, itself included.
    """
    rows = stored(with_fingerprints(docs, id_col, text_col, width, keep), "simhash-fp")
    classes = stored(rows.groupBy("fp").agg(F.min("id").alias("least_id")), "simhash-classes")
    member = components(links(classes.select("fp")))
    grouped = stored(classes.join(member, F.col("fp") == F.col("node"), "left").select(
        "fp", "least_id", F.coalesce("component", "fp").alias("root")), "simhash-roots")
    roots = grouped.groupBy("root").agg(F.min("least_id").alias("component"))
    of_class = salted_left_join(grouped, roots, "root", SkewGuard()).select(          # a component may hold most classes
        F.col("fp").alias("class_fp"), "component")
    return rows.join(of_class, F.col("fp") == F.col("class_fp")).select("id", "fp", "component", *named(keep))


def first_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are the smallest of their component.

    Smallest is by id, null ids last, then by a hash of the text; of rows equal
    in both, one stays.
    """
    d, k = "__simhash_id", "__simhash_text"
    rows = docs.withColumns({d: id_order(id_col), k: text_key(id_col, text_col)})
    found = near_duplicates(rows, d, text_col, keep=[k])
    firsts = (found.groupBy("component").agg(F.min(F.struct("id", k)).alias("first"))
              .select(F.col("first.id").alias(d), F.col(f"first.{k}").alias(k)))
    return rows.join(firsts, [d, k], "left_semi").dropDuplicates([d, k]).select(*named(docs.columns))


def hex_fingerprint(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
