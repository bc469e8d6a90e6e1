"""Connected components of an edge list, in Spark.

Each round does two things that keep connectivity:

* Blocks: the edges are dealt into blocks of about ``BLOCK_EDGES``; a task
  replaces a block's edges by stars, every node linked to the smallest node
  that it reaches inside the block. This never makes more edges.
* Stars, if there was more than one block: a large-star links every larger
  neighbour of a node to the smallest node around it, a small-star does the
  same for the smaller neighbours. They end in stars around the smallest node
  of each component; the number of rounds grows with the logarithm of the
  component size, not with its diameter.

An edge list that fits one block is done after the first step. A node with many
edges is no hot spot: its edges are dealt by both ends, and the minimum per
node is pre-aggregated. Each step is written to the shared folder, and two
numbers per round reach the driver.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

BLOCK_EDGES = 1 << 20


def least_reachable(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of the edges, and the smallest node that each reaches."""
    nodes, ends = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = ends[:len(u)], ends[len(u):]
    root = np.arange(len(nodes))
    while True:
        ra, rb = root[a], root[b]
        apart = ra != rb
        if not apart.any():
            return nodes, nodes[root]
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:                                  # every node straight to its root
            up = root[root]
            if (up == root).all():
                break
            root = up


def _contract(limit: int):
    def task(batches):
        u, v, n = [], [], 0

        def stars():
            nodes, root = least_reachable(np.concatenate(u), np.concatenate(v))
            out = nodes != root
            return pa.RecordBatch.from_arrays([pa.array(nodes[out]), pa.array(root[out])], ["u", "v"])
        for batch in batches:
            u.append(batch.column(0).to_numpy(zero_copy_only=False))
            v.append(batch.column(1).to_numpy(zero_copy_only=False))
            n += batch.num_rows
            if n >= 2 * limit:                       # a block far above the mean: in parts
                yield stars()
                u, v, n = [], [], 0
        if n:
            yield stars()
    return task


def _star(arcs: DataFrame) -> DataFrame:
    """Link each ``v`` around ``u`` to the smallest node of ``u``'s neighbourhood."""
    least = (arcs.groupBy("u").agg(F.min("v").alias("m"))
             .select(F.col("u").alias("mu"), F.least("u", "m").alias("m")))
    return arcs.join(least, F.col("u") == F.col("mu")).select("u", "v", "m")


def _star_round(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    large = (_star(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
             .filter("u != v").distinct())
    small = _star(large)                             # in `large` every u is above its v
    linked = (small.select(F.col("v").alias("u"), F.col("m").alias("v"))
              .unionByName(small.select("u", F.col("m").alias("v"))))
    return linked.filter("u != v").distinct()


def components(edges: DataFrame, block_edges: int = BLOCK_EDGES) -> DataFrame:
    """(node, component) for every node of the edges ``u``, ``v`` (longs).

    The component is its smallest node. Self loops and repeated edges are
    allowed; an empty edge list gives no rows.
    """
    def mark(df):
        row = df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        return tuple(row)
    edges = stored(edges.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                   .distinct(), "components")
    seen = mark(edges)
    while seen[0]:
        blocks = -(-seen[0] // block_edges)
        dealt = edges.repartition(1) if blocks == 1 else edges.repartition(blocks, "u", "v")
        edges = stored(dealt.mapInArrow(_contract(block_edges), "u bigint, v bigint"), "components")
        if blocks == 1:
            break
        edges = stored(_star_round(edges), "components")
        now = mark(edges)
        if now == seen:
            break
        seen = now
    return (edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct())
