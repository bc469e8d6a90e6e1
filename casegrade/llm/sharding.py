"""Sharding by jump consistent hashing (law ``key``).

A row's shard is a function of its key and the number of shards alone: the
key's 64-bit hash seeds a linear congruential generator whose draws are the
shard counts at which the key would move. There is no ring table, and with one
more shard a key either stays or moves into the new shard.

``slot`` numbers the rows of each shard from 0 without gaps. It is a two-level
count: rows are dealt to blocks by the hash of a stored row number and ranked
inside (shard, block), and the blocks' offsets come from a table of shards x
blocks counts. So no task ever holds a whole shard, also if a third of all rows
are equal.

Defined cases: a null key is a key like any other (all null keys share a
shard); equal rows get different slots of the same shard; an empty table gives
no rows; other columns are carried along untouched.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import shuffle_partitions, stored

#: Fixed values of the published algorithm: the generator's multiplier, and
#: 2**31 over the generator's upper bits as the draw.
MULTIPLIER = 2862933555777941757
DRAWS = 2 ** 31


def jump_hash(keys: np.ndarray, n_shards: int) -> np.ndarray:
    """Shard (0 to n_shards - 1) of each unsigned 64-bit key."""
    if n_shards < 1:
        raise ValueError("n_shards must be at least 1")
    state = keys.astype(np.uint64)
    shard = np.zeros(len(state), np.int64)
    upcoming = np.zeros(len(state), np.int64)
    live = np.arange(len(state))
    while len(live):
        shard[live] = upcoming[live]
        state[live] = state[live] * np.uint64(MULTIPLIER) + np.uint64(1)
        draw = (state[live] >> np.uint64(33)).astype(np.float64) + 1.0
        upcoming[live] = np.floor((shard[live] + 1) * (DRAWS / draw)).astype(np.int64)
        live = live[upcoming[live] < n_shards]
    return shard.astype(np.int32)


def shard_of(key_hash: Column, n_shards: int) -> Column:
    """Column form of :func:`jump_hash` over a 64-bit hash column."""
    @F.pandas_udf("int")
    def jump(keys: pd.Series) -> pd.Series:
        return pd.Series(jump_hash(keys.to_numpy(np.int64).view(np.uint64), n_shards))
    return jump(key_hash)


def add_slots(df: DataFrame, shard_col: str, row_col: str, slot_col: str, blocks: int | None = None) -> DataFrame:
    """Number the rows of each ``shard_col`` value 0, 1, 2, ... in ``slot_col``.

    ``row_col`` is a stored number of the row, different for every row: rows are
    dealt to blocks by its hash, so equal rows spread like others.
    """
    blocks = blocks or shuffle_partitions(df.sparkSession)
    block, base = "__slot_block", "__slot_base"
    rows = df.withColumn(block, F.pmod(F.xxhash64(F.lit(7), row_col), F.lit(blocks)).cast("int"))
    counts = rows.groupBy(shard_col, block).agg(F.count(F.lit(1)).alias("__slot_n"))
    before = Window.partitionBy(shard_col).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select(F.col(shard_col).alias("__slot_shard"), F.col(block).alias("__slot_b"),
                          F.coalesce(F.sum("__slot_n").over(before), F.lit(0)).alias(base))
    within = Window.partitionBy(shard_col, block).orderBy(row_col)
    return (rows.withColumn("__slot_rank", F.row_number().over(within) - 1)
            .join(bases, (F.col(shard_col) == F.col("__slot_shard")) & (F.col(block) == F.col("__slot_b")))
            .withColumn(slot_col, F.col(base) + F.col("__slot_rank"))
            .drop(block, base, "__slot_rank", "__slot_shard", "__slot_b"))


def shard_rows(df: DataFrame, key_col: str, n_shards: int, shard_col: str = "shard", slot_col: str = "slot",
               grown_col: str = "grown_shard") -> DataFrame:
    """``df`` with shard, gapless slot and the shard under ``n_shards + 1``.

    The rows are written once with their shards and row numbers.
    """
    clash = {shard_col, slot_col, grown_col} & set(df.columns)
    if clash:
        raise ValueError(f"output columns exist already: {sorted(clash)}")
    key_hash = F.xxhash64(F.lit(3), F.col(key_col))
    rows = df.withColumns({shard_col: shard_of(key_hash, n_shards), grown_col: shard_of(key_hash, n_shards + 1),
                           "__slot_row": F.monotonically_increasing_id()})
    return add_slots(stored(rows, "sharding-rows"), shard_col, "__slot_row", slot_col).drop("__slot_row")
