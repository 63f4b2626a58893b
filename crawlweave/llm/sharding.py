"""Sharding by jump consistent hashing, with gapless numbers inside each shard.

The shard follows from the key and the number of shards alone: there is no ring, no table and no shuffle. When one
shard is appended, a row either stays or moves into the new shard, which takes its fair part.

Rows with equal keys share a shard; so do all rows with a null key. A row's slot is its place in the shard in the
order of the input files. Slots come from counts per input partition: no window spans a whole shard, whatever the
shards' sizes. The narrow rows are written to the shared folder first, so that a repeated task finds the same order.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crawlweave.llm.common import fresh
from crawlweave.session import stage

#: Fixed values of the published algorithm: the multiplier of its generator and the scale of its fraction.
MULTIPLIER, SCALE = 2862933555777941757, float(1 << 31)


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each unsigned 64-bit key."""
    keys = keys.astype(np.uint64, copy=True)
    at, ahead = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
    moving = np.ones(len(keys), bool)
    while moving.any():
        at[moving] = ahead[moving]
        state = keys[moving] * np.uint64(MULTIPLIER) + np.uint64(1)
        keys[moving] = state
        steps = (at[moving] + 1) * (SCALE / ((state >> np.uint64(33)).astype(np.float64) + 1))
        ahead[moving] = np.minimum(steps, float(1 << 62)).astype(np.int64)
        moving = ahead < shards
    return at.astype(np.int32)


def shard_of(shards: int, *keys: Column) -> Column:
    """The shard of the key columns, 0 to ``shards - 1``."""
    if shards < 1:
        raise ValueError("at least one shard is needed")

    @F.arrow_udf("int")
    def place(hashes: pa.Array) -> pa.Array:
        return pa.array(jump(hashes.to_numpy(zero_copy_only=False).view(np.uint64), shards))

    return place(F.xxhash64(*keys))


def number(df: DataFrame, shard: str, slot: str = "slot") -> DataFrame:
    """``df`` with a number for each row of a shard, 0, 1, 2 and so on without a gap."""
    at, part, first = fresh(df, "_at"), fresh(df, "_part"), fresh(df, "_first")
    rows = stage(df.withColumn(at, F.monotonically_increasing_id()), "shards")
    rows = rows.withColumn(part, F.shiftright(at, 33))
    counts = rows.groupBy(shard, part).agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy(shard).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(shard, part, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias(first))
    within = Window.partitionBy(shard, part).orderBy(at)
    ranked = rows.withColumn(slot, F.row_number().over(within).cast("long"))
    return ranked.join(starts, [shard, part]).withColumn(slot, F.col(slot) + F.col(first) - 1).drop(at, part, first)


def write_shards(df: DataFrame, shard: str, path: str) -> None:
    """One folder per shard. Each task writes what it has of a shard, so a large shard has many files."""
    df.write.partitionBy(shard).parquet(path)
