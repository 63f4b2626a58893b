"""Join of many rows to one row per key when a few keys hold most of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPLITS = 1024


def dimension_join(facts: DataFrame, dimension: DataFrame, key: str, spread_by: str) -> DataFrame:
    """Left join ``facts`` to ``dimension`` (unique on ``key``) without a hot task.

    One plan for every size: rows without a key, which match nothing, are spread by a hash of
    ``spread_by``; a key that holds too many rows is split by adaptive execution, which measures the
    partitions, splits the fact side of a large one and reads the few dimension rows once per part.
    Nothing is listed, limited or broadcast by hand.
    """
    spread = F.when(F.col(key).isNull(), F.pmod(F.xxhash64(F.col(spread_by)), F.lit(SPLITS)).cast("int")).otherwise(0)
    facts = facts.withColumn("__shard", spread)
    return facts.join(dimension.withColumn("__shard", F.lit(0)), [key, "__shard"], "left").drop("__shard")
