"""As-of join: each row meets the latest version of its key that is not after it."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crawlweave.session import stage

_OTHER, _PART, _PLACE = "__other_", "__part", "__place"


def placed_by_range(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], label: str) -> DataFrame:
    """``df`` staged in range partitions over (keys, order), with ``__part`` and ``__place``, its place in that order.

    The partitions are cut by numbers of rows, so one huge key fills many of them, and a window over (part, key)
    never spans more than one.
    """
    sorted_rows = df.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    placed = stage(sorted_rows.withColumn(_PLACE, F.monotonically_increasing_id()), label)
    return placed.withColumn(_PART, F.shiftright(_PLACE, 33))


def met_on(df: DataFrame, found: DataFrame, by: Sequence[str], how: str = "left") -> DataFrame:
    """Join on ``by``, in which a missing key meets a missing key."""
    other = found.withColumnsRenamed({c: _OTHER + c for c in by})
    match = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(_OTHER + c)) for c in by])
    return df.join(other, match, how).drop(*[_OTHER + c for c in by])


def asof_join(
    rows: DataFrame, versions: DataFrame, keys: Sequence[str], clock: str, since: str, payload: Sequence[str]
) -> DataFrame:
    """``rows`` with ``since`` and the ``payload`` columns of the latest version with ``since <= clock``; null if none.

    Rows and versions are put in one order and cut into range partitions by number of rows, so a key that holds a third of all rows
    is many partitions. Inside a partition the last version above a row is its version; the last version of
    each partition and key is carried to the partitions behind it, over one row per partition and key. So the work is one
    sort, whatever the skew. Of versions with equal key and ``since`` the one whose payload sorts last counts. Rows without
    clock, or with a key that has no version yet, get nulls; keys may be null and meet null.
    """
    keys, value = list(keys), F.struct(F.col(since), *payload)
    left = rows.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.col(clock).cast("bigint").alias("__at"), F.struct(*rows.columns).alias("__row"))
    right = versions.where(F.col(since).isNotNull()).select(
        *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.col(since).cast("bigint").alias("__at"), value.alias("__version")
    )
    by = [f"__k{i}" for i in range(len(keys))]
    # a version comes before the rows of its tick; rows without clock come first of all and so meet nothing
    both = left.unionByName(right, allowMissingColumns=True).withColumn("__kind", F.col("__row").isNotNull())
    placed = placed_by_range(both, by, ["__at", "__kind", "__version"], "as-of")
    latest = F.max(F.when(F.col("__version").isNotNull(), F.struct(_PLACE, "__version")))
    ends = placed.groupBy(_PART, *by).agg(latest.alias("__end"))
    before = Window.partitionBy(*by).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    carry = ends.select(_PART, *by, F.last("__end.__version", ignorenulls=True).over(before).alias("__carry"))
    local = Window.partitionBy(_PART, *by).orderBy(_PLACE).rowsBetween(Window.unboundedPreceding, 0)
    seen = placed.withColumn("__here", F.last("__version", ignorenulls=True).over(local)).where("__kind")
    met = met_on(seen, carry, [_PART, *by])
    return met.select("__row.*", F.coalesce("__here", "__carry").alias("__found")).select(*rows.columns, *[F.col(f"__found.{c}").alias(c) for c in (since, *payload)])
