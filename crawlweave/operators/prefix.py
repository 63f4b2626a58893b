"""Ordered running values that do not need one task per key.

A plain window over ``partitionBy(key)`` puts all rows of a key into one task. Here the ordered
rows of a key are cut into buckets. Each bucket is first reduced to one row (with map-side
combine), the running value over those few rows is the carry into each bucket, and the row-level
window only spans one bucket. The result equals the plain window.

``bucket`` must never decrease along ``order`` within a key, e.g. ``seq div 65536``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crawlweave.session import stage

BUCKET = "__bucket"
_OTHER = "__other_"
ROWS_PER_BUCKET = 65_536


def block(order: str | Column, width: int = ROWS_PER_BUCKET) -> Column:
    """Bucket of an integer ordering column."""
    column = F.col(order) if isinstance(order, str) else order
    return F.floor(column / F.lit(width)).cast("bigint")


def join_back(df: DataFrame, found: DataFrame, by: Sequence[str]) -> DataFrame:
    """Inner join on ``by`` in which a missing key meets a missing key, so no row of ``df`` is lost."""
    other = found.withColumnsRenamed({c: _OTHER + c for c in by})
    match = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(_OTHER + c)) for c in by])
    return df.join(other, match).drop(*[_OTHER + c for c in by])


def _with_carry(df: DataFrame, keys: Sequence[str], bucket: Column, reduced: Mapping[str, Column], carried: Mapping[str, Column]):
    marked = df.withColumn(BUCKET, bucket)
    by = [*keys, BUCKET]
    per_bucket = marked.groupBy(*by).agg(*[c.alias(n) for n, c in reduced.items()])
    carry = per_bucket.select(*by, *[c.alias(f"__carry_{n}") for n, c in carried.items()])
    return join_back(marked, carry, by), by


def _earlier(keys: Sequence[str]):
    return Window.partitionBy(*keys).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)


def _local(by: Sequence[str], order: Sequence[str], exclusive: bool):
    end = -1 if exclusive else Window.currentRow
    return Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, end)


def running_total(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    bucket: Column,
    values: Mapping[str, Column],
    exclusive: bool = False,
    firsts: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Add one running sum per entry of ``values``; ``exclusive`` leaves the row itself out.

    Each entry of ``firsts`` adds the value of the key's very first row.
    """
    firsts = firsts or {}
    before = _earlier(keys)
    reduced = {f"__v_{n}": F.sum(v) for n, v in values.items()}
    carried = {n: F.coalesce(F.sum(f"__v_{n}").over(before), F.lit(0)) for n in values}
    for n, v in firsts.items():
        reduced[f"__v_{n}"] = F.min_by(v, F.struct(*order))
        carried[n] = F.first(f"__v_{n}").over(before)
    rows, by = _with_carry(df, keys, bucket, reduced, carried)
    local = _local(by, order, exclusive)
    added = {n: F.col(f"__carry_{n}") + F.coalesce(F.sum(v).over(local), F.lit(0)) for n, v in values.items()}
    opening = _local(by, order, False)
    added |= {n: F.coalesce(F.col(f"__carry_{n}"), F.first(v).over(opening)) for n, v in firsts.items()}
    return rows.withColumns(added).drop(BUCKET, *[f"__carry_{n}" for n in added])


def row_rank(df: DataFrame, keys: Sequence[str], order: Sequence[str], bucket: Column, name: str) -> DataFrame:
    """Rank 1..n per key in the given order (the order must be total)."""
    return running_total(df, keys, order, bucket, {name: F.lit(1).cast("bigint")})


def carry_forward(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    bucket: Column,
    values: Mapping[str, Column],
    exclusive: bool = False,
) -> DataFrame:
    """Add, per entry of ``values``, its latest non-null value up to (or strictly before) the row."""
    reduced, carried = {}, {}
    before = _earlier(keys)
    for n, v in values.items():
        latest = F.max(F.when(v.isNotNull(), F.struct(*[F.col(o) for o in order], v.alias("__value"))))
        reduced[f"__v_{n}"] = latest["__value"]
        carried[n] = F.last(f"__v_{n}", ignorenulls=True).over(before)
    rows, by = _with_carry(df, keys, bucket, reduced, carried)
    local = _local(by, order, exclusive)
    found = {n: F.coalesce(F.last(v, ignorenulls=True).over(local), F.col(f"__carry_{n}")) for n, v in values.items()}
    return rows.withColumns(found).drop(BUCKET, *[f"__carry_{n}" for n in values])


def trailing_count(
    df: DataFrame,
    keys: Sequence[str],
    clock: str,
    reach: int,
    name: str,
    width: int | None = None,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Rows of the same key whose ``clock`` lies in ``[clock - reach, clock]``.

    Rows are counted per clock tick first, so a burst collapses to one row. Each tick adds its rows
    at its clock and takes them away one step after it left the window; the running sum of both is
    the count, so the work does not depend on ``reach``. Rows without a clock get 0.
    ``counted`` may name the rows to count if ``df`` is a wider form of them.
    """
    ticks = (df if counted is None else counted).where(F.col(clock).isNotNull()).groupBy(*keys, clock).agg(F.count(F.lit(1)).alias("__n"))
    changes = F.array(
        F.struct(F.col(clock).alias("at"), F.col("__n").alias("change"), F.lit(1).alias("tick")),
        F.struct((F.col(clock) + F.lit(reach + 1)).alias("at"), (-F.col("__n")).alias("change"), F.lit(0).alias("tick")),
    )
    moments = (
        ticks.select(*keys, F.inline(changes))
        .groupBy(*keys, "at")
        .agg(F.sum("change").alias("change"), F.max("tick").alias("tick"))
    )
    summed = running_total(moments, keys, ["at"], block("at", width or ROWS_PER_BUCKET), {name: F.col("change")})
    counts = summed.where("tick = 1").select(*keys, F.col("at").alias(clock), name)
    other = counts.withColumnsRenamed({c: _OTHER + c for c in (*keys, clock)})
    match = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(_OTHER + c)) for c in (*keys, clock)])
    met = df.join(other, match, "left").drop(*[_OTHER + c for c in (*keys, clock)])
    return met.withColumn(name, F.coalesce(name, F.lit(0).cast("bigint")))


def number_by_range(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str, label: str, start: DataFrame | None = None
) -> DataFrame:
    """Dense ordinal 1..n per key in the given order, for any order columns and any skew.

    Range partitions over (keys, order) split even a single huge key; the staged table fixes each
    row's place, and one row per (partition, key) turns places into ordinals. ``start`` may give
    the last ordinal already used per key in its column ``used``; its other columns are added.
    """
    extra = [] if start is None else [c for c in start.columns if c not in (*keys, "used")]
    by = ["__part", *keys]
    placed = (
        df.repartitionByRange(*keys, *order)
        .sortWithinPartitions(*keys, *order)
        .withColumn("__place", F.monotonically_increasing_id())
    )
    placed = stage(placed, label).withColumn("__part", F.shiftright("__place", 33))
    runs = placed.groupBy(*by).agg(F.count(F.lit(1)).alias("__size"), F.min("__place").alias("__first"))
    before = Window.partitionBy(*keys).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("__size").over(before), F.lit(0))
    if start is not None:
        other = start.withColumnsRenamed({c: _OTHER + c for c in keys})
        match = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(_OTHER + c)) for c in keys], F.lit(True))
        runs = runs.join(other, match, "left").drop(*[_OTHER + c for c in keys])
        offset = offset + F.coalesce("used", F.lit(0))
    shift = runs.select(*by, *extra, (offset - F.col("__first") + 1).alias("__shift"))
    return join_back(placed, shift, by).withColumn(name, F.col("__place") + F.col("__shift")).drop(
        "__part", "__place", "__shift"
    )
