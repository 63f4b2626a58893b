"""Range join of points and intervals, and the intervals in which a crawl is in one state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crawlweave.operators.asof import met_on, placed_by_range
from crawlweave.operators.lifecycle import lifecycle_states

#: Clock units of a bin: an hour of milliseconds.
BIN = 3_600_000


def overlap_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], left_span: tuple[str, str], right_span: tuple[str, str], width: int = BIN
) -> DataFrame:
    """Pairs of rows with equal keys whose half-open spans ``[start, end)`` overlap; inner join.

    A span is split over the bins it touches, so that pairs meet by an equality and a key with a third of all rows is as many groups as it has
    bins. A pair that shares several bins counts in one, the later of its two first bins. An empty span overlaps nothing, and
    neither does one with a null; keys may be null and meet null. Columns of ``right`` that ``left`` has too are left out.
    """
    (a, b), (c, d) = left_span, right_span
    first = lambda start: F.floor(F.col(start) / width)

    def binned(df: DataFrame, start: str, end: str, mark: str) -> DataFrame:
        spans = df.where(F.col(start) < F.col(end)).withColumn(mark, first(start))
        return spans.withColumn("__bin", F.explode(F.sequence(F.col(mark), F.floor((F.col(end) - 1) / width))))

    ones = binned(left, a, b, "__first")
    extra = [x for x in right.columns if x not in left.columns]
    others = binned(right, c, d, "__other_first").select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], "__bin", "__other_first", F.col(c).alias("__start"), F.col(d).alias("__end"), *extra)
    met = ones.withColumnRenamed("__bin", "__at")
    match = F.col("__at") == F.col("__bin")
    for i, k in enumerate(keys):
        match = match & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    joined = met.join(others, match & (F.col(a) < F.col("__end")) & (F.col("__start") < F.col(b)))
    return joined.where(F.col("__at") == F.greatest("__first", "__other_first")).select(*left.columns, *extra)


def point_join(points: DataFrame, intervals: DataFrame, keys: Sequence[str], clock: str, span: tuple[str, str], width: int = BIN) -> DataFrame:
    """Points with each interval of their key they fall into: ``start <= clock < end``. A point is in one bin, so nothing repeats."""
    spans = points.withColumn("__until", F.col(clock) + 1)
    return overlap_join(spans, intervals, keys, (clock, "__until"), span, width).drop("__until")


def state_intervals(log: DataFrame, crawl: str = "crawl_id", clock: str = "t_ms", tie: str = "event_id") -> DataFrame:
    """``crawl``, ``state``, ``start_ms``, ``end_ms``: the stretches of each crawl's life in one state, the last without end (null).

    Changes of state are few beside the log; the next change of each is found over range partitions, so a crawl with very many of them
    is many partitions.
    """
    changes = lifecycle_states(log, crawl, clock, tie).where(F.col("state") != F.col("state_before")).select(crawl, "state", clock, tie)
    placed = placed_by_range(changes, [crawl], [clock, tie], "changes")
    by = ["__part", crawl]
    firsts = placed.groupBy(*by).agg(F.min_by(clock, "__place").alias("__next"))
    after = Window.partitionBy(crawl).orderBy("__part").rowsBetween(1, 1)
    behind = firsts.select(*by, F.max("__next").over(after).alias("__behind"))
    local = Window.partitionBy(*by).orderBy("__place")
    found = met_on(placed.withColumn("__here", F.lead(clock).over(local)), behind, by)
    return found.select(crawl, "state", F.col(clock).alias("start_ms"), F.coalesce("__here", "__behind").alias("end_ms"))
