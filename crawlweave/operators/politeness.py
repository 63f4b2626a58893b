"""Host politeness: throttling of a request log and a slot plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crawlweave.operators.asof import met_on, placed_by_range
from crawlweave.operators.prefix import block, running_total
from crawlweave.operators.spacing import greedy_spacing

# Fixed value: delay of a host without a crawl delay of its own.
DEFAULT_DELAY_MS = 500


def effective_delay(crawl_delay_ms: Column, default_ms: int = DEFAULT_DELAY_MS) -> Column:
    return F.when(crawl_delay_ms > 0, crawl_delay_ms).otherwise(F.lit(default_ms).cast("bigint"))


def throttle(requests: DataFrame, clock: str, delay: Column, order: str, host: str = "host") -> DataFrame:
    """Add ``granted``, ``last_grant`` and ``wait``; a request without a host is granted at once."""
    return greedy_spacing(requests, [host], clock, delay, order)


def deferred(throttled: DataFrame, clock: str) -> DataFrame:
    """Requests to put back without another look at the seen set, with their earliest time."""
    waiting = throttled.where(F.col("wait") > 0)
    return waiting.withColumn("not_before", F.col(clock) + F.col("wait"))


def slot_plan(pages: DataFrame, delay: Column, order: str, host: str = "host", start_ms: int = 0) -> DataFrame:
    """Earliest start of every page if a host's pages are requested as early as allowed, in order.

    The first request of a host goes at ``start_ms`` and each later one waits its own delay. A page without a host waits
    for none: it is the first of its own.
    """
    rows = pages.withColumn("__delay", delay.cast("bigint"))
    totals = running_total(
        rows,
        [host],
        [order],
        block(order),
        {"slot": F.lit(1).cast("bigint"), "__total": F.col("__delay")},
        firsts={"__first": F.col("__delay")},
    )
    alone = F.col(host).isNull()
    at = F.lit(start_ms) + F.when(alone, 0).otherwise(F.col("__total") - F.col("__first"))
    slot = F.when(alone, 1).otherwise(F.col("slot")).cast("bigint")
    return totals.withColumns({"slot": slot, "planned_ms": at}).drop("__delay", "__total", "__first")


def dispatch_times(requests: DataFrame, clock: str, gap: Column, order: str, host: str = "host") -> DataFrame:
    """Add ``granted_ms``: when each request runs if those that come too early wait for their turn, first come first served.

    A request runs at the later of its clock and the run before it plus its own gap. With ``G`` the running sum of
    gaps, that is ``G`` plus the running maximum of ``clock - G``, so it is a prefix operation: the ordered rows are cut into range
    partitions, which split even one huge host; each part is reduced to its sum of gaps and its maximum, the carry into
    a part comes from those few rows, and the row-level windows span one part of one host. A request without a host
    runs at its clock. ``order`` breaks ties; clocks must not be null.
    """
    rows = requests.withColumn("__gap", F.greatest(gap.cast("bigint"), F.lit(1)))
    placed = placed_by_range(rows, [host], [clock, order], "turns")
    by = ["__part", host]
    local = Window.partitionBy(*by).orderBy("__place").rowsBetween(Window.unboundedPreceding, 0)
    summed = placed.withColumn("__sum", F.sum("__gap").over(local)).withColumn("__slack", F.col(clock) - F.col("__sum"))
    parts = summed.where(F.col(host).isNotNull()).groupBy(*by).agg(F.max("__sum").alias("__size"), F.max("__slack").alias("__most"))
    before = Window.partitionBy(host).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("__base", F.coalesce(F.sum("__size").over(before), F.lit(0)))
    carry = parts.withColumn("__carry", F.max(F.col("__most") - F.col("__base")).over(before)).select(*by, "__base", "__carry")
    most = F.greatest(F.max("__slack").over(local), F.col("__carry") + F.col("__base"))
    granted = F.when(F.col(host).isNull(), F.col(clock)).otherwise(F.col("__sum") + most)
    return met_on(summed, carry, by).withColumn("granted_ms", granted).select(*requests.columns, "granted_ms")
