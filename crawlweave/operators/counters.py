"""Crawl statistics."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crawlweave.functions import urls
from crawlweave.operators.prefix import running_total, trailing_count
from crawlweave.operators.skew import dimension_join

# Reach of the crawl rate, and of the recent activity per depth (end excluded).
RATE_WINDOW_MS = 30_000
RECENT_MS = 5_000


def depth_counts(log: DataFrame, *keys: str) -> DataFrame:
    """Pages per depth, ascending."""
    by = [*keys, "depth"]
    return log.groupBy(*by).agg(F.count(F.lit(1)).alias("pages")).orderBy(*by)


def unique_hosts(log: DataFrame, *keys: str) -> DataFrame:
    """Distinct lower-case hosts; an address that does not parse counts as a host of its own.

    Two-step: distinct hosts first, so no task gathers all hosts of a hot key.
    """
    hosts = log.select(*keys, urls.live_host(F.col("url")).alias("host")).where(F.col("host") != "").distinct()
    return hosts.groupBy(*keys).agg(F.count(F.lit(1)).alias("unique_hosts"))


def rate(count: Column, active_s: Column, window_ms: int = RATE_WINDOW_MS) -> Column:
    seconds = F.least(F.lit(window_ms // 1000), F.greatest(F.lit(1), F.floor(active_s)))
    return F.round(count / seconds, 1)


def rolling_rate(
    log: DataFrame, clock: str = "t_ms", crawl: str = "crawl_id", windows: Mapping[str, int] | None = None
) -> DataFrame:
    """Pages per second over trailing windows at each page of each crawl.

    ``windows`` maps a column name to milliseconds; each adds the rate and, as ``<name>_n``, the
    count. The divisor is the window, or the active seconds so far if those are fewer (at least
    one). A column ``active_ms`` is used if present, else the time since the crawl's first page; a
    true column ``paused`` gives 0.0.
    """
    rows, active = log, F.col("active_ms") / 1000
    if "active_ms" not in log.columns:
        begin = log.groupBy(crawl).agg(F.min(clock).alias("__begin"))
        rows = dimension_join(log, begin, crawl, clock)
        active = (F.col(clock) - F.col("__begin")) / 1000
    for name, reach in (windows or {"rate": RATE_WINDOW_MS}).items():
        rows = trailing_count(rows, [crawl], clock, reach, f"{name}_n", counted=log)
        value = rate(F.col(f"{name}_n"), active, reach)
        if "paused" in log.columns:
            value = F.when(F.col("paused"), F.lit(0.0)).otherwise(value)
        rows = rows.withColumn(name, value)
    return rows.drop("__begin")


def activity(log: DataFrame, clock: str = "t_ms", window_ms: int = RECENT_MS) -> DataFrame:
    """Per page: pages of its depth so far in the recent window and the derived speed bounds."""
    # the window excludes its far end
    recent = trailing_count(log, ["depth"], clock, window_ms - 1, "recent")
    top = F.least(F.lit(6.0), F.lit(0.5) + F.log(F.col("recent") + 1) * 1.8)
    return recent.withColumns(
        {"max_speed": F.round(top, 6), "min_speed": F.round(F.greatest(F.lit(0.3), top * 0.15), 6)}
    )


def depth_size(pages: Column) -> Column:
    """Display size of a depth that holds ``pages`` pages."""
    return F.round(F.greatest(F.lit(16.0), F.least(F.lit(56.0), F.lit(14.0) + F.log(pages + 1) * 9)), 6)


def in_flight(spans: DataFrame, crawl: str, start: str, end: str, seq: str, width: int = 60_000) -> DataFrame:
    """Requests in flight after each dispatch (+1) and each end (-1), ends first on equal clocks."""
    moves = spans.select(
        crawl,
        seq,
        F.inline(
            F.array(
                F.struct(F.col(start).alias("at_ms"), F.lit(1).alias("delta")),
                F.struct(F.col(end).alias("at_ms"), F.lit(-1).alias("delta")),
            )
        ),
    )
    bucket = F.floor(F.col("at_ms") / F.lit(width)).cast("bigint")
    return running_total(
        moves, [crawl], ["at_ms", "delta", seq], bucket, {"in_flight": F.col("delta").cast("bigint")}
    )


def sink_errors(results: DataFrame, keys: tuple[str, ...], batch: str, failed: Column) -> DataFrame:
    """Errors per batch, their running sum and the alert on the change from zero to more."""
    per_batch = results.groupBy(*keys, batch).agg(F.count_if(failed).alias("errors"))
    before = Window.partitionBy(*keys).orderBy(batch).rowsBetween(Window.unboundedPreceding, -1)
    earlier = F.coalesce(F.sum("errors").over(before), F.lit(0))
    return per_batch.withColumns(
        {"total_errors": earlier + F.col("errors"), "alert": (earlier == 0) & (F.col("errors") > 0)}
    )


# The counters of a stats record in its order, and the state that each one counts, where it counts one.
STATS_FIELDS = ["queue", "inFlight", "rejected", "failed", "robotsBlocked", "processed", "kafkaErrors"]
_STATES = {"queue": "queued", "inFlight": "in_flight", "failed": "failed", "robotsBlocked": "robots_blocked", "processed": "processed"}


def state_total(field: str, weight: Column | None = None) -> Column:
    """Rows of the ``state`` that a counter counts; none for the counters that other tables give."""
    one = F.lit(1) if weight is None else weight
    return F.sum(F.when(F.col("state") == F.lit(_STATES.get(field)), one).otherwise(0)).cast("bigint")


def stats_json() -> Column:
    return F.to_json(F.struct(*STATS_FIELDS))


def stats_row(
    log: DataFrame,
    duplicates: DataFrame | None = None,
    sink_error_rows: DataFrame | None = None,
    rows: Column | None = None,
) -> DataFrame:
    """Counters of each crawl and the same as one JSON record in fixed field order.

    ``log`` is the ``crawl_id, state`` of every accepted address, or counts of them in ``rows``;
    ``duplicates`` and ``sink_error_rows`` add ``duplicates`` and ``errors`` per crawl.
    """
    joined = log.groupBy("crawl_id").agg(*[state_total(c, rows).alias(c) for c in _STATES])
    for extra, value, name in ((duplicates, "duplicates", "rejected"), (sink_error_rows, "errors", "kafkaErrors")):
        if extra is None:
            joined = joined.withColumn(name, F.lit(0).cast("bigint"))
        else:
            joined = joined.join(extra.groupBy("crawl_id").agg(F.sum(value).alias(name)), "crawl_id", "left")
    filled = joined.fillna(0, ["rejected", "kafkaErrors"])
    return filled.select("crawl_id", *STATS_FIELDS, stats_json().alias("stats"))


def state_json(start_ms: Column, end_ms: Column, seed: Column, paused: Column) -> Column:
    """Crawl state record ``startMs, endMs, seedUrl, paused``.

    Only backslash, quote, line feed and carriage return are escaped in the seed.
    """
    text = seed
    for raw, escaped in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r")):
        text = F.replace(text, F.lit(raw), F.lit(escaped))
    return F.concat(
        F.lit('{"startMs":'), start_ms.cast("string"), F.lit(',"endMs":'), end_ms.cast("string"),
        F.lit(',"seedUrl":"'), text, F.lit('","paused":'), paused.cast("string"), F.lit("}"),
    )
