"""Crawl statistics per interval, published while the stream runs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from crawlweave.operators.counters import STATS_FIELDS, state_total, stats_json
from crawlweave.operators.prefix import block, running_total
from crawlweave.session import new_path
from crawlweave.streaming.feed import BatchTable

TICK_MS = 1_000


@dataclass
class LiveStats:
    """A running stream and what it has published so far."""

    query: StreamingQuery
    sink: BatchTable
    interval_ms: int

    def rows(self) -> DataFrame:
        """One record per crawl and interval from its first to its last event: the counters at the end of the interval.

        The stream writes what each micro-batch adds to each interval, and every tick sums what came before it. Intervals without events
        repeat the counters, as a timer would. A late row changes the records from its interval on.
        """
        sums = self.sink.all().groupBy("crawl_id", "tick").agg(*[F.sum(c).alias(c) for c in STATS_FIELDS])
        ends = sums.groupBy("crawl_id").agg(F.min("tick").alias("first"), F.max("tick").alias("last"))
        ticks = ends.select("crawl_id", F.explode(F.sequence("first", "last")).alias("tick"))
        every = ticks.join(sums, ["crawl_id", "tick"], "left").fillna(0, STATS_FIELDS)
        total = running_total(every.withColumnsRenamed({c: f"new_{c}" for c in STATS_FIELDS}), ["crawl_id"], ["tick"], block("tick"), {c: F.col(f"new_{c}") for c in STATS_FIELDS})
        at = ((F.col("tick") + 1) * self.interval_ms).alias("until_ms")
        return total.select("crawl_id", at, *[F.col(c).cast("bigint").alias(c) for c in STATS_FIELDS]).withColumn("stats", stats_json())


def start_stats(
    feed: DataFrame, state: str | Column = "state", clock: str = "t_ms", interval_ms: int = TICK_MS, trigger: dict | None = None,
    path: str | None = None, checkpoint: str | None = None,
) -> LiveStats:
    """Start counting ``feed`` (``crawl_id``, a state, a clock in milliseconds) and return at once.

    The stream keeps no state: each micro-batch writes its counts per crawl and interval, and writing one again replaces it.
    """
    spark = feed.sparkSession
    schema = ", ".join(["crawl_id bigint", "tick bigint", *[f"{c} bigint" for c in STATS_FIELDS]])
    sink = BatchTable(spark, "live-stats", schema, path)
    tick = F.floor(F.col(clock) / interval_ms).cast("bigint").alias("tick")
    kind = (F.col(state) if isinstance(state, str) else state).alias("state")

    def step(batch: DataFrame, batch_id: int) -> None:
        rows = batch.select(F.col("crawl_id").cast("bigint").alias("crawl_id"), tick, kind).where("tick is not null")
        counts = rows.groupBy("crawl_id", "tick").agg(*[state_total(c).alias(c) for c in STATS_FIELDS])
        sink.write(counts, batch_id)

    writer = feed.writeStream.option("checkpointLocation", checkpoint or new_path(spark, "stream-checkpoint"))
    query = writer.foreachBatch(step).trigger(**(trigger or {"processingTime": f"{interval_ms} milliseconds"})).start()
    return LiveStats(query, sink, interval_ms)
