"""Crawl lifecycle: idle -> running <-> paused -> finished, and the time that counts as active."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlweave.operators.prefix import carry_forward, running_total

# Ordered values are carried over in steps of this many milliseconds.
STEP_MS = 60_000


def _state(phase: str, opened: str, paused: str):
    return (
        F.when(F.col(phase) == "start", F.when(F.col(paused), "paused").otherwise("running"))
        .when((F.col(phase) == "end") & (F.col(opened) == "start"), "finished")
        .otherwise("idle")
    )


def lifecycle_states(
    log: DataFrame, crawl: str = "crawl_id", clock: str = "t_ms", tie: str = "event_id", width: int = STEP_MS
) -> DataFrame:
    """Add ``state_before`` and ``state`` to every row of ``log(crawl, clock, tie, action)``.

    Actions: ``start``, ``pause``, ``resume``, ``end``, ``clear``; others change nothing. Pause and
    resume count only while a crawl is active. A start in an active crawl restarts its clock; a
    start of an idle or finished one begins unpaused. An end before any start leaves it idle.
    """
    order = [clock, tie]
    bucket = F.floor(F.col(clock) / F.lit(width)).cast("bigint")
    action = F.col("action")
    phase = F.when(action.isin("start", "end", "clear"), action)
    opened = F.when(action.isin("start", "clear"), action)
    seen = carry_forward(
        log, [crawl], order, bucket,
        {"__phase_before": phase, "__opened_before": opened, "__prev_ms": F.col(clock), "__start_before": F.when(action == "start", F.col(clock))},
        exclusive=True,
    )
    active = F.coalesce(F.col("__phase_before") == "start", F.lit(False))
    mark = (
        F.when(action == "pause", F.when(active, True))
        .when(action == "resume", F.when(active, False))
        .when(action == "start", F.when(~active, False))
        .when(action.isin("end", "clear"), False)
    )
    seen = seen.withColumns(
        {"__mark": mark, "__phase": F.coalesce(phase, F.col("__phase_before")),
         "__opened": F.coalesce(opened, F.col("__opened_before")),
         "__start": F.when(action == "start", F.col(clock)).otherwise(F.col("__start_before"))}
    )
    seen = carry_forward(seen, [crawl], order, bucket, {"__was_paused": F.col("__mark")}, exclusive=True)
    paused_before = F.coalesce("__was_paused", F.lit(False))
    seen = seen.withColumns(
        {"__paused_before": paused_before, "__paused": F.coalesce("__mark", paused_before)}
    )
    return seen.withColumns(
        {"state_before": _state("__phase_before", "__opened_before", "__paused_before"),
         "state": _state("__phase", "__opened", "__paused"),
         "prev_ms": F.col("__prev_ms"), "start_ms": F.col("__start")}
    ).drop(
        "__phase_before", "__opened_before", "__opened", "__prev_ms", "__start_before", "__mark", "__phase", "__start", "__was_paused",
        "__paused_before", "__paused",
    )


def active_time(
    log: DataFrame, crawl: str = "crawl_id", clock: str = "t_ms", tie: str = "event_id", width: int = STEP_MS
) -> DataFrame:
    """Add ``active_ms``: time since the latest start without paused stretches; 0 when idle.

    A stretch counts for the row at its end if the crawl was running in between, so the running sum
    per (crawl, start) is the active time and no interval join is needed.
    """
    states = lifecycle_states(log, crawl, clock, tie, width)
    ran = F.when((F.col("state_before") == "running") & (F.col("action") != "start"), F.col(clock) - F.col("prev_ms"))
    keyed = states.withColumn("__run", F.coalesce("start_ms", F.lit(-1)))
    bucket = F.floor(F.col(clock) / F.lit(width)).cast("bigint")
    total = running_total(
        keyed, [crawl, "__run"], [clock, tie], bucket, {"__active": F.coalesce(ran, F.lit(0).cast("bigint"))}
    )
    shown = F.when(F.col("state") == "idle", F.lit(0).cast("bigint")).otherwise(F.col("__active"))
    return total.withColumn("active_ms", shown).drop("__run", "__active")
