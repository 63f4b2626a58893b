"""Fetch outcomes and redirect chains from logged attempts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlweave.functions import urls
from crawlweave.functions.text import trim_controls
from crawlweave.operators.screening import screen
from crawlweave.operators.skew import dimension_join
from crawlweave.session import stage

# Attempts per page and redirects that are followed.
MAX_ATTEMPTS = 3
MAX_REDIRECTS = 5


def status_class(status: Column) -> Column:
    """``ok`` parses, ``gone`` fails at once, ``retry`` and ``redirect`` are not final by themselves."""
    return (
        F.when(status.isNull(), "retry")
        .when(status.between(300, 399), "redirect")
        .when(status >= 500, "retry")
        .when(status >= 400, "gone")
        .otherwise("ok")
    )


def fetch_outcome(attempts: DataFrame, keys: tuple[str, ...] = ("url",), max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """One row per page: ``outcome``, the deciding ``status`` and ``attempts_used``.

    The first attempt that is neither a server error nor a network error (null status) decides. A
    redirect status in this log is one that could not be followed, so it counts as an error.
    """
    final = status_class(F.col("status")).isin("ok", "gone")
    tried = attempts.where(F.col("attempt") <= max_attempts)
    decided = tried.groupBy(*keys).agg(
        F.min(F.when(final, F.struct("attempt", "status"))).alias("__first"), F.max("attempt").alias("__last")
    )
    status = F.col("__first.status")
    return decided.select(
        *keys,
        F.when(status_class(status) == "ok", "processed").otherwise("failed").alias("outcome"),
        status.alias("status"),
        F.coalesce("__first.attempt", "__last").alias("attempts_used"),
    )


def redirect_map(redirects: DataFrame, host_ips: DataFrame, max_redirects: int = MAX_REDIRECTS) -> DataFrame:
    """Where every redirecting address ends: ``src, final_url, hops, error``.

    ``redirects(src, location)`` is unique per ``src``. Only this table is joined with itself, one
    hop at a time, and only chains that still move take part in the next hop; the (far larger) page
    table needs a single join with the result. Many chains may meet in one address, so each hop
    splits hot addresses.
    """
    location = trim_controls(F.col("location"))
    blank = F.coalesce(location == "", F.lit(True))
    edges = redirects.select(
        "src", F.when(~blank, urls.absolutise(F.col("src"), location)).alias("dst"), blank.alias("missing")
    )
    edges = screen(edges, host_ips, "dst")
    reason = F.when(F.col("missing"), "missing location").when(F.col("blocked"), "blocked target")
    edges = stage(edges.select("src", "dst", reason.alias("reason")), "redirect-edges")

    target = F.when(F.col("reason").isNull(), F.col("dst"))
    step = edges.select(F.col("src").alias("current"), target.alias("next"), F.col("reason").alias("next_error"), F.lit(True).alias("moves"))
    moving = edges.select("src", target.alias("current"), F.lit(1).alias("hops"), F.col("reason").alias("error"))
    ended = moving.where(F.col("error").isNotNull())
    moving = moving.where(F.col("error").isNull())
    for hop in range(2, max_redirects + 2):
        rows = moving.count()
        if rows == 0:
            break
        joined = dimension_join(moving, step, "current", "src")
        moves = F.coalesce("moves", F.lit(False))
        failure = F.coalesce("next_error", F.lit("too many redirects") if hop > max_redirects else F.lit(None).cast("string"))
        hopped = stage(
            joined.select(
                "src",
                F.when(moves, F.col("next")).otherwise(F.col("current")).alias("current"),
                F.when(moves, F.lit(hop)).otherwise(F.col("hops")).alias("hops"),
                F.when(moves, failure).alias("error"),
                moves.alias("moves"),
            ),
            "redirect-hop",
        )
        still = F.col("moves") & F.col("error").isNull()
        ended = ended.unionByName(hopped.where(~still).drop("moves"))
        moving = hopped.where(still).drop("moves")
    return ended.select("src", F.when(F.col("error").isNull(), F.col("current")).alias("final_url"), "hops", "error")


def resolve_redirects(pages: DataFrame, redirects: DataFrame, host_ips: DataFrame, url: str = "url") -> DataFrame:
    """Add ``final_url``, ``hops`` and ``error``; pages that do not redirect keep their own address."""
    ends = redirect_map(redirects, host_ips).withColumnRenamed("src", url)
    joined = pages.join(ends, url, "left")
    final = F.when(F.col("hops").isNull(), F.col(url)).otherwise(F.col("final_url"))
    return joined.withColumns({"final_url": final, "hops": F.coalesce("hops", F.lit(0))})
