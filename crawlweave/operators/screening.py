"""Private-address screening of URLs against a table of resolved host addresses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlweave.functions import addresses, urls
from crawlweave.operators.skew import dimension_join


def host_verdicts(host_ips: DataFrame) -> DataFrame:
    """``host, private_host``: true if any address of the host is private."""
    return (
        host_ips.where(F.col("ip").isNotNull())
        .groupBy(F.lower("host").alias("__host"))
        .agg(F.bool_or(addresses.is_private(F.col("ip"))).alias("private_host"))
    )


def screen(rows: DataFrame, host_ips: DataFrame, url: str = "url", allow: Column | None = None) -> DataFrame:
    """Add ``blocked``: a private address, no host, or a host that does not resolve.

    ``allow`` overrides the verdict for first requests (the screening predicate is replaceable).
    """
    named = rows.withColumn("__host", F.lower(urls.host(F.col(url))))
    joined = dimension_join(named, host_verdicts(host_ips), "__host", url)
    literal = addresses.is_private(addresses.literal_address(F.col("__host")))
    blocked = F.coalesce(literal, F.col("private_host"), F.lit(True))
    if allow is not None:
        blocked = blocked & ~allow
    return joined.withColumn("blocked", blocked).drop("__host", "private_host")


def admit_seeds(raw: DataFrame, host_ips: DataFrame, text: str = "raw") -> DataFrame:
    """Seeds with ``url`` and ``reason``: null reason means accepted, otherwise why it was not."""
    tidy = raw.withColumn("url", F.when(~urls.seed_too_long(F.col(text)), urls.normalise_seed(F.col(text))))
    reason = (
        F.when(urls.seed_too_long(F.col(text)), "too long")
        .when(F.col("url").isNull(), "blank")
        .when(F.col("blocked"), "blocked")
    )
    return screen(tidy, host_ips).withColumn("reason", reason).drop("blocked")
