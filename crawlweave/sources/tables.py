"""Batch sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlweave.session import pin

# Schema of the stored event table, needed where a stream cannot infer it.
EVENTS_SCHEMA = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return pin(spark).read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def page_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Fetched pages: address and raw HTML."""
    return table(spark, folder, "pages").select("page_id", "url", "html")


def stored_pages(pages: DataFrame):
    """A page provider over stored pages: adds ``html`` and ``outcome`` to rows with a ``url``.

    Any function with this shape can stand in for it, e.g. one that fetches with ``mapInPandas``.
    """
    known = pages.select("url", "html")

    def provide(rows: DataFrame) -> DataFrame:
        joined = rows.join(known, "url", "left")
        return joined.withColumn("outcome", F.when(F.col("html").isNull(), "failed").otherwise("processed"))

    return provide
