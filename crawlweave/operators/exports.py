"""CSV export and the tables of the crawl report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlweave.functions import messages, text, urls
from crawlweave.operators.counters import depth_counts
from crawlweave.operators.prefix import block, number_by_range, row_rank
from crawlweave.session import stage
from crawlweave.sources.buffer import Buffer

# Header of the CSV export and the usual display buffer.
CSV_HEADER = "depth,url,host,path"
CSV_LINE_END = "\r\n"
DISPLAY_CAPACITY = 10_000


def decoded(feed: DataFrame, message: str = "value") -> DataFrame:
    """Split each message by the export rule into ``depth`` and ``url``."""
    rest = [c for c in feed.columns if c != message]
    return feed.withColumn("__m", messages.decode_export(F.col(message))).select(*rest, "__m.depth", "__m.url")


def export_rows(pages: DataFrame) -> DataFrame:
    """The four CSV columns; other columns are kept in front."""
    rest = [c for c in pages.columns if c not in ("depth", "url")]
    url = F.col("url")
    return pages.select(
        *rest, "depth", "url", urls.export_host(url).alias("host"), urls.export_path(url).alias("path")
    )


def csv_line(depth: Column, url: Column, host: Column, path: Column) -> Column:
    return F.concat_ws(",", depth.cast("string"), text.escape_csv(url), text.escape_csv(host), text.escape_csv(path))


def export_lines(pages: DataFrame) -> DataFrame:
    rows = export_rows(pages)
    line = csv_line(*[F.col(c) for c in ("depth", "url", "host", "path")])
    return rows.withColumn("line", line)


def write_csv(pages: DataFrame, path: str, order: str | None = None, single_file: bool = False) -> None:
    """Write the export with exact bytes: each line is built here, so nothing re-quotes it.

    The parts hold rows only; see :func:`write_csv_with_header`. ``order`` sorts the parts by ranges, so the files in
    name order give the rows in order. ``single_file`` is for small exports only, since one task
    then writes everything.
    """
    lines = export_lines(pages)
    if single_file:
        lines = lines.coalesce(1)
        lines = lines.sortWithinPartitions(order) if order else lines
    elif order:
        lines = lines.orderBy(order)
    lines.select("line").write.option("lineSep", CSV_LINE_END).text(path)


def write_csv_with_header(pages: DataFrame, path: str, order: str | None = None) -> None:
    """As :func:`write_csv`, below ``path``: the header in ``0-header`` and the rows in ``1-rows``.

    All files in the order of their paths are the export, header first.
    """
    spark = pages.sparkSession
    header = spark.range(1).select(F.lit(CSV_HEADER).alias("line")).coalesce(1)
    header.write.option("lineSep", CSV_LINE_END).text(f"{path}/0-header")
    write_csv(pages, f"{path}/1-rows", order)


def read_export(spark: SparkSession, path: str) -> DataFrame:
    """``place`` (from 0) and ``line`` of an export with header, read back in the order of the paths."""
    lines = spark.read.option("lineSep", CSV_LINE_END).text([f"{path}/0-header", f"{path}/1-rows"])
    within = lines.select(
        F.regexp_extract("_metadata.file_path", r"/([^/]+/[^/]+)$", 1).alias("file"), F.col("_metadata.file_block_start").alias("begin"),
        F.monotonically_increasing_id().alias("at"), F.col("value").alias("line"),
    )
    placed = number_by_range(within, [], ["file", "begin", "at"], "place", "export-lines")
    return placed.select((F.col("place") - 1).alias("place"), "line")


def export_and_clear(buffer: Buffer, target_path: str, mark: list[str] | None = None) -> DataFrame:
    """Export a snapshot of the buffer, then clear exactly what was exported; returns the snapshot.

    Messages that arrive after the snapshot was marked are neither exported nor cleared.
    """
    mark = buffer.snapshot() if mark is None else mark
    snapshot = stage(buffer.read(mark), "export-snapshot")
    write_csv(decoded(snapshot), target_path)
    buffer.clear(mark)
    return snapshot


def last_n(feed: DataFrame, order: str, n: int = DISPLAY_CAPACITY) -> DataFrame:
    """The newest ``n`` rows: the bounded display buffer, where the oldest drop out."""
    return feed.orderBy(F.desc(order)).limit(n)


def report_listing(pages: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Arrival ordinal and the three columns of the listing: ``#``, ``Depth``, ``URL``."""
    ranked = row_rank(pages, keys, [order], block(order), "ordinal")
    return ranked.select(
        *keys,
        "ordinal",
        text.ordinal_label(F.col("ordinal")).alias("label"),
        text.depth_label(F.col("depth")).alias("depth_label"),
        "url",
    )


def report_depths(pages: DataFrame, *keys: str) -> DataFrame:
    counted = depth_counts(pages, *keys)
    return counted.select(
        *keys,
        "depth",
        F.concat(F.lit("Depth "), F.col("depth").cast("string")).alias("label"),
        F.concat(F.col("pages").cast("string"), F.lit(" pages")).alias("text"),
    )


def report_summary(pages: DataFrame, sessions: DataFrame, key: str, exported_at: Column, now_ms: Column) -> DataFrame:
    """Summary lines of each crawl: domain, export time, duration and total.

    ``sessions(key, seed, start_ms, end_ms)`` has one row per crawl.
    """
    totals = pages.groupBy(key).agg(F.count(F.lit(1)).alias("total_pages"))
    joined = sessions.join(totals, key, "left")
    domain = F.when(F.coalesce("seed", F.lit("")) == "", "N/A").otherwise(F.col("seed"))
    return joined.select(
        key,
        domain.alias("domain"),
        F.date_format(exported_at, "yyyy-MM-dd HH:mm:ss").alias("exported"),
        text.format_duration(F.col("start_ms"), F.col("end_ms"), now_ms).alias("duration"),
        F.coalesce("total_pages", F.lit(0).cast("bigint")).alias("total_pages"),
    )
