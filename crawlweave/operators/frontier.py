"""Breadth-first crawl over a link table, level by level."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlweave.functions import urls
from crawlweave.operators.links import extract_links, follow_filter
from crawlweave.operators.prefix import block, number_by_range, running_total
from crawlweave.operators.robots import match_robots
from crawlweave.session import new_path, stage

LOG = "crawl_id bigint, url string, depth int, seq bigint, state string"
_OFFERS = f"{LOG}, offered bigint"
DISPATCHED = ("processed", "failed", "handler_error")
# State of a row that stands for offers of an address seen before; no part of the log.
REFUSED = "refused"

Expand = Callable[[DataFrame], DataFrame]
Fetch = Callable[[DataFrame], DataFrame]


@dataclass
class Crawl:
    """``log``: one row per accepted address with its ``state``.

    ``attempts``: ``crawl_id, depth, candidates, accepted``: addresses offered to the seen set, each time one was, and
    those accepted, counted while the crawl expanded its levels; depth 0 are the seeds.
    """

    log: DataFrame
    attempts: DataFrame


class _Levels:
    """All levels so far in one table, partitioned by depth and bucketed by crawl and address.

    The next level's candidates are dealt by the same hash, so they meet the seen set where it lies: it is neither
    shuffled nor, for a level's rows, read as a whole. The table is in the catalog while the crawl runs; its files stay.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.path, self.name = spark, new_path(spark, "crawl"), f"crawl_{uuid.uuid4().hex}"
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def add(self, rows: DataFrame) -> None:
        dealt = rows.repartition(self.buckets, "crawl_id", "url").write.mode("append").partitionBy("depth")
        dealt.bucketBy(self.buckets, "crawl_id", "url").option("path", self.path).saveAsTable(self.name, format="parquet")

    def seen(self) -> DataFrame:
        return self.spark.table(self.name).where(F.col("state") != REFUSED)

    def level(self, depth: int) -> DataFrame:
        return self.seen().where(F.col("depth") == depth)

    def files(self) -> DataFrame:
        names = [c.split()[0] for c in _OFFERS.split(", ")]
        return self.spark.read.schema(_OFFERS).parquet(self.path).select(*names)

    def forget(self) -> None:
        self.spark.sql(f"drop table if exists {self.name}")


def seed_frontier(seeds: DataFrame, url: str = "url", crawl_id: str | None = None, order: str | None = None) -> DataFrame:
    """Distinct, non-blank seeds at depth 0: ``crawl_id, url, depth, place`` and how often each was ``offered``."""
    text = F.col(url)
    place = F.col(order).cast("bigint") if order else F.lit(0).cast("bigint")
    crawl = F.col(crawl_id).cast("bigint") if crawl_id else F.lit(0).cast("bigint")
    usable = seeds.where(text.isNotNull() & ~text.rlike(r"^\s*$"))
    return (
        usable.select(crawl.alias("crawl_id"), text.alias("url"), place.alias("place"))
        .groupBy("crawl_id", "url")
        .agg(F.min("place").alias("place"), F.count("*").alias("offered"))
        .select("crawl_id", "url", F.lit(0).alias("depth"), "place", "offered")
    )


def expand_with(links: DataFrame) -> Expand:
    """Candidates from a stored table ``links(src, dst, pos)``."""
    edges = links.select("src", "dst", F.col("pos").cast("bigint").alias("pos"))

    def expand(handled: DataFrame) -> DataFrame:
        joined = handled.join(edges, F.col("url") == F.col("src"))
        return joined.select("crawl_id", F.col("dst").alias("url"), "depth", F.col("seq").alias("parent_seq"), "pos")

    return expand


def expand_pages(pages: DataFrame) -> Expand:
    """Candidates from stored pages ``url, html``: extraction and the link filters per level."""

    def expand(handled: DataFrame) -> DataFrame:
        read = handled.join(pages.select("url", "html"), "url")
        found = follow_filter(extract_links(read, ["crawl_id", "depth", "seq"]))
        return found.select(
            "crawl_id", F.col("link").alias("url"), "depth", F.col("seq").alias("parent_seq"), F.col("pos").cast("bigint")
        )

    return expand


def offers(candidates: DataFrame, seen: DataFrame) -> DataFrame:
    """Distinct candidates at their first place in parent order, how often each was ``offered``, and whether it is ``known``.

    The aggregation combines before the only shuffle; a ``seen`` that is bucketed by crawl and address into as many
    buckets as there are shuffle partitions is joined where it lies.
    """
    first = candidates.groupBy("crawl_id", "url").agg(
        F.min("depth").alias("depth"), F.min(F.struct("parent_seq", "pos")).alias("__first"), F.count("*").alias("offered")
    )
    known = seen.select("crawl_id", "url", F.lit(True).alias("known"))
    met = first.join(known, ["crawl_id", "url"], "left")
    return met.select("crawl_id", "url", "depth", "__first.parent_seq", "__first.pos", "offered", F.coalesce("known", F.lit(False)).alias("known"))


def next_frontier(candidates: DataFrame, seen: DataFrame) -> DataFrame:
    """The candidates that no earlier level accepted; an address is in ``seen`` once."""
    return offers(candidates, seen).where(~F.col("known")).drop("known", "offered")


def _numbered(rows: DataFrame, order: list[str], so_far: DataFrame, label: str) -> DataFrame:
    """Give rows the next sequence numbers of their crawl in the given order, and what it ``spent`` so far."""
    return number_by_range(rows, ["crawl_id"], order, "seq", label, so_far).fillna(0, ["spent"])


def crawl(
    seeds: DataFrame,
    links: DataFrame | Expand,
    *,
    max_depth: int | None = None,
    max_pages: int | None = None,
    rules: DataFrame | None = None,
    fetch: Fetch | None = None,
    screen: Callable[[DataFrame], DataFrame] | None = None,
    ordered: bool = False,
) -> Crawl:
    """Crawl from ``seeds`` (see :func:`seed_frontier`) until nothing new is found.

    Each level drops addresses the robots rules deny, dispatches the rest in first-in-first-out
    order while the page budget of its crawl lasts, and follows the links of the handled pages.
    ``fetch`` may add ``outcome`` (``processed``, ``failed`` or ``handler_error``) to the
    dispatched rows; only processed pages yield links.

    An address that does not parse ends as ``bad_url`` and uses no budget. ``screen`` adds ``blocked``
    (see :func:`crawlweave.operators.screening.screen`); a blocked address fails without being fetched.

    Depth is the shortest link distance. ``seq`` is the order of acceptance; it is computed only
    if ``ordered`` or ``max_pages`` asks for it. Levels are appended to one table in the shared folder; the
    driver sees two counts per level, read from that table so that retried tasks cannot distort them.
    """
    spark = seeds.sparkSession
    levels = _Levels(spark)
    try:
        return _crawl(seeds, links if callable(links) else expand_with(links), levels, max_depth, max_pages, rules, fetch, screen, ordered)
    finally:
        levels.forget()


def _crawl(seeds, expand, levels, max_depth, max_pages, rules, fetch, screen, ordered) -> Crawl:
    spark = seeds.sparkSession
    numbered = ordered or max_pages is not None
    zero = F.lit(0).cast("bigint")
    totals = spark.createDataFrame([], "crawl_id bigint, used bigint, spent bigint")
    plain = rules is None and screen is None and fetch is None and not numbered
    seeds = seeds if "offered" in seeds.columns else seeds.withColumn("offered", F.lit(1).cast("bigint"))
    offered, depth = seeds.withColumn("known", F.lit(False)), 0
    while True:
        if numbered and depth:
            offered = stage(offered, "crawl-offers")
        # offers of known addresses are counted and otherwise left alone
        level = offered if plain else offered.where(~F.col("known"))
        if numbered:
            level = _numbered(level, ["parent_seq", "pos"] if depth else ["place", "url"], totals, "crawl-level")
        else:
            level = level.withColumns({"seq": zero, "spent": zero})
        level = level.select("crawl_id", "url", "depth", "seq", "spent", "offered", "known")
        names = level.columns
        level = level.withColumn("legal", urls.base_url(F.col("url")).isNotNull())
        judged = level.withColumn("allowed", F.lit(True))
        if rules is not None:
            judged = match_robots(level, rules).select(*names, "legal", "allowed")
        if screen is not None:
            judged = screen(judged).select(*names, "legal", "allowed", "blocked")
        else:
            judged = judged.withColumn("blocked", F.lit(False))
        examined = F.lit(True)
        if max_pages is not None:
            judged = stage(judged, "crawl-judged")  # the running total reads the level twice
            ahead = {"ahead": (F.col("allowed") & F.col("legal")).cast("bigint")}
            judged = running_total(judged, ["crawl_id"], ["seq"], block("seq"), ahead, exclusive=True)
            examined = F.col("spent") + F.col("ahead") < max_pages
        state = (
            F.when(F.col("known"), REFUSED).when(~examined, "queued").when(~F.col("legal"), "bad_url").when(~F.col("allowed"), "robots_blocked")
            .when(F.col("blocked"), "failed")
        )
        judged = judged.withColumn("state", state).select("crawl_id", "url", "depth", "seq", "state", "offered")
        outcome = F.lit("processed")
        if fetch is not None:
            judged, outcome = fetch(judged), F.coalesce("outcome", outcome)
        judged = judged.select("crawl_id", "url", "depth", "seq", F.coalesce("state", outcome).alias("state"), "offered")
        if not plain:
            refused = offered.where("known").select("crawl_id", "url", "depth", zero.alias("seq"), F.lit(REFUSED).alias("state"), "offered")
            judged = judged.unionByName(refused)
        levels.add(judged)

        found = F.count_if(F.col("state") == "processed").alias("handled")
        if numbered:
            # what a crawl used and spent so far is carried on, not summed up again over all levels
            now = levels.level(depth).groupBy("crawl_id").agg(
                F.max("seq").alias("used"), F.count_if(F.col("state").isin(*DISPATCHED)).alias("spent"), F.count("*").alias("rows"), found
            )
            both = now.unionByName(totals, allowMissingColumns=True).groupBy("crawl_id")
            totals = stage(both.agg(F.max("used").alias("used"), F.sum("spent").alias("spent"), F.sum("rows").alias("rows"), F.sum("handled").alias("handled")), "crawl-totals")
            rows, handled = totals.agg(F.sum("rows"), F.sum("handled")).first()
            totals = totals.select("crawl_id", "used", "spent")
        else:
            rows, handled = levels.level(depth).agg(F.count("*"), found).first()
        if not rows or not handled or (max_depth is not None and depth >= max_depth):
            break

        links_found = expand(levels.level(depth).where(F.col("state") == "processed")).withColumn("depth", F.col("depth") + 1)
        offered = offers(links_found, levels.seen())
        depth += 1
    written = levels.files()
    attempts = written.groupBy("crawl_id", "depth").agg(
        F.sum("offered").alias("candidates"), F.count_if(F.col("state") != REFUSED).alias("accepted")
    )
    return Crawl(written.where(F.col("state") != REFUSED).drop("offered"), attempts)


def union_frontier(*parts: DataFrame) -> DataFrame:
    """Seeds and links feed one queue."""
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part)
    return merged


def duplicate_attempts(result: Crawl) -> DataFrame:
    """Candidates refused by the seen set, per crawl and depth, with what they consist of; seeds only if some were refused."""
    refused = F.col("candidates") - F.col("accepted")
    rows = result.attempts.select("crawl_id", "depth", "candidates", "accepted", refused.alias("duplicates"))
    return rows.where((F.col("depth") > 0) | (F.col("duplicates") > 0))
