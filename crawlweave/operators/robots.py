"""Robots rules: parsing, longest-match decision and cache refresh."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlweave.functions import urls
from crawlweave.functions.text import trim_controls
from crawlweave.operators.asof import asof_join
from crawlweave.operators.skew import dimension_join
from crawlweave.operators.spacing import greedy_spacing

# Longest honoured crawl delay and the age at which cached rules are fetched again.
MAX_CRAWL_DELAY_MS = 60_000
CACHE_TTL_MS = 30 * 60 * 1000

_NEW_LINE = r"\r\n|\n|\r"
_SECTION = r"(?i)(?<![^\r\n])(?=[\x00-\x20&&[^\r\n]]*user-agent:)"
_NUMBER = r"^[+-]?(NaN|Infinity|([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?[fFdD]?)$"


def robots_lines(robots: DataFrame) -> DataFrame:
    """``base_url, line_no, line`` of every rules file that was served with status 200."""
    return robots.where(F.col("status") == 200).select(
        "base_url", F.posexplode(F.split("body", _NEW_LINE)).alias("__at", "line")
    ).select("base_url", (F.col("__at") + 1).alias("line_no"), "line")


def _value(line: Column) -> Column:
    return trim_controls(F.regexp_extract(line, r"(?s)^[^:]*:(.*)$", 1))


def _is(line: Column, field: str) -> Column:
    return line.rlike(rf"(?i)^{field}:")


def _delay_ms(text: Column) -> Column:
    seconds = F.when(text.rlike(_NUMBER), F.regexp_replace(text, "[fFdD]$", "").try_cast("double"))
    bounded = F.greatest(F.least(seconds * 1000, F.lit(float(MAX_CRAWL_DELAY_MS))), F.lit(-1e15))
    # least and greatest skip nulls, so text that is no number is taken out first
    whole = F.when(F.isnan(seconds), F.lit(0).cast("bigint")).otherwise(bounded.cast("bigint"))
    return F.when(seconds.isNotNull(), whole)


def parse_robots(robots: DataFrame, agent: str, keep: Sequence[str] = ()) -> DataFrame:
    """One row per rules file: ``base_url``, ``disallows``, ``allows`` (longest first), ``crawl_delay_ms`` and ``keep``.

    A rules file is one row, so its sections are split in place: a section runs from one
    ``User-agent`` line to the next, which is exactly the reach of that line. Text before the first
    one belongs to nobody. The sections for ``*`` and for ``agent`` are merged. No shuffle.
    """
    sections = F.split(F.col("body"), _SECTION)

    def lines_of(section: Column) -> Column:
        return F.transform(F.split(section, _NEW_LINE), lambda l: trim_controls(l))

    def is_ours(section: Column) -> Column:
        head = F.element_at(lines_of(section), 1)
        who = _value(head)
        return _is(head, "user-agent") & ((who == "*") | (F.lower(who) == agent.lower()))

    ours = F.flatten(F.transform(F.filter(sections, is_ours), lines_of))

    def paths(field: str) -> Column:
        found = F.filter(F.transform(F.filter("__lines", lambda l: _is(l, field)), _value), lambda p: p != "")
        return F.array_sort(
            F.array_distinct(found),
            lambda a, b: F.when(F.length(a) > F.length(b), -1)
            .when(F.length(a) < F.length(b), 1)
            .when(a < b, -1)
            .when(a > b, 1)
            .otherwise(0),
        )

    delays = F.filter(
        F.transform(F.filter("__lines", lambda l: _is(l, "crawl-delay")), lambda l: _delay_ms(_value(l))),
        lambda d: d.isNotNull(),
    )
    served = robots.withColumn(
        "__lines", F.when(F.col("status") == 200, ours).otherwise(F.expr("cast(array() as array<string>)"))
    )
    return served.select(
        "base_url",
        paths("disallow").alias("disallows"),
        paths("allow").alias("allows"),
        F.coalesce(F.try_element_at(delays, F.lit(-1)), F.lit(0).cast("bigint")).alias("crawl_delay_ms"),
        *keep,
    )


def rule_rows(rules: DataFrame) -> DataFrame:
    """Rules as rows ``base_url, kind, path``, longest path first within a kind."""
    kinds = F.array(
        F.struct(F.lit("allow").alias("kind"), F.col("allows").alias("paths")),
        F.struct(F.lit("disallow").alias("kind"), F.col("disallows").alias("paths")),
    )
    by_kind = rules.select("base_url", F.inline(kinds))
    return by_kind.select("base_url", "kind", F.posexplode("paths").alias("position", "path"))


def _longest(rules: str, path: Column) -> Column:
    # the rules are sorted longest first, so the first hit is the longest
    return F.coalesce(F.length(F.try_element_at(F.filter(rules, lambda r: path.startswith(r)), F.lit(1))), F.lit(-1))


def _verdict(path: Column) -> Column:
    """Whether the rules in ``allows`` and ``disallows`` (null: no file) let a decoded path through."""
    best_allow, best_disallow = _longest("allows", path), _longest("disallows", path)
    return F.when(path.isNull(), False).otherwise(F.when(F.col("allows").isNull(), True).otherwise(best_allow >= best_disallow))


def match_robots(pages: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """Add ``base_url``, ``allowed`` and ``crawl_delay_ms`` to every row.

    The longest matching rule decides and a tie allows; rules are literal prefixes of the decoded
    path. An address without a path component, or one that does not parse, is denied.
    """
    parsed = pages.withColumns({"base_url": urls.base_url(F.col(url)), "__path": urls.path(F.col(url))})
    joined = dimension_join(parsed, rules, "base_url", url)
    return joined.withColumns(
        {
            "allowed": _verdict(F.col("__path")),
            "crawl_delay_ms": F.coalesce("crawl_delay_ms", F.lit(0).cast("bigint")),
        }
    ).drop("__path", "allows", "disallows")


def refresh_plan(dispatches: DataFrame, clock: str, order: str, ttl_ms: int = CACHE_TTL_MS) -> DataFrame:
    """For each dispatch: whether the rules are fetched again and when the ones in use were fetched.

    A fetch happens when the cached copy is at least ``ttl_ms`` old, which is the host throttle
    with the lifetime as its gap.
    """
    spaced = greedy_spacing(dispatches, ["base_url"], clock, F.lit(ttl_ms).cast("bigint"), order)
    return spaced.withColumnsRenamed({"granted": "refetched", "last_grant": "rules_fetched_ms"}).drop("wait")


def rules_in_force(
    dispatches: DataFrame, versions: DataFrame, agent: str, clock: str, order: str, ttl_ms: int = CACHE_TTL_MS, url: str = "url"
) -> DataFrame:
    """Dispatches judged by the rules file they actually use: the cached copy, as it was served when it was fetched.

    ``versions`` has ``base_url``, ``served_ms`` (from when on), ``status`` and ``body``. Adds ``base_url``, ``refetched``,
    ``rules_fetched_ms``, ``served_ms`` of the version in the cache, ``allowed`` and ``crawl_delay_ms``. Before its first version
    a site has no rules. A version that is served after the fetch takes effect with the next fetch only.
    """
    rows = dispatches.withColumn("base_url", urls.base_url(F.col(url)))
    plan = refresh_plan(rows, clock, order, ttl_ms)
    payload = ["disallows", "allows", "crawl_delay_ms"]
    parsed = parse_robots(versions, agent, keep=["served_ms"])
    found = asof_join(plan, parsed, ["base_url"], "rules_fetched_ms", "served_ms", payload)
    return found.withColumns(
        {"allowed": _verdict(urls.path(F.col(url))), "crawl_delay_ms": F.coalesce("crawl_delay_ms", F.lit(0).cast("bigint"))}
    ).drop("disallows", "allows")
