"""Escaping, trimming and display formatting."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Entity replacements of the HTML escape, ampersand first.
HTML_ENTITIES = (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;"))

# Golden-angle hue step, saturation and lightness of the depth badge.
HUE_STEP = 137.508
BADGE_SATURATION = 65
BADGE_LIGHTNESS = 58


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and hand it to ``use`` as a variable.

    A column used n times in an expression is copied n times into the plan, and nested uses
    multiply; a lambda variable is evaluated once, however often it is used.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _replace(c: Column, old: str, new: str) -> Column:
    return F.replace(c, F.lit(old), F.lit(new))


def trim_controls(c: Column) -> Column:
    """Strip every leading and trailing character up to U+0020, not just blanks."""
    return F.regexp_replace(c, r"^[\x00-\x20]+|[\x00-\x20]+$", "")


def escape_html(c: Column) -> Column:
    for raw, entity in HTML_ENTITIES:
        c = _replace(c, raw, entity)
    return c


def escape_html_live(c: Column) -> Column:
    """The live table's variant, which leaves the apostrophe alone."""
    for raw, entity in HTML_ENTITIES:
        if raw != "'":
            c = _replace(c, raw, entity)
    return c


def safe_href(url: Column) -> Column:
    """The escaped link if it is http(s) after trimming, ignoring case; otherwise ``#``."""
    lowered = F.lower(trim_controls(url))
    web = lowered.startswith("http://") | lowered.startswith("https://")
    return F.when(F.coalesce(web, F.lit(False)), escape_html(url)).otherwise("#")


def safe_href_live(url: Column) -> Column:
    """Live-table variant: case-sensitive and untrimmed."""
    web = url.startswith("http://") | url.startswith("https://")
    return F.when(F.coalesce(web, F.lit(False)), escape_html_live(url)).otherwise("#")


def escape_csv(c: Column) -> Column:
    quoted = F.concat(F.lit('"'), _replace(c, '"', '""'), F.lit('"'))
    return F.coalesce(F.when(c.rlike('[,"\\r\\n]'), quoted).otherwise(c), F.lit(""))


def depth_color(depth: Column) -> Column:
    hue = (depth * F.lit(HUE_STEP)) % F.lit(360.0)
    whole = F.floor(hue + F.lit(0.5)).cast("int")
    return F.format_string(f"hsl(%d,{BADGE_SATURATION}%%,{BADGE_LIGHTNESS}%%)", whole)


def ordinal_label(n: Column) -> Column:
    return F.format_string("%03d", n)


def depth_label(depth: Column) -> Column:
    return F.concat(F.lit("D"), depth.cast("string"))


def format_duration(start_ms: Column, end_ms: Column, now_ms: Column) -> Column:
    """``HH:MM:SS``; an unset start gives dashes, an unset end means the crawl still runs."""
    until = F.when(end_ms > 0, end_ms).otherwise(now_ms)
    secs = F.floor((until - start_ms) / F.lit(1000)).cast("bigint")
    text = F.format_string(
        "%02d:%02d:%02d", F.floor(secs / 3600), F.floor((secs % 3600) / 60), secs % 60
    )
    return F.when(start_ms > 0, text).otherwise("--:--:--")


def epoch_ms(ts: Column) -> Column:
    return F.unix_millis(ts.cast("timestamp"))
