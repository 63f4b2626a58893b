"""Hyperlink extraction from stored HTML."""

from __future__ import annotations

import functools
import html.entities

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlweave.functions import urls
from crawlweave.functions.text import bind

# One scan finds the tags and, as matches of their own, whatever holds no elements: comments and
# raw-text elements, where an unclosed one runs to the end of the document.
_TAGS = (
    r"(?is)<(?:!--[^-]*+(?:-(?!->)[^-]*+)*+(?:-->|\z)"
    r"|(script|style|title|textarea|xmp|iframe|noembed|noframes)\b[^<]*+(?:<(?!/\1\s*+>)[^<]*+)*+(?:</\1\s*+>|\z)"
    r"|(?:a|base)(?=[\s/])(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>)"
)
_ATTRIBUTE = r"[^\s\"'>/=]++(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s\"'>]++))?+[\s/]*+"


def _href_in(name: str) -> str:
    value = r"(\"[^\"]*+\"|'[^']*+'|[^\s>\"']++)"
    return rf"(?is)^<{name}[\s/]+(?:{_ATTRIBUTE})*?href(?=[\s=>/])(?:\s*+=\s*+{value})?"


_REFERENCE = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[A-Za-z][A-Za-z0-9]*;?)|[^&]+|&"


def _character(code: Column) -> Column:
    """The character of a code point; what is none, is a surrogate or is too large becomes U+FFFD."""
    units = F.when(code <= 0xFFFF, F.lpad(F.hex(code), 4, "0")).otherwise(
        F.concat(F.hex(0xD800 + F.shiftright(code - 0x10000, 10)), F.hex(0xDC00 + (code - 0x10000).bitwiseAND(0x3FF)))
    )
    legal = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    return F.when(legal, F.decode(F.unhex(units), "UTF-16BE")).otherwise("\ufffd")


@functools.cache
def _named() -> str:
    """SQL of a map from reference names to characters, with the semicolon where the grammar needs one."""
    quoted = [f"'{name}', '{chars}'" for name, chars in html.entities.html5.items() if not set("'\\") & set(name + chars)]
    return f"map({', '.join(quoted)}, 'apos;', '\\'', 'bsol;', '\\\\')"


def _decode_entities(c: Column) -> Column:
    """All character references in one pass from left to right, so nothing is decoded twice."""

    def one(part: Column) -> Column:
        digits = F.regexp_extract(part, r"^&#[xX]?0*([0-9a-fA-F]*)", 1)
        short = F.substring(F.concat(F.lit("0"), digits), 1, 9)  # longer numbers are beyond every character
        hexed = F.conv(short, 16, 10).cast("bigint")
        plain = F.coalesce(short.try_cast("bigint"), F.lit(0))
        name = F.substring(part, 2, 64)
        known = F.try_element_at(F.expr(_named()), name)
        number = _character(F.when(part.rlike("^&#[xX]"), hexed).otherwise(plain))
        return F.when(~part.startswith("&"), part).when(part.startswith("&#") & (F.length(part) > 2), number).otherwise(F.coalesce(known, part))

    return F.when(c.contains("&"), F.array_join(F.transform(F.regexp_extract_all(c, F.lit(_REFERENCE), F.lit(0)), one), "")).otherwise(c)


def _href(tag: Column, name: str) -> Column:
    def unquote(value: Column) -> Column:
        quoted = value.startswith('"') | value.startswith("'")
        return F.when(quoted, F.substr(value, F.lit(2), F.length(value) - 2)).otherwise(value)

    return bind(bind(F.regexp_extract(tag, _href_in(name), 1), unquote), _decode_entities)


def extract_links(pages: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Every ``a[href]`` of each page in document order, resolved against the page's base address.

    Input ``url, html`` (plus the columns named in ``keep``); output ``url, pos, href, link``.
    One narrow pass over the pages: no shuffle, no Python. The links are complete before the array
    is exploded, so a later filter on them cannot repeat the work.
    """

    def links_in(tags: Column, url: Column) -> Column:
        anchors = F.filter(tags, lambda t: t.rlike(_href_in("a")))
        first_base = F.get(F.filter(tags, lambda t: t.rlike(_href_in("base"))), F.lit(0))
        own_base = F.coalesce(bind(first_base, lambda t: urls.absolutise(url, _href(t, "base"))), F.lit(""))

        def resolved(base: Column) -> Column:
            def link(tag: Column) -> Column:
                return bind(
                    _href(tag, "a"), lambda h: F.struct(h.alias("href"), urls.absolutise(base, h).alias("link"))
                )

            return F.transform(anchors, link)

        return bind(bind(own_base, lambda b: F.when(b != "", b).otherwise(url)), resolved)

    tags = F.regexp_extract_all(F.col("html"), F.lit(_TAGS), F.lit(0))
    found = bind(F.struct(tags.alias("tags"), F.col("url").alias("url")), lambda p: links_in(p["tags"], p["url"]))
    usable = pages.where(F.col("url").isNotNull() & F.col("html").isNotNull())
    rows = usable.select(*(keep or []), "url", F.posexplode(found).alias("pos", "__link"))
    return rows.select(*(keep or []), "url", "pos", "__link.href", "__link.link")


def follow_filter(links: DataFrame, page_url: str = "url", link: str = "link") -> DataFrame:
    """Links worth following: not empty, no fragment, http(s), same host as the page's own address."""
    target = F.col(link)
    plain = links.where((target != "") & ~target.contains("#"))
    same_host = F.lower(urls.host(target)) == F.lower(urls.host(F.col(page_url)))
    return plain.where(urls.scheme(target).isin(*urls.WEB_SCHEMES) & same_host)


def link_table(pages: DataFrame) -> DataFrame:
    """``links(src, dst, pos)`` for the crawl, from stored pages."""
    return follow_filter(extract_links(pages)).select(
        F.col("url").alias("src"), F.col("link").alias("dst"), "pos"
    )


def bucketed_links(links: DataFrame, table: str, path: str, buckets: int) -> DataFrame:
    """Store the link table bucketed by source, so each crawl level joins it without moving it."""
    spark = links.sparkSession
    links.write.bucketBy(buckets, "src").sortBy("src").option("path", path).mode("overwrite").saveAsTable(table)
    return spark.table(table)


__all__ = ["extract_links", "follow_filter", "link_table", "bucketed_links"]
