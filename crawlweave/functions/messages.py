"""Crawl messages: one string ``depth|url``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def encode_message(depth: Column, url: Column) -> Column:
    return F.concat(depth.cast("string"), F.lit("|"), url)


def _halves(msg: Column) -> tuple[Column, Column, Column]:
    bar = F.instr(msg, "|")
    return bar, F.substr(msg, F.lit(1), bar - 1), F.substr(msg, bar + 1)


def decode_export(msg: Column) -> Column:
    """``struct(depth int, url)``: a bar always splits, a bad number counts as depth 0."""
    bar, left, right = _halves(msg)
    number = F.when(left.rlike("^[+-]?[0-9]+$"), left.try_cast("int"))
    return F.struct(
        F.when(bar > 0, F.coalesce(number, F.lit(0))).otherwise(0).alias("depth"),
        F.when(bar > 0, right).otherwise(msg).alias("url"),
    )


def decode_live(msg: Column) -> Column:
    """``struct(depth bigint, url)``: a numeric prefix is enough, without one the whole is the url."""
    bar, left, right = _halves(msg)
    hexa = F.regexp_extract(left, r"^\s*([+-]?)0[xX]([0-9a-fA-F]+)", 2)
    sign = F.when(F.regexp_extract(left, r"^\s*([+-]?)", 1) == "-", -1).otherwise(1)
    decimal = F.regexp_extract(left, r"^\s*([+-]?[0-9]+)", 1).try_cast("bigint")
    depth = F.when(hexa != "", sign * F.conv(hexa, 16, 10).try_cast("bigint")).otherwise(decimal)
    parsed = (bar > 0) & depth.isNotNull()
    return F.struct(
        F.when(parsed, depth).otherwise(F.lit(0).cast("bigint")).alias("depth"),
        F.when(parsed, right).otherwise(msg).alias("url"),
    )
