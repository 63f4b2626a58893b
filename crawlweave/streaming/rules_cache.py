"""The robots rules cache as keyed state: every dispatch is judged by the copy its site's cache holds at that moment.

State of a site: the file it serves, the cached copy with the time of its fetch, and the rows that the watermark has not passed
yet. When it has, the rows are taken in the order of their clocks. A served file changes the site and not the copy. A dispatch that
finds no copy, or one that is ``CACHE_TTL_MS`` old, fetches: the file served now becomes the copy. An event timer clears
the copy when it is that old, so copies are held for the sites that were asked within the last half hour only.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from crawlweave.functions import urls
from crawlweave.operators.robots import CACHE_TTL_MS, parse_robots
from crawlweave.streaming.gate import SPREAD

_RULES = "served_ms bigint, disallows array<string>, allows array<string>"
_ROW = f"seq bigint, path string, clock bigint, {_RULES}"
_OUT = "seq bigint, base_url string, clock bigint, refetched boolean, rules_fetched_ms bigint, served_ms bigint, allowed boolean"
_FIELDS = ["seq", "path", "clock", "served_ms", "disallows", "allows"]


def _longest(paths: list[str] | None, path: str) -> int:
    return max((len(p) for p in paths or () if path.startswith(p)), default=-1)


class _Cache(StatefulProcessor):
    def __init__(self, ttl_ms: int):
        self.ttl = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.site = handle.getValueState("site", _RULES)
        self.copy = handle.getValueState("copy", f"fetched_ms bigint, {_RULES}")
        self.waiting = handle.getListState("waiting", _ROW)

    @staticmethod
    def _frame(rows: list[tuple]) -> pd.DataFrame:
        frame = pd.DataFrame(rows, columns=[c.split()[0] for c in _OUT.split(", ")], dtype=object)
        return frame.astype({c: "Int64" for c in ("seq", "clock", "rules_fetched_ms", "served_ms")} | {c: "boolean" for c in ("refetched", "allowed")})

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held, free = [], []
        for frame in rows:
            for known, row in zip(frame["known"], frame[_FIELDS].astype(object).itertuples(index=False, name=None)):
                lists = tuple(None if x is None else [str(p) for p in x] for x in row[4:])
                whole = tuple(None if x is None or x != x else x for x in row[:4])
                row = tuple(int(x) if i != 1 and x is not None else x for i, x in enumerate(whole)) + lists
                if known:
                    held.append(row)
                else:  # no address to ask
                    free.append((row[0], None, row[2], True, None, None, False))
        if held:
            self.waiting.appendList(held)
            self.handle.registerTimer(min(r[2] for r in held))
        yield self._frame(free)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs()
        rows = [tuple(r) for r in self.waiting.get()] if self.waiting.exists() else []
        rows.sort(key=lambda r: (r[2], r[0] is not None, r[0] or 0, r[4:] if r[0] is None else ()))  # files before dispatches of their tick
        site = tuple(self.site.get()) if self.site.exists() else (None, None, None)
        copy = tuple(self.copy.get()) if self.copy.exists() else None
        out, done = [], 0
        for seq, path, clock, *rules in rows:
            if clock > now:
                break
            done += 1
            if seq is None:
                site = tuple(rules)
                continue
            fetch = copy is None or clock - copy[0] >= self.ttl
            if fetch:
                copy = (clock, *site)
            fetched, served, disallows, allows = copy
            allowed = path is not None and (disallows is None or _longest(allows, path) >= _longest(disallows, path))
            out.append((seq, key[0], clock, fetch, fetched, served, allowed))
        if site[1] is not None:
            self.site.update(site)
        if done < len(rows):
            if done:
                self.waiting.put(rows[done:])
            self.handle.registerTimer(rows[done][2])
        else:
            self.waiting.clear()
        if copy is None or now - copy[0] >= self.ttl and done == len(rows):
            self.copy.clear()
        else:
            self.copy.update(copy)
            if now - copy[0] < self.ttl:
                self.handle.registerTimer(copy[0] + self.ttl)
        yield self._frame(out)


def judged_feed(
    dispatches: DataFrame, served: DataFrame, agent: str, clock: str = "t_ms", order: str = "seq", url: str = "url",
    lateness: str = "10 minutes", ttl_ms: int = CACHE_TTL_MS,
) -> DataFrame:
    """Stream of ``seq, base_url, clock, refetched, rules_fetched_ms, served_ms, allowed`` for every dispatch.

    ``dispatches`` and ``served`` (``base_url, served_ms, status, body``) are streams; rows may be late by up to ``lateness``, by
    which verdicts are held back, and Spark drops later ones. Clocks must not be null, and dispatches need an ``order``. Of files of one
    tick the one that sorts last counts, and files come before the dispatches of their tick.
    """
    asked = dispatches.select(
        F.col(order).cast("bigint").alias("seq"), urls.base_url(F.col(url)).alias("base_url"), urls.path(F.col(url)).alias("path"),
        F.col(clock).cast("bigint").alias("clock"),
    )
    files = parse_robots(served, agent, keep=["served_ms"]).select("base_url", F.col("served_ms").alias("clock"), "served_ms", "disallows", "allows")
    both = asked.unionByName(files, allowMissingColumns=True)
    spread = F.concat(F.lit("\0"), F.pmod(F.xxhash64("seq"), F.lit(SPREAD)).cast("string"))
    keyed = both.select(
        F.coalesce("base_url", spread).alias("base_url"), F.col("base_url").isNotNull().alias("known"), *_FIELDS, F.timestamp_millis("clock").alias("at")
    )
    return keyed.withWatermark("at", lateness).groupBy("base_url").transformWithStateInPandas(_Cache(ttl_ms), _OUT, "append", "EventTime")
