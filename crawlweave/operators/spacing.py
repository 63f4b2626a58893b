"""Greedy minimum-gap selection per key: the host throttle and the rules cache.

In key order a row is granted when its clock is at least ``gap`` past the last granted clock. That
is a serial rule, but the only thing that passes from one stretch of time to the next is the last
granted clock. So every (key, time bucket) is summarised on its own as a step function "last grant
before the bucket -> last grant after it". Step functions compose, and composing is associative: blocks of
neighbouring buckets become one step function each, level by level, and the last grants are handed down the same way.
Every bucket is then resolved on its own. Rows of one clock tick collapse to one point per gap first, so
the size of a bucket is bounded by its width and not by the traffic, and no task sees all buckets of a key.

All passes stream over sorted partitions and handle many small groups per array operation.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlweave.session import stage

# One bucket covers this many clock units (an hour of milliseconds).
BUCKET_WIDTH = 3_600_000
# Neighbouring step functions that are composed into one.
FAN = 64
_NEVER = -(1 << 62)


def _group_starts(pdf: pd.DataFrame) -> np.ndarray:
    key, bucket = pdf["key"].to_numpy(), pdf["bucket"].to_numpy()
    changed = (key[1:] != key[:-1]) | (bucket[1:] != bucket[:-1])
    return np.append(0, np.flatnonzero(changed) + 1)


def _whole_groups(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Regroup sorted batches so that no (key, bucket) is spread over two of them."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if batch.empty:
            continue
        cut = int(_group_starts(batch)[-1])
        if held:
            last, first = held[-1].iloc[-1], batch.iloc[0]
            if last["key"] != first["key"] or last["bucket"] != first["bucket"]:
                yield pd.concat(held, ignore_index=True)
                held = []
        if cut:
            yield pd.concat([*held, batch.iloc[:cut]], ignore_index=True)
            held = []
        held.append(batch.iloc[cut:])
    if held:
        yield pd.concat(held, ignore_index=True)


class _Points:
    """Sorted points of many groups on one axis, far enough apart that no gap reaches across."""

    def __init__(self, pdf: pd.DataFrame, width: int):
        self.clock = pdf["clock"].to_numpy(np.int64)
        self.gap = pdf["gap"].to_numpy(np.int64)
        self.tie = pdf["tie"].to_numpy(np.int64)
        self.n = len(pdf)
        self.starts = _group_starts(pdf)
        self.group = np.repeat(np.arange(len(self.starts)), np.diff(np.append(self.starts, self.n)))
        self.opens_at = pdf["bucket"].to_numpy(np.int64)[self.starts] * width
        self.reach = int(self.gap.max())
        self.span = width + 2 * self.reach + 2
        self.place = self.group * self.span + (self.clock - self.opens_at[self.group])
        # highest last grant that lets some point up to here be granted
        self.best = np.maximum.accumulate(self.place - self.gap + self.reach)
        self.following = self._following()

    def _following(self) -> np.ndarray:
        """Index of the first point that may be granted after a grant at each point; n if none."""
        following = np.full(self.n, self.n, dtype=np.int64)
        for g in np.unique(self.gap):
            members = np.flatnonzero(self.gap == g)
            at = np.searchsorted(self.place[members], self.place + g, side="left")
            following = np.minimum(following, np.append(members, self.n)[at])
        inside = np.append(self.group, -1)[following] == self.group
        return np.where(inside, following, self.n)

    def last_in_chain(self) -> np.ndarray:
        """Index of the last grant of the bucket if each point is granted."""
        final = np.where(self.following < self.n, self.following, np.arange(self.n))
        while True:
            further = final[final]
            if np.array_equal(further, final):
                return final
            final = further

    def granted(self, entry: np.ndarray) -> np.ndarray:
        """Grants of every group, given the last grant before it."""
        since = np.maximum(entry - self.opens_at, -self.reach)
        target = np.arange(len(self.starts)) * self.span + since + self.reach
        at = np.searchsorted(self.best, target, side="left")
        at = at[np.append(self.group, -1)[at] == np.arange(len(self.starts))]
        chosen = np.zeros(self.n, dtype=bool)
        while len(at):
            chosen[at] = True
            at = self.following[at]
            at = at[at < self.n]
        return chosen


def _summaries(pdf: pd.DataFrame, width: int) -> pd.DataFrame:
    """Step function per group: with a last grant <= ``upto`` (smallest that fits) it ends at ``leaves``."""
    p = _Points(pdf, width)
    steps = np.flatnonzero(np.append(True, p.best[1:] > p.best[:-1]))
    group, upto, leaves = p.group[steps], (p.clock - p.gap)[steps], p.clock[p.last_in_chain()][steps]
    # a grant before the bucket cannot be later than its start, so further steps are out of reach
    needed = np.append(True, (group[1:] != group[:-1]) | (upto[:-1] < p.opens_at[group[:-1]] - 1))
    steps, group, upto, leaves = steps[needed], group[needed], upto[needed], leaves[needed]
    end_of_run = np.append((group[1:] != group[:-1]) | (leaves[1:] != leaves[:-1]), True)
    rows = pdf.iloc[steps[end_of_run]]
    return pd.DataFrame(
        {"key": rows["key"].to_numpy(), "bucket": rows["bucket"].to_numpy(), "upto": upto[end_of_run], "leaves": leaves[end_of_run]}
    )


class _Slots:
    """Step functions of many blocks: each block has up to ``FAN`` parts in order, a slot holds the steps of one part."""

    def __init__(self, pdf: pd.DataFrame):
        self.starts = _group_starts(pdf)
        part = pdf["part"].to_numpy(np.int64)
        n = len(pdf)
        fresh = np.append(True, part[1:] != part[:-1])
        fresh[self.starts] = True
        self.first = np.flatnonzero(fresh)  # of each slot, its first step
        self.end = np.append(self.first[1:], n)
        block = np.repeat(np.arange(len(self.starts)), np.diff(np.append(self.starts, n)))
        self.block = block[self.first]
        self.opening = np.searchsorted(self.block, np.arange(len(self.starts)))  # of each block, its first slot
        self.length = np.bincount(self.block, minlength=len(self.starts))
        self.upto, self.leaves = pdf["upto"].to_numpy(np.int64), pdf["leaves"].to_numpy(np.int64)
        # all steps on one axis: slot after slot, clocks counted from just below the least step of the block
        self.base = np.minimum.reduceat(self.upto, self.starts) - 1
        top = np.maximum(np.maximum.reduceat(self.upto, self.starts), np.maximum.reduceat(self.leaves, self.starts))
        self.span = int((top - self.base).max()) + 2
        slot = np.repeat(np.arange(len(self.first)), self.end - self.first)
        self.axis = slot * self.span + (self.upto - self.base[block])

    def walk(self, block: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For walkers that enter ``block`` with a last grant: (walker, slot, grant before it) of every part, and the grant at the end.

        All walkers take their next part at the same time, so there are at most ``FAN`` steps of whole arrays.
        """
        last = last.copy()
        seen = []
        for turn in range(int(self.length.max(initial=0))):
            walker = np.flatnonzero(self.length[block] > turn)
            slot, at = self.opening[block[walker]] + turn, last[walker]
            seen.append((walker, slot, at))
            place = slot * self.span + np.clip(at - self.base[block[walker]], 0, self.span - 1)
            step = np.searchsorted(self.axis, place, side="left")
            moves = step < self.end[slot]
            last[walker[moves]] = self.leaves[step[moves]]
        return (*(np.concatenate(x) for x in zip(*seen, strict=True)), last)


def _composed(pdf: pd.DataFrame, width: int) -> pd.DataFrame:
    """One step function per block from those of its parts; ``width`` is the clock width of a block.

    The function changes only where some part's does, so it is known from one walker for each step that a grant before
    the block can reach, and one beyond.
    """
    p = _Slots(pdf)
    block = np.repeat(np.arange(len(p.starts)), np.diff(np.append(p.starts, len(pdf))))
    opens_at = pdf["bucket"].to_numpy(np.int64)[p.starts] * width
    order = np.lexsort((p.upto, block))
    block, upto = block[order], p.upto[order]
    distinct = np.append(True, (block[1:] != block[:-1]) | (upto[1:] != upto[:-1]))
    block, upto = block[distinct], upto[distinct]
    needed = np.append(True, (block[1:] != block[:-1]) | (upto[:-1] < opens_at[block[:-1]] - 1))
    block, upto = block[needed], upto[needed]
    *_, leaves = p.walk(block, upto)
    end_of_run = np.append((block[1:] != block[:-1]) | (leaves[1:] != leaves[:-1]), True)
    rows = pdf.iloc[p.starts[block[end_of_run]]]
    return pd.DataFrame(
        {"key": rows["key"].to_numpy(), "bucket": rows["bucket"].to_numpy(), "upto": upto[end_of_run], "leaves": leaves[end_of_run]}
    )


def _entered(pdf: pd.DataFrame) -> pd.DataFrame:
    """Last grant before each part of a block; a block's own last grant is in ``entry`` of its first row, which has no step."""
    heads = pdf["part"].isna().to_numpy()
    given = pdf.loc[heads, ["key", "bucket", "entry"]]
    pdf = pdf[~heads]
    p = _Slots(pdf)
    first = pdf.iloc[p.starts]
    entry = first[["key", "bucket"]].merge(given, "left", ["key", "bucket"])["entry"].fillna(_NEVER).astype("int64")
    _, slot, before, _ = p.walk(np.arange(len(p.starts)), entry.to_numpy())
    rows = pdf.iloc[p.first[slot]]
    return pd.DataFrame({"key": rows["key"].to_numpy(), "bucket": rows["part"].to_numpy(np.int64), "entry": before})


def _entries(steps: DataFrame, width: int) -> DataFrame:
    """Last grant before each bucket (``key``, ``bucket``, ``entry``).

    A scan in parallel: ``FAN`` neighbouring step functions at a time are composed into one, level by level, until no
    key has more than ``FAN``. Then the last grants are handed down, level by level. At every level a block is a group of
    its own, so no task needs all buckets of a key, however long its history is.
    """
    per_key = lambda df: df.groupBy("key").agg(F.count_distinct("bucket").alias("n")).agg(F.max("n")).first()[0] or 0
    block = F.floor(F.col("bucket") / FAN).cast("bigint")
    levels, span = [stage(steps, "steps")], width

    def blocks_of(df: DataFrame, above: Column) -> DataFrame:
        return df.select("key", above.alias("bucket"), F.col("bucket").alias("part"), "upto", "leaves")

    def composing(span: int):
        def compose(batches):
            for pdf in _whole_groups(batches):
                yield _composed(pdf, span)

        return compose

    while per_key(levels[-1]) > FAN:
        span *= FAN
        parts = blocks_of(levels[-1], block).repartition("key", "bucket").sortWithinPartitions("key", "bucket", "part", "upto")
        levels.append(stage(parts.mapInPandas(composing(span), "key string, bucket bigint, upto bigint, leaves bigint"), "steps"))

    def enter(batches):
        for pdf in _whole_groups(batches):
            if pdf["part"].notna().any():
                yield _entered(pdf)

    entries, above = None, F.lit(0).cast("bigint")
    for level in reversed(levels):
        rows = blocks_of(level, above).withColumn("entry", F.lit(None).cast("bigint"))
        if entries is not None:
            rows = rows.unionByName(entries, allowMissingColumns=True)
        rows = rows.repartition("key", "bucket").sortWithinPartitions("key", "bucket", "part", "upto")
        entries = rows.mapInPandas(enter, "key string, bucket bigint, entry bigint")
        above = block
    return entries


def _resolve(pdf: pd.DataFrame, width: int) -> pd.DataFrame:
    """Grants of whole groups; the first row of each group (gap 0) carries its entry as ``clock``."""
    heads = pdf["gap"].to_numpy() == 0
    entry = pdf["clock"].to_numpy(np.int64)[heads]
    pdf = pdf[~heads]
    p = _Points(pdf, width)
    grants = np.flatnonzero(p.granted(entry))
    ticks = p.place[grants]
    at = np.searchsorted(ticks, p.place, side="left")
    # a grant on this very tick, and the last one strictly before it
    same = np.append(ticks, -1)[at] == p.place
    before = np.append(grants, -1)[at - 1]
    inside = (at > 0) & (p.group[before] == p.group)
    return pd.DataFrame(
        {
            "key": pdf["key"].to_numpy(),
            "clock": p.clock,
            "gap": p.gap,
            "before": np.where(inside, p.clock[before], entry[p.group]),
            "grant_tie": pd.array(np.append(p.tie[grants], 0)[at], dtype="Int64"),
        }
    ).assign(grant_tie=lambda d: d["grant_tie"].where(same))


def greedy_spacing(
    df: DataFrame,
    keys: Sequence[str],
    clock: str,
    gap: Column,
    tie: str,
    width: int = BUCKET_WIDTH,
) -> DataFrame:
    """Add ``granted``, ``last_grant`` (the grant in force after the row) and ``wait``.

    ``clock`` and ``gap`` are whole numbers in the same unit with ``gap > 0``; ``tie`` is a bigint
    that is unique per key and orders rows of the same clock. A row without a key is granted.
    """
    keys = list(keys)
    rows = df.withColumns({"__clock": F.col(clock).cast("bigint"), "__gap": F.greatest(gap.cast("bigint"), F.lit(1))})
    usable = F.lit(True)
    for k in keys:
        usable = usable & F.col(k).isNotNull()
    # one text key, whatever the key types are
    text = F.col(keys[0]).cast("string") if len(keys) == 1 else F.to_json(F.struct(*keys))
    rows = rows.withColumn("__key", F.when(usable, text))
    points = (
        rows.where("__key is not null")
        .groupBy(F.col("__key").alias("key"), F.col("__clock").alias("clock"), F.col("__gap").alias("gap"))
        .agg(F.min(F.col(tie).cast("bigint")).alias("tie"))
        .select("key", F.floor(F.col("clock") / F.lit(width)).cast("bigint").alias("bucket"), "clock", "gap", "tie")
    )

    def summarise(batches):
        for pdf in _whole_groups(batches):
            yield _summaries(pdf, width)

    def resolve(batches):
        for pdf in _whole_groups(batches):
            yield _resolve(pdf, width)

    steps = (
        points.repartition("key", "bucket")
        .sortWithinPartitions("key", "bucket", "clock", "tie")
        .mapInPandas(summarise, "key string, bucket bigint, upto bigint, leaves bigint")
    )
    entries = _entries(steps, width)
    zero = F.lit(0).cast("bigint")
    heads = entries.select("key", "bucket", F.col("entry").alias("clock"), zero.alias("gap"), zero.alias("tie"))
    resolved = (
        points.unionByName(heads)
        .repartition("key", "bucket")
        .sortWithinPartitions("key", "bucket", F.col("gap") > 0, "clock", "tie")
        .mapInPandas(resolve, "key string, clock bigint, gap bigint, before bigint, grant_tie bigint")
        .withColumnsRenamed({"key": "__key", "clock": "__clock", "gap": "__gap"})
    )
    joined = rows.join(resolved, ["__key", "__clock", "__gap"], "left")
    free = F.col("__key").isNull()
    granted = free | F.coalesce(F.col("grant_tie") == F.col(tie).cast("bigint"), F.lit(False))
    after = F.when(F.col(tie).cast("bigint") >= F.col("grant_tie"), F.col("__clock")).otherwise(F.col("before"))
    last = F.when(free, F.lit(None).cast("bigint")).otherwise(after)
    wait = F.when(granted, F.lit(0).cast("bigint")).otherwise(F.col("__gap") - (F.col("__clock") - last))
    return joined.withColumns({"granted": granted, "last_grant": last, "wait": wait}).drop(
        "__key", "__clock", "__gap", "before", "grant_tie"
    )
