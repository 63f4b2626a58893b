"""Quality rules: learned decision lists over text statistics.

``statistics`` computes whole-text figures with column functions only. ``learn`` finds an ordered list of rules by
sequential covering: a conjunction of thresholds is grown condition by condition on two thirds of the labelled rows,
pruned on the rest, kept while it is precise, and the rows it covers are set aside. ``verdict`` turns the list into
one conditional expression, so judging is part of the same pass as the statistics.

Null or empty text has no words and all counts zero. Labelled rows with a null label or identifier, or without text,
teach nothing. With no labelled rows, or one class only, the list is empty and rejects nothing.

The teaching rows are the ``TEACHING_ROWS`` labelled rows with the least hashes of their identifiers: a fixed bound
on what the driver sees. Everything else covers all rows. Teaching is deterministic.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from math import log2

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlweave.llm.common import words

#: Labelled rows that are used at most for learning.
TEACHING_ROWS = 20_000
#: Most rules, most conditions in a rule, least rows a rule covers, and least precision.
RULES, CONDITIONS, LEAST_ROWS, PRECISION = 12, 3, 10, 0.98
#: Characters that count as symbols.
SYMBOLS = "[#*$%&|<>]"
#: What rules may look at: shares and means, so that long and short texts are measured alike.
FIGURES = ("word_length", "symbol_share", "repeat_share", "dup_line_share", "line_words", "bang_share", "upper_share", "short_line_share")


def _count(text: Column, one: str) -> Column:
    """Characters of the class ``one``."""
    return F.length(F.regexp_replace(text, f"[^{one[1:-1]}]+", ""))


def _held(value: Column) -> Column:
    """``value``, in a form that keeps a filter on it from being computed in its place once more for each use."""
    return F.when(F.monotonically_increasing_id() >= 0, value)


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words`` (long), and ``FIGURES``.

    Columns of those names are replaced. For repeated words, window hashes are sorted with their places; equal
    neighbours give the places of repeated windows, and the words they cover are summed from the gaps between places.
    A text without repeats is settled by a distinct count.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    d = docs.withColumn("_w", words(F.col(text)))
    d = d.withColumn("_win", F.when(F.size("_w") >= 3, F.transform(F.sequence(F.lit(0), F.size("_w") - 3), lambda i: F.xxhash64(*[F.get("_w", i + k) for k in range(3)]))))
    d = d.withColumn("_lines", F.filter(F.split(whole, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")))
    d = d.withColumns(
        {
            "n_words": F.size("_w").cast("long"),
            "word_chars": F.length(F.array_join("_w", "")).cast("long"),
            "n_symbols": _count(whole, SYMBOLS).cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "_n_lines": F.size("_lines"),
            "_bang": _count(whole, "[!?]"),
            "_upper": _count(whole, "[A-Z]"),
            "_short": F.size(F.filter("_lines", lambda line: F.length(line) < 20)),
            "_repeats": F.when(F.size(F.array_distinct("_win")) < F.size("_win"), F.col("_win")),
        }
    ).drop("_w", "_lines", "_win")
    placed = F.sort_array(F.transform("_repeats", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    d = d.withColumn("_placed", F.when(F.col("_repeats").isNotNull(), placed)).drop("_repeats")
    pairs = F.zip_with(
        F.slice("_placed", F.lit(1), F.size("_placed") - 1), F.slice("_placed", F.lit(2), F.size("_placed") - 1),
        lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])),
    )
    d = d.withColumn("_at", F.when(F.col("_placed").isNotNull(), F.array_sort(F.array_distinct(F.flatten(F.array_compact(pairs)))))).drop("_placed")
    gaps = F.zip_with(
        F.slice("_at", F.lit(1), F.size("_at") - 1), F.slice("_at", F.lit(2), F.size("_at") - 1),
        lambda a, b: F.least(b - a, F.lit(3)),
    )
    covered = F.when(F.size("_at") > 0, F.aggregate(gaps, F.lit(3), lambda total, gap: total + gap))
    d = d.withColumn("n_repeat_words", _held(F.coalesce(covered, F.lit(0)).cast("long"))).drop("_at")
    share = lambda a, b: (F.col(a) / F.greatest(F.col(b), F.lit(1))).cast("double")
    return d.withColumns(
        {
            "word_length": share("word_chars", "n_words"), "symbol_share": share("n_symbols", "n_words"),
            "repeat_share": share("n_repeat_words", "n_words"), "dup_line_share": share("n_dup_lines", "_n_lines"),
            "line_words": share("n_words", "_n_lines"), "bang_share": share("_bang", "n_words"),
            "upper_share": share("_upper", "word_chars"), "short_line_share": share("_short", "_n_lines"),
        }
    ).drop("_n_lines", "_bang", "_upper", "_short")


def base_failed() -> Column:
    """Fewer than 50 words, or more than half of them in repeated windows."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    """``figure >= cut`` or ``figure < cut``."""

    figure: str
    above: bool
    cut: float

    def holds(self, row: dict) -> bool:
        return (row[self.figure] >= self.cut) == self.above

    def column(self) -> Column:
        return F.col(self.figure) >= self.cut if self.above else F.col(self.figure) < self.cut


Rule = tuple[Condition, ...]


def _gain(bad: np.ndarray, covered: np.ndarray, bad_before: int, before: int) -> np.ndarray:
    """Information gained per covered bad row, times those rows."""
    some = np.maximum(bad, 1)
    return np.where(bad > 0, bad * (np.log2(some / np.maximum(covered, 1)) - log2(bad_before / before)), 0.0)


def _grow(rows: list[dict]) -> Rule:
    """Conditions that gain most, one after the other; a cut is tried between every two neighbouring values of a figure."""
    rule: Rule = ()
    while len(rule) < CONDITIONS:
        marks = np.array([r["bad"] for r in rows], np.int64)
        bad, n = int(marks.sum()), len(rows)
        if bad in (0, n):
            break
        best, most = None, 0.0
        for figure in FIGURES:
            values = np.array([r[figure] for r in rows], np.float64)
            order = np.argsort(values, kind="stable")
            values, below_bad = values[order], np.cumsum(marks[order])
            ends = np.flatnonzero(values[1:] > values[:-1])  # last rows below a boundary
            cuts, b, below = (values[ends] + values[ends + 1]) / 2, below_bad[ends], ends + 1
            cuts = np.where(cuts > values[ends], cuts, values[ends + 1])  # neighbours may leave no number between them
            for above, gains in ((False, _gain(b, below, bad, n)), (True, _gain(bad - b, n - below, bad, n))):
                at = int(gains.argmax()) if len(gains) else 0
                if len(gains) and gains[at] > most:
                    best, most = Condition(figure, above, float(cuts[at])), float(gains[at])
        if best is None:
            break
        rule += (best,)
        rows = [r for r in rows if best.holds(r)]
    return rule


def _covered(rule: Rule, rows: list[dict]) -> list[dict]:
    return [r for r in rows if all(c.holds(r) for c in rule)]


def _worth(rule: Rule, rows: list[dict]) -> tuple[float, int]:
    covered = _covered(rule, rows)
    bad = sum(r["bad"] for r in covered)
    return ((bad + 1) / (len(covered) + 2) if covered else 0.0), bad


def _prune(rule: Rule, rows: list[dict]) -> Rule:
    """Drop last conditions while precision on rows not used for growing does not fall."""
    while len(rule) > 1 and _worth(rule[:-1], rows)[0] >= _worth(rule, rows)[0]:
        rule = rule[:-1]
    return rule


def cover(rows: list[dict]) -> list[Rule]:
    """The decision list for rows of ``FIGURES`` and ``bad`` (0 or 1)."""
    rules: list[Rule] = []
    grow, prune = [r for i, r in enumerate(rows) if i % 3], rows[::3]
    while len(rules) < RULES and any(r["bad"] for r in grow):
        rule = _prune(_grow(grow), prune)
        covered = _covered(rule, grow) + _covered(rule, prune)
        bad = sum(r["bad"] for r in covered)
        if not rule or len(covered) < LEAST_ROWS or bad < PRECISION * len(covered) or not _worth(rule, prune)[1]:
            break
        rules.append(rule)
        grow = [r for r in grow if not all(c.holds(r) for c in rule)]
        prune = [r for r in prune if not all(c.holds(r) for c in rule)]
    return rules


def learn(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "quality") -> list[Rule]:
    """The decision list that tells rejected rows (label 0) from kept ones (label 1)."""
    chosen = (
        labels.select(key, label).where(F.col(key).isNotNull() & F.col(label).isNotNull()).dropDuplicates([key])
        .orderBy(F.xxhash64(key), key).limit(TEACHING_ROWS)
    )
    taught = statistics(docs.select(key, text).where(F.col(text).isNotNull()).join(F.broadcast(chosen), key), text)
    rows = taught.where(~base_failed()).select(key, (1 - F.col(label)).alias("bad"), *FIGURES).orderBy(F.xxhash64(key), *FIGURES).limit(TEACHING_ROWS).collect()
    return cover([r.asDict() for r in rows])


def verdict(rules: list[Rule]) -> Column:
    """True where no rule of the list rejects the row."""
    if not rules:
        return F.lit(True)
    first, *rest = [reduce(lambda a, b: a & b, [c.column() for c in rule]) for rule in rules]
    return reduce(lambda out, rule: out.when(rule, F.lit(False)), rest, F.when(first, F.lit(False))).otherwise(F.lit(True))


def judge(docs: DataFrame, rules: list[Rule], text: str = "text") -> DataFrame:
    """``docs`` with their statistics, ``base_failed`` and ``kept``."""
    return statistics(docs, text).withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & verdict(rules))
