"""Benchmark decontamination by winnowing.

A window is ``WINDOW`` consecutive words of a benchmark item, or the whole item where it is shorter. Of all runs of
``GRAM`` words inside a window the one with the least hash is kept as its fingerprint. A document that contains the
window contains the same runs, so it keeps the same fingerprint: no shared window can be missed. Documents that share
a fingerprint are candidates; there the hit is extended over all windows of the item, compared by 128 bits of hash,
and the words covered by matching windows are counted.

Only distinct texts are examined, so copies cost nothing. There is one plan for benchmarks of every size: a bit set of
``FILTER_BITS`` bits, whose size is fixed, is sent to every task and lets only those fingerprints and windows of documents
go on whose bit some benchmark row has set; what passes is joined by its full hash. Frequent passages
are split by Spark's skew handling, as nothing is gathered per passage.

A null or empty document has no words and is not contaminated. An item without words has no windows. Hits of items
with a null identifier count as hit words but not as items. Repeated items and documents are fine.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlweave.functions.text import bind
from crawlweave.llm.common import NOT_ALNUM, ascii_lower, words
from crawlweave.session import stage

#: Words in a window, and in a hashed run.
WINDOW, GRAM = 13, 6
#: Bits of the set that is sent to every task, 2 MB in all: up to some 170,000 hashes one other hash in a hundred passes it.
FILTER_BITS = 1 << 24
#: Separators of words as in ``NOT_ALNUM`` for text that is not lower-cased yet.
_SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def text_key(text: Column) -> Column:
    """128 bits that name a text."""
    return F.unhex(F.md5(text))


def _over(values: Column, n: int, of: Callable[..., Column]) -> Column:
    """``of`` each run of ``n`` neighbours in an array; at least ``n`` are needed."""
    return bind(values, lambda v: F.transform(F.sequence(F.lit(0), F.size(v) - n), lambda i: of(*[F.get(v, i + k) for k in range(n)])))


def fingerprints(w: str, length: int) -> Column:
    """The distinct fingerprints of all windows of ``length`` words; empty where there are fewer words."""
    gram = min(GRAM, length)
    span = length - gram + 1
    marks = _over(F.transform(w, lambda x: F.xxhash64(x)), gram, F.xxhash64)
    if span > 1:
        marks = _over(marks, span, F.least)
    return F.when(F.size(w) >= length, F.array_distinct(marks)).otherwise(F.array().cast("array<bigint>"))


def windows(w: Column, length: int) -> Column:
    """All windows, each with its first word's place and 128 bits of hash."""
    two = lambda i: F.struct(i.alias("start"), F.xxhash64(F.slice(w, i, length)).alias("a"), F.xxhash64(F.lit(length), F.slice(w, i, length)).alias("b"))
    return F.when(F.size(w) >= length, F.transform(F.sequence(F.lit(1), F.size(w) - length + 1), two))


def _bit(hashed: Column) -> tuple[Column, Column]:
    """Word and place in the bit set, from the upper bits of a hash."""
    place = F.shiftrightunsigned(hashed, 64 - (FILTER_BITS.bit_length() - 1))
    return F.shiftright(place, 6).cast("int"), place.bitwiseAND(F.lit(63)).cast("int")


def seldom_others(known: DataFrame, column: str) -> Callable[[Column], Column]:
    """A test that every hash in ``known`` passes and few others; the bits are one array of fixed length in a scalar subquery."""
    word, place = _bit(F.col(column))
    bits = F.bit_or(F.expr("shiftleft(1L, place)"))
    some = known.select(word.alias("word"), place.alias("place")).groupBy("word").agg(bits.alias("bits"))
    every = known.sparkSession.range(FILTER_BITS // 64).select(F.col("id").cast("int").alias("word"))
    full = every.join(some, "word", "left").select("word", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"))
    packed = full.agg(F.array_sort(F.collect_list(F.struct("word", "bits")))["bits"].alias("bits")).scalar()

    def passes(hashed: Column) -> Column:
        at, place = _bit(hashed)
        return F.call_function("shiftrightunsigned", F.get(packed, at), place).bitwiseAND(F.lit(1).cast("long")) == 1

    return passes


def _every(lengths: list[int], make) -> Column:
    """For each window length, ``make(length)`` (an array), tagged with the length; one array of all."""

    def tagged(n: int) -> Column:
        return F.transform(F.coalesce(make(n), F.array()), lambda x: F.struct(F.lit(n).alias("m"), x.alias("x")))

    return F.flatten(F.array(*map(tagged, lengths)))


def covered(spans: Column) -> Column:
    """Places covered by an array of ``(start, m)`` structs."""
    start = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("total"))

    def add(state: Column, span: Column) -> Column:
        end = (span["start"] + span["m"]).cast("long")
        return F.struct(
            F.greatest(state["end"], end).alias("end"),
            (state["total"] + F.greatest(F.lit(0).cast("long"), end - F.greatest(state["end"], span["start"].cast("long")))).alias("total"),
        )

    return F.aggregate(F.array_sort(spans), start, add, lambda state: state["total"])


def hits(docs: DataFrame, items: DataFrame, text: str = "text", item_text: str = "text", item_id: str = "item_id") -> DataFrame:
    """For each distinct text with a hit: ``text_key``, ``spans`` (array of start and length in words) and ``items``."""
    listed = items.select(F.col(item_id).alias("item"), words(ascii_lower(F.col(item_text)), NOT_ALNUM).alias("w")).where(F.size("w") > 0)
    listed = stage(listed.withColumn("length", F.least(F.size("w"), F.lit(WINDOW))), "benchmark")
    lengths = sorted(r.length for r in listed.select("length").distinct().collect())  # WINDOW numbers at most
    texts = docs.select(F.col(text).alias("text")).where(F.col(text).isNotNull())
    if not lengths:
        empty = texts.select(text_key(F.col("text")).alias("text_key"), F.array(F.struct(F.lit(1).alias("start"), F.lit(1).alias("m"))).alias("spans"))
        return empty.withColumn("items", F.array().cast(f"array<{items.schema[item_id].dataType.simpleString()}>")).where(F.lit(False))

    def only(make):
        return lambda n: F.when(F.col("length") == n, make(n))

    marks = stage(listed.select(F.explode(_every(lengths, only(lambda n: fingerprints("w", n)))).alias("f")).select("f.m", F.col("f.x").alias("mark")).distinct(), "marks")
    known = stage(listed.select("item", F.explode(_every(lengths, only(lambda n: windows(F.col("w"), n)))).alias("f")).select("item", "f.m", "f.x.a", "f.x.b").distinct(), "windows")

    keyed = texts.withColumn("text_key", text_key(F.col("text")))
    split = keyed.withColumn("w", words(ascii_lower(F.col("text")), NOT_ALNUM))
    made = split.select("text_key", F.explode(_every(lengths, lambda n: fingerprints("w", n))).alias("f"))
    made = made.select("text_key", "f.m", F.col("f.x").alias("mark")).where(seldom_others(marks, "mark")(F.col("mark")))
    met = made.join(marks, ["m", "mark"], "left_semi")
    candidates = stage(met.select("text_key").distinct(), "candidates")

    # Copies meet in their own task first; then texts and candidates merge by key, whatever the candidates' number.
    near = keyed.dropDuplicates(["text_key"]).join(candidates.hint("merge"), "text_key")
    near = near.withColumn("w", words(ascii_lower(F.col("text")), NOT_ALNUM)).drop("text")
    seen = near.select("text_key", F.explode(_every(lengths, lambda n: windows(F.col("w"), n))).alias("f"))
    seen = seen.select("text_key", "f.m", "f.x.start", "f.x.a", "f.x.b").where(seldom_others(known, "a")(F.col("a")))
    found = seen.join(known, ["m", "a", "b"])
    return found.groupBy("text_key").agg(
        F.collect_set(F.struct("start", "m")).alias("spans"), F.array_sort(F.collect_set("item")).alias("items")
    )


def judge(docs: DataFrame, items: DataFrame, text: str = "text", item_text: str = "text", item_id: str = "item_id") -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit`` (long), ``spans``, ``items`` and ``contaminated``; columns of those names are replaced.

    Contaminated: a hit, and hit words make up at least a twentieth.
    """
    found = hits(docs, items, text, item_text, item_id).select(
        F.col("text_key").alias("_key"), F.col("spans").alias("_spans"), F.col("items").alias("_items")
    )
    counted = docs.withColumn("n_words", F.size(words(F.col(text), _SEPARATORS)).cast("long")).withColumn("_text_key", text_key(F.col(text)))
    joined = counted.join(found, F.col("_text_key") == F.col("_key"), "left")
    joined = joined.withColumns(
        {"n_hit": F.coalesce(covered(F.col("_spans")), F.lit(0).cast("long")), "spans": F.col("_spans"), "items": F.col("_items")}
    ).drop("_key", "_text_key", "_spans", "_items")
    return joined.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))
