"""Near duplicates by bottom-k sketches.

One hash function turns a document into a set of numbers, one for each distinct run of five words. The ``SKETCH``
least numbers are its sketch. Documents with equal sets form a class, and one of each class goes on.

Candidates come from inverted lists of retained values. Two sets with a Jaccard similarity of 0.75 keep, but for a
chance below 1e-8, at least ``least_shared`` values in common, so only the rarest values of a sketch need a list
(the more frequent ones cannot be all that two similar documents share). A value that a third of all documents hold
therefore has a list only for documents that consist of such values. Short lists give their pairs. A long list gives
one pair per member: with its centre, the member with the fewest values of its own. The union sketch of a pair, the
``SKETCH`` least values of both, estimates the similarity and filters; the full sets then decide.

Members of a long list that are not linked to its centre could still be linked to each other. They are compared with
the whole list in blocks of ``BLOCK`` by ``BLOCK`` full sets, which gives links, not pairs. So no list is cut and no link
between different texts is lost, no group of copies is expanded into its pairs, and no task sees more than two blocks.

Links become components by passing least identifiers along links and jumping to the least known one, each round
written to the shared folder. Documents without words are linked with nothing. A row without identifier is in no
component and is kept. Rows that repeat an identifier are one document with the links of all its texts.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crawlweave.session import stage

#: Words in a shingle, retained values, similarity as a fraction.
SHINGLE, SKETCH, SIMILAR = 5, 64, (75, 100)
#: Longest list that gives all its pairs, and members of one side of a block.
SHORT, BLOCK = 8, 256
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
#: Odd multipliers of a published 64-bit mixer.
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None) -> np.ndarray:
    """The sorted distinct 64-bit hashes of the runs of ``SHINGLE`` words; of the whole text where there are fewer."""
    found = _WORD.findall(text.encode("utf-8").translate(_LOWER)) if text else []
    if not found:
        return np.zeros(0, np.int64)
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(w) for w in found], np.uint64)
    n = min(SHINGLE, len(hashes))
    total = np.full(len(hashes) - n + 1, n, np.uint64)
    for i in range(n):
        total = _mixed(total + hashes[i : len(hashes) - n + 1 + i])
    return np.unique(total.view(np.int64))


def _name(s: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set."""
    whole = xxhash.xxh3_128_intdigest(s.tobytes())
    return (whole & (2**64 - 1)) - 2**63, (whole >> 64) - 2**63


def least_shared(n: int) -> int:
    """The fewest values that the sketch of a set of ``n`` shares with that of a similar set.

    Sets that fit their sketch: three quarters of the set, which is exact. Beyond that: the value that a binomial
    sample of ``SKETCH`` with chance 0.75 stays below with a probability of 1e-8.
    """
    a, b = SIMILAR
    if n * b <= a * SKETCH:
        return -(-a * n // b)
    p, total = a / b, 0.0
    for k in range(SKETCH + 1):
        total += math.comb(SKETCH, k) * p**k * (1 - p) ** (SKETCH - k)
        if total > 1e-8:
            return k
    return SKETCH


def _sketches(texts: pa.Array) -> pa.Array:
    """Set size, 128 bits that name the set, and the sketch in ascending order."""
    sets = [shingles(text.as_py()) for text in texts]
    names = np.array([_name(s) for s in sets], np.int64).reshape(-1, 2)
    kept = [s[:SKETCH] for s in sets]
    offsets = np.concatenate([[0], np.cumsum([len(s) for s in kept])]).astype(np.int32)
    sketch = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*kept, np.zeros(0, np.int64)])))
    sizes = pa.array([len(s) for s in sets], pa.int64())
    return pa.StructArray.from_arrays([sizes, pa.array(names[:, 0]), pa.array(names[:, 1]), sketch], ["n", "a", "b", "sketch"])


def _sets(texts: pa.Array) -> pa.Array:
    """The full set, sorted, with the bits that name it."""
    sets = [shingles(text.as_py()) for text in texts]
    names = np.array([_name(s) for s in sets], np.int64).reshape(-1, 2)
    offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
    members = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*sets, np.zeros(0, np.int64)])))
    return pa.StructArray.from_arrays([pa.array(names[:, 0]), pa.array(names[:, 1]), members], ["a", "b", "members"])


def sketch_of(text: str | Column) -> Column:
    return F.arrow_udf(_sketches, "struct<n:bigint,a:bigint,b:bigint,sketch:array<bigint>>")(text)


def set_of(text: str | Column) -> Column:
    """As declared it stays above a join, so that only the rows that met are turned into sets."""
    return F.arrow_udf(_sets, "struct<a:bigint,b:bigint,members:array<bigint>>").asNondeterministic()(text)


def _similar(both: Column, n: Column, m: Column) -> Column:
    """Whether sets of sizes ``n`` and ``m`` with ``both`` common members are linked."""
    a, b = SIMILAR
    return b * both >= a * (n + m - both)


def _rare(classes: DataFrame) -> DataFrame:
    """``id``, ``n``, ``own`` (values no other class holds), and ``value``, ``held``: the values that get a list."""
    values = classes.select("id", "n", F.size("sketch").alias("k"), F.explode("sketch").alias("value"))
    held = values.groupBy("value").agg(F.count("*").alias("held")).where("held > 1")
    shared = stage(values.join(held, "value"), "shared")
    order = Window.partitionBy("id").orderBy("held", "value")
    ranked = shared.withColumns({"rank": F.row_number().over(order), "of": F.count("*").over(Window.partitionBy("id"))})
    fewest = F.array(*[F.lit(least_shared(n)) for n in range(SKETCH + 1)])
    needed = F.when(F.col("n") > SKETCH, F.lit(least_shared(SKETCH + 1))).otherwise(F.get(fewest, F.col("n").cast("int")))
    own = F.col("k") - F.col("of")
    return ranked.withColumn("own", own).where(F.col("rank") + own <= F.col("k") - needed + 1).select("id", "n", "own", "value")


def _fits(n: Column, m: Column) -> Column:
    """Whether sets of these sizes can be linked at all."""
    a, b = SIMILAR
    return b * F.least(n, m) >= a * F.greatest(n, m)


def _estimated(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs whose union sketch does not rule out a link."""
    left = classes.select(F.col("id").alias("x"), F.col("n").alias("n_x"), F.col("sketch").alias("s_x"))
    right = classes.select(F.col("id").alias("y"), F.col("n").alias("n_y"), F.col("sketch").alias("s_y"))
    met = pairs.join(left, "x").join(right, "y").where(_fits(F.col("n_x"), F.col("n_y")))
    union = F.slice(F.array_sort(F.array_union("s_x", "s_y")), 1, SKETCH)
    both = F.size(F.array_intersect(F.array_intersect(union, "s_x"), F.col("s_y")))
    complete = F.greatest("n_x", "n_y") <= SKETCH
    seems = F.when(complete, _similar(F.size(F.array_intersect("s_x", "s_y")), F.col("n_x"), F.col("n_y")))
    return met.where(F.coalesce(seems, both >= least_shared(SKETCH + 1))).select("x", "y", "n_x", "n_y")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs that are linked by their full sets."""
    met = pairs.join(sets.select(F.col("id").alias("x"), F.col("members").alias("m_x")), "x")
    met = met.join(sets.select(F.col("id").alias("y"), F.col("members").alias("m_y")), "y")
    both = F.size(F.array_intersect("m_x", "m_y"))
    return met.where(_similar(both, F.col("n_x"), F.col("n_y"))).select("x", "y")


def _compare(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    """Links between two blocks: common members are counted over the values that occur on both sides."""
    a, b = SIMILAR
    out = {"x": [], "y": []}
    if len(left) and len(right):
        flat_x, flat_y = np.concatenate(left["members"].to_numpy()), np.concatenate(right["members"].to_numpy())
        size_x, size_y = left["members"].map(len).to_numpy(), right["members"].map(len).to_numpy()
        row_x, row_y = np.repeat(np.arange(len(left)), size_x), np.repeat(np.arange(len(right)), size_y)
        both = np.zeros((len(left), len(right)), np.float32)
        common = np.intersect1d(flat_x, flat_y)
        for begin in range(0, len(common), 4096):  # a bounded slice of the incidence tables at a time
            part = common[begin : begin + 4096]
            tables = []
            for flat, row, n in ((flat_x, row_x, len(left)), (flat_y, row_y, len(right))):
                at = np.minimum(np.searchsorted(part, flat), len(part) - 1)
                hit = part[at] == flat
                incidence = np.zeros((n, len(part)), np.float32)
                incidence[row[hit], at[hit]] = 1
                tables.append(incidence)
            both += tables[0] @ tables[1].T
        linked = b * both >= a * (size_x[:, None] + size_y[None, :] - both)
        i, j = np.nonzero(linked)
        frame = pd.DataFrame({"x": left["id"].to_numpy()[i], "y": right["id"].to_numpy()[j], "c": right["component"].to_numpy()[j]})
        # One link of each member to each component on the other side is enough.
        out = frame[frame["x"] != frame["y"]].drop_duplicates(["x", "c"])[["x", "y"]]
    return pd.DataFrame(out).astype("int64")


def components(links: DataFrame) -> DataFrame:
    """``id`` and ``component``, the least identifier reachable, for every identifier in ``links`` (``x``, ``y``)."""
    both = links.unionAll(links.select(F.col("y").alias("x"), F.col("x").alias("y"))).where("x <> y").distinct()
    edges = stage(both, "links")
    state = stage(edges.groupBy("x").agg(F.min("y").alias("least")).select(F.col("x").alias("id"), F.least("x", "least").alias("component")), "component")
    while True:
        told = edges.join(state, edges.y == state.id).groupBy("x").agg(F.min("component").alias("told"))
        heard = state.join(told, state.id == told.x).select("id", "component", F.least("component", "told").alias("new"))
        heard = stage(heard, "heard")
        target = heard.select(F.col("id").alias("new"), F.col("new").alias("jump"))
        moved = stage(heard.join(target, "new").select("id", F.least("new", "jump").alias("component"), (F.least("new", "jump") != F.col("component")).alias("changed")), "component")
        state = moved.select("id", "component")
        if moved.where("changed").isEmpty():
            return state


def class_links(classes: DataFrame, sets_for: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Links (``x``, ``y``) that join all linked classes.

    ``classes`` has id, n and sketch; ``sets_for`` turns wanted ids (``id``) into ``id`` and ``members``, the full set.
    """
    listed = stage(_rare(classes), "lists")
    sizes = listed.groupBy("value").agg(F.count("*").alias("length"), F.min(F.struct("own", "id")).alias("centre")).where("length > 1")
    met = listed.join(sizes, "value")
    short = met.where(F.col("length") <= SHORT).groupBy("value").agg(F.sort_array(F.collect_list(F.struct("id", "n"))).alias("l"))
    left = short.select("l", F.posexplode("l").alias("i", "p"))
    pairs = left.select("p", F.explode(F.slice("l", F.col("i") + 2, SHORT)).alias("q"))
    pairs = pairs.where(_fits(F.col("p.n"), F.col("q.n"))).select(F.col("p.id").alias("x"), F.col("q.id").alias("y"))
    star = stage(met.where(F.col("length") > SHORT).select(F.col("centre.id").alias("x"), F.col("id").alias("y"), "n").distinct(), "stars")
    candidates = pairs.unionAll(star.where("x <> y").select("x", "y"))
    estimated = stage(_estimated(candidates.distinct(), classes), "estimated")

    wanted = estimated.select(F.col("x").alias("id")).unionAll(estimated.select(F.col("y").alias("id"))).unionAll(star.select(F.col("y").alias("id")))
    sets = stage(sets_for(wanted.distinct()), "sets")
    links = stage(_verified(estimated, sets), "links")

    named = components(links)
    named = star.select("y").distinct().join(named, F.col("y") == F.col("id"), "left").select("y", F.coalesce("component", "y").alias("component"))
    # Each step is a table of its own, so that no join shares its partitioning with the sums by centre: a centre with
    # very many members is split where it is joined, and summed in parts before it is shuffled.
    member = stage(star.join(named, "y"), "named")
    centre = stage(member.where("x = y").select("x", F.col("component").alias("home")), "centres")
    member = member.join(centre, "x").select("x", F.col("y").alias("id"), "n", "component", (F.col("component") != F.col("home")).alias("away"))
    member = stage(member, "homes")
    counts = member.groupBy("x").agg(F.count("*").alias("all"), F.sum(F.col("away").cast("long")).alias("away_count")).where("away_count > 0")
    blocks = {"all_blocks": F.ceil(F.col("all") / BLOCK).cast("int"), "away_blocks": F.ceil(F.col("away_count") / BLOCK).cast("int")}
    counts = stage(counts.withColumns(blocks), "counts")
    member = stage(member.join(counts, "x").join(sets, "id"), "members")
    deal = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    others = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    away = member.where("away").select("x", "id", "members", "component", deal("away_blocks").alias("i"), others("all_blocks").alias("j"))
    every = member.select("x", "id", "members", "component", others("away_blocks").alias("i"), deal("all_blocks").alias("j"))
    more = away.groupBy("x", "i", "j").cogroup(every.groupBy("x", "i", "j")).applyInPandas(_compare, "x bigint, y bigint")
    return stage(links.unionAll(more), "links")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` and ``kept`` for every row of ``docs``; ``key`` is a long."""
    rows = docs.select(F.col(key).cast("long").alias("id"), sketch_of(text).alias("s")).select("id", "s.*")
    rows = stage(rows, "sketches")
    named = rows.where("id is not null and n > 0")
    firsts = named.groupBy("a", "b", "n").agg(F.min("id").alias("first"))
    again = F.row_number().over(Window.partitionBy("first").orderBy("a", "b")) > 1  # an identifier that has several texts
    classes = stage(firsts.withColumn("class", F.when(again, F.xxhash64("first", "a", "b")).otherwise(F.col("first"))), "classes")
    keys = ["id", "a", "b", "n"]
    ones = named.join(classes.withColumnRenamed("first", "id"), keys).dropDuplicates(keys)
    ones = stage(ones.select(F.col("class").alias("id"), "n", "sketch"), "ones")
    texts = docs.select(F.col(key).cast("long").alias("first"), F.col(text).alias("text"))

    def sets_for(wanted: DataFrame) -> DataFrame:
        of = wanted.join(classes.select(F.col("class").alias("id"), "first", "a", "b"), "id")
        made = texts.join(of, "first").select("id", "a", "b", set_of("text").alias("s"))
        return made.where("s.a = a and s.b = b").select("id", "s.members").dropDuplicates(["id"])

    links = class_links(ones, sets_for)
    place = classes.select("class", "first")
    links = links.join(place.select(F.col("class").alias("x"), F.col("first").alias("p")), "x")
    links = links.join(place.select(F.col("class").alias("y"), F.col("first").alias("q")), "y").select(F.col("p").alias("x"), F.col("q").alias("y"))
    several = rows.where("id is not null").select("id", "a", "b", "n").distinct().withColumn("of", F.count("*").over(Window.partitionBy("id"))).where("of > 1")
    same = several.join(classes, ["a", "b", "n"]).select(F.col("id").alias("x"), F.col("first").alias("y"))
    joined = components(links.unionAll(same)).select(F.col("id").alias("first"), "component")
    out = rows.select("id", "a", "b", "n").join(classes.select("a", "b", "n", "first"), ["a", "b", "n"], "left")
    out = out.withColumn("first", F.coalesce("first", "id")).join(joined, "first", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "first"))
    return out.select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )
