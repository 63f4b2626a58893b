"""Vector code compression: four one-byte codes a vector, from codebooks trained by member-resident Lloyd rounds.

A vector is cut into four consecutive parts. The parts live in blocks that are partitioned by (position, entry, salt):
an owner holds members of one codebook entry. Each round the owners add up their resident members, the few sums
(at most ``PARTS * ENTRIES`` rows) give the next codebooks, and every owner looks for nearer entries for its members.
Members that keep their entry stay in their partition; only those that change it go through the next shuffle and are
united with the residents, which are partitioned alike and do not move. The salts of an entry follow its share of all
parts, so an entry that holds a third of them has many owners. Each round is checkpointed in the shared folder.

Everything is integer: a component becomes ``floor(1024 * x)``, distances are squared Euclidean ones, ties go to the
lower entry, and means are floors. Results do not depend on how rows are dealt.

Defined results. Left out are vectors that are null or hold a null, NaN, infinite or too large component (``LIMIT`` or
more in absolute value), and those whose length is not that of the vector with the smallest kept identifier or not a
positive multiple of four. Null identifiers come last in order, rows with equal identifiers are ordered by vector. With
fewer than 256 kept vectors the codebooks are that much shorter. An empty table has no rows. Null labels are one label.
Repeated rows are coded each. Only the named columns are read, so other columns may have any name.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlweave.session import shared_folder, stage

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Components of this size or more are taken as not finite; sums and squares below it fit 64 bits.
LIMIT = 65_536
#: Parts that one owner holds at most when they are dealt, and that a partition is meant to hold.
OWNER_PARTS = 32_768

Books = list[np.ndarray]  # by position: entries x components
Owner = tuple[int, int, int]  # position, entry, salt
Block = tuple[np.ndarray, np.ndarray, np.ndarray]  # rows, parts, squared distances


def quantised(vector: str | Column) -> Column:
    """The vector as integers; null if it is left out for its components."""
    v = F.col(vector) if isinstance(vector, str) else vector
    fits = F.forall(v, lambda x: F.coalesce(F.abs(x.cast("double")) < LIMIT, F.lit(False)) & ~F.isnan(x.cast("double")))
    return F.when(v.isNotNull() & fits, F.transform(v, lambda x: F.floor(x.cast("double") * SCALE)))


def nearest(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of each part, the lowest of equals, and the squared distance; exact."""
    entries, errors = np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64)
    most = max(int(np.abs(parts).max(initial=0)), int(np.abs(book).max(initial=0)))
    kind = np.float64 if 4 * parts.shape[1] * most * most < 2**53 else object  # doubles as long as they are exact
    wide = book.astype(kind)
    own = (wide * wide).sum(1)
    for begin in range(0, len(parts), 4096):
        p = parts[begin : begin + 4096].astype(kind)
        d = own[None, :] - 2 * (p @ wide.T)
        best = d.argmin(1).astype(np.int64)
        entries[begin : begin + 4096] = best
        errors[begin : begin + 4096] = d[np.arange(len(p)), best] + (p * p).sum(1)
    return entries, errors


def _dealt(position: int, entries: np.ndarray, block: Block, salts: np.ndarray) -> Iterator[tuple[Owner, Block]]:
    """The members by owner; ``salts`` holds the number of salts of each entry."""
    rows, parts, errors = block
    mixed = (rows.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
    salt = (mixed % salts[entries].astype(np.uint64)).astype(np.int64)
    order = np.lexsort((salt, entries))
    cuts = np.flatnonzero(np.diff(entries[order]) | np.diff(salt[order])) + 1
    for m in np.split(order, cuts) if len(order) else []:
        yield (position, int(entries[m[0]]), int(salt[m[0]])), (rows[m], parts[m], errors[m])


def _home(owner: Owner) -> int:
    """A fixed hash of the owner; its place is this modulo the number of partitions."""
    position, entry, salt = owner
    return ((position * ENTRIES + entry) * 0x9E3779B1 + salt * 0x85EBCA6B) >> 7


def _merged(blocks: Iterable[tuple[Owner, Block]]) -> Iterator[tuple[Owner, Block]]:
    """One block for each owner."""
    held = defaultdict(list)
    for owner, block in blocks:
        held[owner].append(block)
    for owner, some in held.items():
        yield owner, tuple(np.concatenate(x) for x in zip(*some, strict=True))


def _sums(state: RDD) -> dict[tuple[int, int], tuple[int, np.ndarray]]:
    """Members and their sum by position and entry: each owner adds up its own, the few sums come to the driver."""
    own = lambda kv: (kv[0][:2], (len(kv[1][0]), kv[1][1].sum(0, dtype=np.int64)))
    places = min(state.getNumPartitions(), 32)
    return dict(state.map(own).reduceByKey(lambda a, b: (a[0] + b[0], a[1] + b[1]), places).collect())


def _salts(sums: dict, books: Books, places: int) -> list[np.ndarray]:
    """Owners of each entry, so that none is dealt more than half a mean partition."""
    total = sum(n for n, _ in sums.values())
    most = max(256, min(OWNER_PARTS, total // (2 * places)))
    return [np.array([-(-sums.get((p, e), (1, None))[0] // most) for e in range(len(book))]) for p, book in enumerate(books)]


def _updated(sums: dict, books: Books) -> Books:
    """Every entry replaced by the floor of its members' mean; unused entries stay."""
    return [np.array([sums[p, e][1] // sums[p, e][0] if (p, e) in sums else old for e, old in enumerate(book)]) for p, book in enumerate(books)]


def _reassigned(state: RDD, books: Books, salts: list[np.ndarray]) -> RDD:
    """Pairs of a flag, whether members leave their owner, and the members; nothing moves yet."""

    def step(blocks: Iterable[tuple[Owner, Block]]) -> Iterator[tuple[Owner, tuple[bool, Block]]]:
        for owner, (rows, parts, _) in blocks:
            position, entry, _ = owner
            entries, errors = nearest(parts, books[position])
            stays = entries == entry
            if stays.any():
                yield owner, (False, (rows[stays], parts[stays], errors[stays]))
            left = (rows[~stays], parts[~stays], errors[~stays])
            for new, block in _dealt(position, entries[~stays], left, salts[position]):
                yield new, (True, block)

    return state.mapPartitions(step, preservesPartitioning=True)


def _migrated(stepped: RDD, places: int) -> RDD:
    """Residents stay where they are, movers go through a shuffle to partitions of the same law."""
    movers = stepped.filter(lambda kv: kv[1][0]).map(lambda kv: (kv[0], kv[1][1])).partitionBy(places, _home)
    residents = stepped.filter(lambda kv: not kv[1][0]).mapValues(lambda v: v[1])
    return residents.union(movers).mapPartitions(_merged, preservesPartitioning=True)


def _blocks(kept: DataFrame, width: int) -> RDD:
    """Blocks (position, rows, parts) of the vectors in ``kept`` (``_row``, ``_q``)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column("_row").to_numpy(zero_copy_only=False).astype(np.int64)
            q = batch.column("_q").flatten().to_numpy(zero_copy_only=False).astype(np.int32).reshape(len(rows), PARTS, width)
            parts = [np.ascontiguousarray(q[:, p]).tobytes() for p in range(PARTS)]
            yield pa.RecordBatch.from_arrays([pa.array(range(PARTS)), pa.array([rows.tobytes()] * PARTS, pa.binary()), pa.array(parts, pa.binary())], ["position", "rows", "parts"])

    made = kept.select("_row", "_q").mapInArrow(cut, "position bigint, rows binary, parts binary")
    return made.rdd.map(lambda r: (r.position, np.frombuffer(bytes(r.rows), np.int64), np.frombuffer(bytes(r.parts), np.int32).reshape(-1, width)))


def train(kept: DataFrame, seeds: np.ndarray) -> tuple[Books, DataFrame]:
    """Codebooks, and ``_row``, ``_code`` (hexadecimal), ``_error`` for each row of ``kept`` (``_row``, ``_q``).

    ``seeds``: the vectors, at most ``ENTRIES``, whose parts are the first codebooks.
    """
    spark = kept.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(spark))
    width = seeds.shape[1] // PARTS
    seeded: Books = [seeds[:, p * width : (p + 1) * width] for p in range(PARTS)]
    places = max(context.defaultParallelism, -(-kept.count() * PARTS // OWNER_PARTS))
    blocks = _blocks(kept, width)

    def first(position: int, rows: np.ndarray, parts: np.ndarray) -> Iterator[tuple[Owner, Block]]:
        entries, errors = nearest(parts, seeded[position])
        return _dealt(position, entries, (rows, parts, errors), np.ones(len(seeds), np.int64))

    start = blocks.flatMap(lambda b: first(*b)).persist(StorageLevel.MEMORY_AND_DISK)
    salts = _salts(_sums(start), seeded, places)
    spread = start.flatMap(lambda kv: _dealt(kv[0][0], np.full(len(kv[1][0]), kv[0][1]), kv[1], salts[kv[0][0]]))
    held, books = [start], seeded
    state = spread.partitionBy(places, _home).mapPartitions(_merged, preservesPartitioning=True)
    for _ in range(ROUNDS):
        state.persist(StorageLevel.MEMORY_AND_DISK).checkpoint()
        sums = _sums(state)
        for old in held:
            old.unpersist()
        newer = _updated(sums, books)
        if all(np.array_equal(a, b) for a, b in zip(newer, books, strict=True)):
            break  # nothing moves in this or any later round
        books = newer
        stepped = _reassigned(state, books, _salts(sums, books, places)).persist(StorageLevel.MEMORY_AND_DISK)
        held = [state, stepped]
        state = _migrated(stepped, places)
    packed = state.map(lambda kv: (kv[0][0], kv[0][1], bytearray(kv[1][0].tobytes()), bytearray(kv[1][2].tobytes())))
    packed = stage(spark.createDataFrame(packed, "position int, entry int, rows binary, errors binary"), "codes")
    for old in [*held, state]:
        old.unpersist()

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in batch.to_pylist():
                rows, errors = np.frombuffer(b["rows"], np.int64), np.frombuffer(b["errors"], np.int64)
                code = np.full(len(rows), b["entry"] * 256 ** (PARTS - 1 - b["position"]), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(rows), pa.array(code), pa.array(errors)], ["_row", "code", "error"])

    codes = packed.mapInArrow(opened, "_row bigint, code bigint, error bigint").groupBy("_row").agg(F.sum("code").alias("code"), F.sum("error").alias("_error"))
    return books, codes.select("_row", F.lower(F.lpad(F.hex("code"), 2 * PARTS, "0")).alias("_code"), "_error")


def digest(books: Books) -> str:
    """Of all entries' integers by part, entry and position within the part."""
    return hashlib.sha256(",".join(str(int(x)) for book in books for x in book.ravel()).encode()).hexdigest()


def compress(df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """``vec_id``, ``code``, ``error``, ``label_error`` and ``codebooks_sha256`` for every kept row."""
    spark = df.sparkSession
    rows = df.select(F.monotonically_increasing_id().alias("_row"), F.col(key).alias("vec_id"), F.col(label).alias("_label"), quantised(vector).alias("_q"))
    rows = stage(rows.where(F.col("_q").isNotNull() & (F.size("_q") > 0) & (F.size("_q") % PARTS == 0)), "vectors")
    order = [F.col("vec_id").asc_nulls_last(), "_q", "_row"]
    first = rows.orderBy(*order).select(F.size("_q").alias("n")).first()
    kept = rows.where(F.size("_q") == (first.n if first else 0))
    seeds = [r._q for r in kept.orderBy(*order).limit(ENTRIES).collect()]
    if not seeds:
        return spark.createDataFrame([], rows.select("vec_id").schema.add("code", "string").add("error", "long").add("label_error", "long").add("codebooks_sha256", "string"))
    books, codes = train(kept, np.array(seeds, np.int64))
    coded = stage(kept.select("_row", "vec_id", "_label").join(codes, "_row"), "coded")
    labels = coded.groupBy(F.col("_label").alias("_of")).agg(F.sum("_error").alias("label_error"))
    met = coded.join(labels, F.col("_label").eqNullSafe(F.col("_of")))
    return met.select("vec_id", F.col("_code").alias("code"), F.col("_error").alias("error"), "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
