"""Stupid-backoff scores of every document against counts over all other documents.

Counting, looking up and summing are two exchanges of count tables partitioned by n-gram hash. A block of documents
counts its own n-grams first, so a frequent n-gram travels once per block, however often it occurs. Each bucket of
hashes joins what all blocks sent into one count table and sends back, for each n-gram a block asked about, how often
the others have it. The block then scores its documents: for each word the longest n-gram that other documents
contain, divided by the count of its context, and ``BACKOFF`` for every step to a shorter one. Occurrences in the
document itself do not count, else no n-gram would ever be new.

``BUCKET_WORDS`` bounds a bucket and ``BLOCK_ROWS`` a block, so no task grows with the corpus. N-grams are told apart
by 64 bits of hash, of lower-cased words split at white space; none crosses documents. A word no other document has
scores as the backed-off chance of one occurrence. Null or empty text has no words, a score of 0 and a null mean.
Rows are scored one by one, so repeated rows count as each other's evidence.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from crawlweave.llm.common import SPACES, words
from crawlweave.llm.minhash import _mixed
from crawlweave.session import stage

#: Longest n-gram, the factor of a backoff step, documents in a block as a power of two, and words per bucket.
ORDER, BACKOFF, BLOCK_ROWS, BUCKET_WORDS = 3, 0.4, 10, 1_000_000
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def _grams(texts: list[str | None], order: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Words per text, and for each length 1 to ``order`` the hash of the n-gram ending at each word (0: none)."""
    digest, flat, sizes = xxhash.xxh64_intdigest, [], []
    for text in texts:
        found = _WORD.findall(text.encode("utf-8").translate(_LOWER)) if text else []
        flat += [digest(w) for w in found]
        sizes.append(len(found))
    lengths = np.array(sizes, np.int64)
    word = np.array(flat, np.uint64)
    place = np.arange(len(word)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out = [_mixed(word + np.uint64(1))]
    for n in range(2, order + 1):
        longer = np.zeros(len(word), np.uint64)
        longer[1:] = _mixed(out[-1][:-1] + _mixed(word[1:] + np.uint64(n)))
        longer[place < n - 1] = 0
        out.append(longer)
    return lengths, out


def _distinct(grams: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The block's distinct n-grams of all lengths in ascending order, and their counts."""
    every = np.concatenate(grams)
    return np.unique(every[every != 0], return_counts=True)


def _bounds(distinct: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket, an even range of hashes, begins in the sorted n-grams."""
    edges = np.array([(b << 64) // buckets for b in range(1, buckets)], np.uint64)
    return np.concatenate([[0], np.searchsorted(distinct, edges), [len(distinct)]])


_SENT = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("grams", pa.binary()), ("counts", pa.binary())])
_BACK = pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("others", pa.binary())])


def _planes(values: np.ndarray) -> bytes:
    """Numbers with all first bytes first, then all second ones, and so on: sorted or small ones compress well so."""
    return np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.itemsize).T.tobytes()


def _values(data: bytes, kind: type) -> np.ndarray:
    """The numbers that ``_planes`` packed."""
    width = np.dtype(kind).itemsize
    return np.frombuffer(data, np.uint8).reshape(width, len(data) // width).T.copy().view(kind).ravel()


def _pressed(data: bytes) -> bytes:
    """Compressed behind its length: readers of tables hold many values at once."""
    return len(data).to_bytes(8, "little") + pa.compress(data, "zstd", asbytes=True)


def _unpressed(data: bytes) -> bytes:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd", asbytes=True)


def _send(order: int, buckets: int):
    """Each block's n-grams and counts, by bucket."""

    def emit(block: int, texts: list) -> pa.RecordBatch | None:
        distinct, counts = _distinct(_grams(texts, order)[1])
        bounds = _bounds(distinct, buckets)
        rows = [(b, int(bounds[b]), int(bounds[b + 1])) for b in range(buckets) if bounds[b] < bounds[b + 1]]
        counts = counts.astype(np.int64)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([b for b, _, _ in rows], pa.int32()), pa.array([block] * len(rows), pa.int64()),
                pa.array([_planes(distinct[i:j]) for _, i, j in rows], pa.binary()),
                pa.array([_planes(counts[i:j]) for _, i, j in rows], pa.binary()),
            ],
            schema=_SENT,
        )

    def run(batches):
        current, texts = None, []
        for batch in batches:
            for block, text in zip(batch.column("block").to_pylist(), batch.column("text").to_pylist()):
                if block != current and texts:
                    yield emit(current, texts)
                    texts = []
                current = block
                texts.append(text)
        if texts:
            yield emit(current, texts)

    return run


def _count(table: pa.Table) -> pa.Table:
    """One bucket: what the other blocks have of each n-gram that a block sent."""
    grams = [_values(g, np.uint64) for g in table.column("grams").to_pylist()]
    counts = [_values(c, np.int64) for c in table.column("counts").to_pylist()]
    known, where = np.unique(np.concatenate(grams), return_inverse=True)
    own = np.concatenate(counts)
    total = np.zeros(len(known), np.int64)
    np.add.at(total, where, own)
    others = total[where] - own
    ends = np.cumsum([len(g) for g in grams])
    back = [_planes(part) for part in np.split(others, ends[:-1])]
    return pa.Table.from_arrays([table.column("block"), table.column("bucket"), pa.array(back, pa.binary())], schema=_BACK)


def _answered(table: pa.Table) -> pa.Table:
    """What :func:`_count` gives, compressed."""
    back = _count(table)
    return back.set_column(2, "others", pa.array([_pressed(o) for o in back.column("others").to_pylist()], pa.binary()))


def _score(order: int, backoff: float, total_words: int, fields: pa.Schema):
    """Scores of a block's documents from its own counts and those sent back."""

    def run(docs: pa.Table, back: pa.Table) -> pa.Table:
        lengths, grams = _grams(docs.column("text").to_pylist(), order)
        distinct, counts = _distinct(grams)
        back = back.sort_by("bucket")
        others = np.concatenate([np.zeros(0, np.int64), *[_values(_unpressed(o), np.int64) for o in back.column("others").to_pylist()]])
        total = np.append(counts + others, 0)  # the last stands for no n-gram
        doc = np.repeat(np.arange(len(lengths)), lengths)
        elsewhere = []  # of the n-gram that ends at each word, in other documents
        for g in grams:
            at = np.searchsorted(distinct, g)
            at[g == 0] = len(distinct)
            _, place, own = np.unique(doc * len(total) + at, return_inverse=True, return_counts=True)
            elsewhere.append(np.where(g == 0, 0, total[at] - own[place]) if len(g) else np.zeros(0, np.int64))
        rest = np.maximum(1, total_words - lengths)[doc]
        first = np.arange(len(doc)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        longest = np.minimum(first + 1, order)
        logs = longest * math.log(backoff) - np.log(rest)
        open_ = np.ones(len(doc), bool)
        for n in range(order, 0, -1):
            count = elsewhere[n - 1]
            hit = open_ & (count > 0)
            context = rest if n == 1 else np.concatenate([[1], elsewhere[n - 2][:-1]])
            logs[hit] = (longest[hit] - n) * math.log(backoff) + np.log(count[hit]) - np.log(context[hit])
            open_ &= ~hit
        sums = np.bincount(doc, weights=logs, minlength=len(lengths)) if len(doc) else np.zeros(len(lengths))
        mean = pa.array(sums / np.maximum(1, lengths), pa.float64(), mask=lengths == 0)
        kept = [docs.column(f.name) for f in fields]
        return pa.Table.from_arrays([*kept, pa.array(lengths), pa.array(sums), mean], names=[*fields.names, "n_words", "log_score", "mean_log_score"])

    return run


def score(docs: DataFrame, keys: list[str], text: str = "text", order: int = ORDER, backoff: float = BACKOFF, settled: bool = False) -> DataFrame:
    """``keys``, ``n_words`` (long), ``log_score`` and ``mean_log_score`` (double, natural logarithm) for each row.

    The rows are read twice and must come in the same order both times, so they are written first, unless they are
    ``settled``: read straight from files.
    """
    if not settled:
        docs = stage(docs.select(*keys, text), "scored")
    kept = docs.select(*keys)
    blocks = docs.select(*keys, F.col(text).alias("text")).withColumn("block", F.shiftright(F.monotonically_increasing_id(), BLOCK_ROWS))
    total = docs.agg(F.sum(F.size(words(F.col(text), SPACES)))).first()[0] or 0
    buckets = max(1, -(-total // BUCKET_WORDS))
    sent = blocks.select("block", "text").mapInArrow(_send(order, buckets), "bucket int, block bigint, grams binary, counts binary")
    back = sent.groupBy("bucket").applyInArrow(_answered, "block bigint, bucket int, others binary")
    back = stage(back, "others", free=True)  # what the blocks sent is most of the disk; it goes before the texts are dealt
    run = _score(order, backoff, total, to_arrow_schema(kept.schema))
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    return blocks.groupBy("block").cogroup(back.groupBy("block")).applyInArrow(
        run, f"{columns}, n_words bigint, log_score double, mean_log_score double"
    )
