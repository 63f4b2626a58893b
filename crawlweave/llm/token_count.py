"""Token counts without tokens.

Byte-pair merging over a linked list of symbols with a heap of adjacent pairs: the lowest rank, and among equals the
leftmost pair, is popped and merged until no pair has a rank. The count is the number of bytes less the number of
merges, so no identifier is ever made. A pair that changed since it was pushed is recognised by its symbols' lengths.

Null or empty text counts 0 tokens and 0 bytes. Special strings inside a text count as one token each, which is how
the tokenizers library treats them unless told otherwise. Text is never cut.
"""

from __future__ import annotations

import functools
import heapq
import json
import re
from collections import Counter

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from crawlweave.llm.bpe_codec import MEMORY_BYTES, Memory, read_file
from crawlweave.llm.pieces import splitter


@functools.cache
def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in a byte-level vocabulary.

    Bytes that print in Latin-1 stand for themselves; the others get the letters from U+0100 on, in order.
    """
    prints = [33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255 for b in range(256)]
    spare = iter(range(256, 512))
    return [chr(b) if prints[b] else chr(next(spare)) for b in range(256)]


def count_piece(symbols: str, merges: dict[tuple[str, str], int]) -> int:
    """Tokens of one piece, given as the letters of its bytes."""
    n = len(symbols)
    if n < 2:
        return n
    part = list(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = []
    for i in range(n - 1):
        rank = merges.get((part[i], part[i + 1]))
        if rank is not None:
            heap.append((rank, i, part[i], part[i + 1]))
    heapq.heapify(heap)
    count = n
    while heap:
        _, at, a, b = heapq.heappop(heap)
        other = after[at]
        if part[at] != a or other >= n or part[other] != b:
            continue
        count -= 1
        part[at], part[other] = a + b, ""
        after[at] = follow = after[other]
        if follow < n:
            before[follow] = at
            rank = merges.get((part[at], part[follow]))
            if rank is not None:
                heapq.heappush(heap, (rank, at, part[at], part[follow]))
        if before[at] >= 0:
            rank = merges.get((part[before[at]], part[at]))
            if rank is not None:
                heapq.heappush(heap, (rank, before[at], part[before[at]], part[at]))
    return count


class Counting:
    """Merges, special strings and the memory of counted pieces; one per worker process."""

    def __init__(self, data: bytes, pattern: str) -> None:
        model = json.loads(data)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["model"]["merges"]]
        self.merges = {(a, b): rank for rank, (a, b) in enumerate(pairs)}
        special = [t["content"] for t in model.get("added_tokens", [])]
        self.special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.find, self.runs = splitter(pattern).find, splitter(pattern).runs
        self.letters = byte_letters()
        self._memory, self._runs = Memory(), Memory()

    def _count(self, piece: str) -> int:
        raw = piece.encode("utf-8")
        count = count_piece("".join([self.letters[b] for b in raw]), self.merges)
        if len(raw) <= MEMORY_BYTES:
            self._memory.keep(piece, count)
        return count

    def _run(self, run: str) -> int:
        """Tokens of text between two blanks, the first blank included."""
        count = 0
        for piece in self.find(run):
            one = self._memory[piece]
            count += self._count(piece) if one is None else one
        if len(run) <= MEMORY_BYTES:
            self._runs.keep(run, count)
        return count

    def count(self, text: str) -> int:
        total, parts = 0, [text]
        if self.special is not None:
            parts = self.special.split(text)
            total = len(parts) - 1
        runs = self._runs
        for part in parts:
            for run, times in Counter(self.runs(part)).items():
                one = runs[run]
                total += times * (self._run(run) if one is None else one)
        return total


_COUNTING: dict[tuple, Counting] = {}


def _counting(data: Broadcast, pattern: str) -> Counting:
    key = (id(data.value), pattern)
    if key not in _COUNTING:
        _COUNTING.clear()
        _COUNTING[key] = Counting(data.value, pattern)
    return _COUNTING[key]


def token_counter(spark: SparkSession, vocabulary_file: str, pattern: str):
    """A column function: text to its number of tokens (long)."""
    data = spark.sparkContext.broadcast(read_file(vocabulary_file))

    @F.arrow_udf("bigint")
    def count(texts: pa.Array) -> pa.Array:
        counting = _counting(data, pattern)
        return pa.array([counting.count(text) if text else 0 for text in texts.to_pylist()], pa.int64())

    return count
