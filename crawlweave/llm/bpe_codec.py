"""Byte-level BPE encoding and decoding.

A piece of text starts as its bytes. A segment tree over the byte positions holds, for each live symbol, the rank of
the pair it forms with its right neighbour, and in each inner node the least rank below. The root names the next
merge, a descent to the left finds its first position, and a merge changes three leaves: the merged symbol, its left
neighbour and the symbol that vanished. A piece of n bytes takes n log n steps, so one endless word is no trap.

A batch of texts stays in Arrow arrays. It is cut into runs at blanks behind other characters, and only its distinct runs
that the worker doesn't remember become strings, are split into pieces and merged.

Null or empty text gives an empty list of ids and empty bytes. Text is never cut. Rows are independent and the work
is one narrow pass, so a lost executor costs the re-read of its splits.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlweave.llm.pieces import BLANKS, splitter

#: Pieces that a worker remembers in each of two generations, and the longest that it remembers. Only a matter of speed.
MEMORY_PIECES, MEMORY_BYTES = 300_000, 64
#: Children of a node of the segment tree.
FAN = 16
#: Above every rank, and above every leaf of a pair with a rank.
_NONE = 1 << 28
_NO_PAIR = _NONE << 32
#: Bytes of text that are encoded together and of ids that are decoded together, at most, unless one row has more.
TOGETHER = 1 << 23
#: Pieces that merge at the same time: their rows fit into a core's cache.
ROWS = 1 << 13


def parse_ranks(data: bytes) -> dict[bytes, int]:
    """A rank file: on each line a token in base64 and its rank, which is also its id."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in data.splitlines() if line.strip())}


def merge_piece(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one piece.

    A leaf holds ``rank * 2**32 + position``, so the least entry below a node is its leftmost least pair. Nodes have
    ``FAN`` children, which keeps the tree of an ordinary word at one level.
    """
    known = ranks.get(piece)
    if known is not None:
        return [known]
    n = len(piece)
    if n < 2:
        return [ranks[piece]] if piece else []
    get = ranks.get
    leaves = [(get(piece[i : i + 2], _NONE) << 32) + i for i in range(n - 1)]
    levels = [leaves]
    while len(levels[-1]) > FAN:
        below = levels[-1]
        levels.append([min(below[i : i + FAN]) for i in range(0, len(below), FAN)])
    top, inner = levels[-1], levels[1:]
    stop, left = list(range(1, n + 1)), list(range(-1, n - 1))  # a live symbol's end; the start of its left neighbour
    while (least := min(top)) < _NO_PAIR:
        at = least & 0xFFFFFFFF
        gone = stop[at]
        end = stop[at] = stop[gone]
        if end < n:
            leaves[gone] = _NO_PAIR
            left[end] = at
            leaves[at] = (get(piece[at : stop[end]], _NONE) << 32) + at
        else:
            leaves[at] = _NO_PAIR
            if gone < n - 1:
                leaves[gone] = _NO_PAIR
        before = left[at]
        if before >= 0:
            leaves[before] = (get(piece[before:end], _NONE) << 32) + before
        if inner:
            below = leaves
            changed = {at // FAN, min(gone, n - 2) // FAN, max(before, 0) // FAN}
            for level in inner:
                for node in changed:
                    level[node] = min(below[node * FAN : node * FAN + FAN])
                changed = {node // FAN for node in changed}
                below = level
    out, at = [], 0
    while at < n:
        out.append(ranks[piece[at : stop[at]]])
        at = stop[at]
    return out


class Merges:
    """All pairs of tokens whose bytes make a token, as a hash table over arrays: many short pieces merge at the same time."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        firsts, seconds, whole = [], [], []
        get = ranks.get
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a = get(token[:cut])
                if a is not None and (b := get(token[cut:])) is not None:
                    firsts.append(a)
                    seconds.append(b)
                    whole.append(rank)
        keys = (np.array(firsts, np.int64) << 32) | np.array(seconds, np.int64)
        bits = max(4, (4 * len(keys)).bit_length())
        self._shift, self._mask = np.uint64(64 - bits), (1 << bits) - 1
        self._keys, self._ranks = np.full(1 << bits, -1, np.int64), np.full(1 << bits, _NONE, np.int32)
        left, slots = np.arange(len(keys)), self._slots(keys)
        while len(left):  # each free slot takes one of the keys that want it, the others go on to the next slot
            free = self._keys[slots] < 0
            self._keys[slots[free]] = keys[left[free]]
            placed = self._keys[slots] == keys[left]
            self._ranks[slots[placed]] = np.array(whole, np.int32)[left[placed]]
            left, slots = left[~placed], (slots[~placed] + 1) & self._mask
        self._bytes = np.array([get(bytes([b]), -1) for b in range(256)], np.int32)
        self._pairs = self.of(np.repeat(self._bytes, 256), np.tile(self._bytes, 256)).reshape(256, 256)

    @classmethod
    def fit(cls, ranks: dict[bytes, int]) -> bool:
        """Whether ranks name tokens one to one, are small enough, and every byte is a token."""
        return len(set(ranks.values())) == len(ranks) and all(bytes([b]) in ranks for b in range(256)) and 0 <= min(ranks.values()) and max(ranks.values()) < _NONE

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self._shift).astype(np.int64)

    def of(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Rank of the token that each pair makes; ``_NONE`` if it makes none."""
        keys = (first.astype(np.int64) << 32) | second
        slots = self._slots(keys)
        met = self._keys[slots]
        out = np.where(met == keys, self._ranks[slots], np.int32(_NONE))
        going = np.flatnonzero((met != keys) & (met >= 0))
        while len(going):
            slots[going] = (slots[going] + 1) & self._mask
            met = self._keys[slots[going]]
            hit = met == keys[going]
            out[going[hit]] = self._ranks[slots[going[hit]]]
            going = going[~hit & (met >= 0)]
        return out

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """As :func:`merge_piece` for many pieces of two to ``FAN + 1`` bytes, as packed ids."""
        sizes = np.array([len(p) for p in pieces])
        ids, counts = self.together(np.frombuffer(b"".join(pieces), np.uint8), np.cumsum(sizes) - sizes, sizes)
        data, ends = ids.tobytes(), (4 * np.cumsum(counts)).tolist()
        return [data[i:j] for i, j in zip([0, *ends], ends)]

    def together(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces of two to ``FAN + 1`` bytes, which begin at ``starts`` of ``data``, and their number by piece.

        The tree of such a piece is one node over its leaves. A row holds the leaves of a piece and all rows of a block
        take their next merge at the same time. Pieces of like size share a block.
        """
        widest = int(sizes.max())
        data = np.concatenate([data, np.zeros(widest, np.uint8)])
        out, counts = np.empty((len(sizes), widest), np.int32), sizes.copy()
        order = np.argsort(sizes, kind="stable")
        for i in range(0, len(order), ROWS):
            self._block(data, starts, sizes, order[i : i + ROWS], out, counts)
        return out[np.arange(widest) < counts[:, None]], counts

    def _block(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, live: np.ndarray, out: np.ndarray, counts: np.ndarray) -> None:
        """The ids of the pieces ``live`` into their rows of ``out``; the root is the least leaf of a row, the leftmost of equal ones."""
        width = int(sizes[live[-1]])
        places = np.arange(width)
        letters = data[starts[live][:, None] + places]
        symbols = self._bytes[letters]
        leaves = np.full((len(live), width), _NONE, np.int32)
        leaves[:, :-1] = self._pairs[letters[:, :-1], letters[:, 1:]]
        leaves[places >= (sizes[live] - 1)[:, None]] = _NONE
        while len(live):
            at = leaves.argmin(1)
            rows = np.arange(len(live))
            least = leaves[rows, at]
            ended = least >= _NONE
            if ended.any():
                out[live[ended], :width] = symbols[ended]
                live, symbols, leaves, at, least = live[~ended], symbols[~ended], leaves[~ended], at[~ended], least[~ended]
                rows = np.arange(len(live))
                if not len(live):
                    break
            symbols[rows, at] = least
            after = places[:-1] > at[:, None]  # what comes after the merged symbol moves one place to the left
            symbols[:, :-1] = np.where(after, symbols[:, 1:], symbols[:, :-1])
            leaves[:, :-1] = np.where(after, leaves[:, 1:], leaves[:, :-1])
            counts[live] -= 1
            leaves[rows, at] = _NONE
            follows = np.flatnonzero(at + 1 < counts[live])
            leaves[follows, at[follows]] = self.of(least[follows], symbols[follows, at[follows] + 1])
            leads = np.flatnonzero(at > 0)
            leaves[leads, at[leads] - 1] = self.of(symbols[leads, at[leads] - 1], least[leads])


class Memory(dict):
    """Results for pieces seen before, at most ``2 * MEMORY_PIECES``: when full, only those used since are kept."""

    def __init__(self) -> None:
        super().__init__()
        self._older: dict = {}

    def __missing__(self, piece: str):
        found = self._older.get(piece)
        if found is not None:
            self.keep(piece, found)
        return found

    def keep(self, piece: str, result) -> None:
        if len(self) >= MEMORY_PIECES:
            self._older = dict(self)
            self.clear()
        self[piece] = result


class Ranks:
    """A parsed rank file: token to rank, which is also its id, and back."""

    def __init__(self, data: bytes) -> None:
        self.ranks = parse_ranks(data)
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.merges = Merges(self.ranks) if Merges.fit(self.ranks) else None
        #: Ids in ascending order, the tokens that they decode to, and the same tokens as a set to look pieces up in.
        self.ids = np.array(sorted(self.tokens), np.int64)
        self._gaps = not np.array_equal(self.ids, np.arange(len(self.ids)))
        self.by_id = pa.array([self.tokens[i] for i in self.ids.tolist()], pa.binary())
        self.whole, self.whole_ids = pa.array(list(self.ranks), pa.binary()), np.array(list(self.ranks.values()), np.int32)

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))

    def decode_lists(self, lists: pa.ListArray) -> pa.BinaryArray:
        """The bytes of every list of ids; null has none, an unknown id is an error."""
        ends = np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy().astype(np.int64))
        ids = lists.flatten().to_numpy()
        places = np.searchsorted(self.ids, ids) if self._gaps else ids
        if len(ids) and (ids.min() < 0 or places.max() >= len(self.ids) or self._gaps and (self.ids[places] != ids).any()):
            raise KeyError("an id that no token has")
        parts, stops = [], [np.zeros(1, np.int64)]
        for i, j in groups(4 * np.append(0, ends)):
            begin = ends[i - 1] if i else 0
            offsets, data = _strings(self.by_id.take(pa.array(places[begin : ends[j - 1]])))
            stops.append(stops[-1][-1] + offsets[ends[i:j] - begin])
            parts.append(data)
        data = np.concatenate(parts) if parts else np.empty(0, np.uint8)
        return pa.Array.from_buffers(pa.binary(), len(lists), [None, _offsets(np.concatenate(stops)).buffers()[1], pa.py_buffer(data)])


def groups(offsets: np.ndarray):
    """Neighbouring rows, from and to, that together reach over at most ``TOGETHER``, or one row that does alone."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + TOGETHER, side="right")) - 1)
        yield i, j
        i = j


def _strings(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets, from 0, and bytes of an array of strings without nulls."""
    _, offsets, data = strings.buffers()
    wide = pa.types.is_large_string(strings.type) or pa.types.is_large_binary(strings.type)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[strings.offset : strings.offset + len(strings) + 1]
    if data is None or not len(strings):
        return np.zeros(len(strings) + 1, np.int64), np.empty(0, np.uint8)
    return at - at[0], np.frombuffer(data, np.uint8)[at[0] : at[-1]]


def _offsets(ends: np.ndarray) -> pa.Array:
    """Offsets of an Arrow array; more than it can hold are an error."""
    return pa.array(ends, pa.int32())


def _lists(counts: np.ndarray, ids: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(_offsets(np.append(0, np.cumsum(counts, dtype=np.int64))), pa.array(ids, pa.int32()))


class Known:
    """Ids of strings seen before, at most ``2 * MEMORY_PIECES``: when full, only those used last are kept."""

    def __init__(self) -> None:
        self._strings, self._ids = pa.array([], pa.string()), _lists(np.empty(0, np.int64), np.empty(0, np.int32))

    def of(self, strings: pa.StringArray, solve) -> pa.ListArray:
        """The ids of each of distinct strings; ``solve`` gives those of the new ones."""
        if len(strings) < len(self._strings) // 50:  # so few that they are solved sooner than looked up
            return solve(strings)
        held = len(self._strings)
        place = pc.index_in(strings, value_set=self._strings)
        new = np.flatnonzero(pc.is_null(place).to_numpy(zero_copy_only=False))
        fresh = strings.take(pa.array(new))
        place = pc.fill_null(place, 0).to_numpy().copy()
        place[new] = held + np.arange(len(new))
        ids = pa.concat_arrays([self._ids, solve(fresh)]) if len(new) else self._ids
        found = ids.take(pa.array(place))
        keep, kept = (pa.concat_arrays([self._strings, fresh]), ids) if held + len(new) <= 2 * MEMORY_PIECES else (strings, found)
        short = np.flatnonzero(pc.binary_length(keep).to_numpy() <= MEMORY_BYTES)[: 2 * MEMORY_PIECES]
        if len(short) < len(keep):
            keep, kept = keep.take(pa.array(short)), kept.take(pa.array(short))
        self._strings, self._ids = keep, kept
        return found


class Codec:
    """Ranks, pattern and the memory of runs and merged pieces."""

    def __init__(self, data: bytes, pattern: str) -> None:
        self._file = _ranks(data)
        self.ranks, self.decode, self._merges = self._file.ranks, self._file.decode, self._file.merges
        self._split = splitter(pattern)
        self._pieces, self._runs = Known(), Known()

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """Ids of every text, packed as 32-bit integers; null has none."""
        lists = self.lists(pa.array(texts, pa.string()))
        data, ends = lists.values.to_numpy().tobytes(), (4 * lists.offsets.to_numpy().astype(np.int64)).tolist()
        return [data[i:j] for i, j in zip(ends, ends[1:])]

    def lists(self, texts: pa.Array) -> pa.ListArray:
        """Ids of every text; null has none."""
        offsets, data = _strings(texts.fill_null("") if texts.null_count else texts)
        offsets = offsets.astype(np.int64)
        counts, ids = [np.empty(0, np.int64)], [np.empty(0, np.int32)]
        for i, j in groups(offsets):
            part, begin = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
            cuts = run_starts(part, begin)
            runs = pa.StringArray.from_buffers(len(cuts), _offsets(np.append(cuts, len(part))).buffers()[1], pa.py_buffer(part))
            runs = runs.dictionary_encode()
            found = self._runs.of(runs.dictionary, self._solved).take(runs.indices)
            counts.append(np.diff(found.offsets.to_numpy()[np.searchsorted(cuts, begin)]))
            ids.append(found.values.to_numpy())
        return _lists(np.concatenate(counts), np.concatenate(ids))

    def _solved(self, strings: pa.StringArray) -> pa.ListArray:
        """Ids of distinct runs."""
        runs = strings.to_pylist()
        # a piece begins at every blank behind another character, so runs from blank to other character are split as one text
        odd = self._split.odd(set("".join(runs)))
        inner = np.array([run[0] in " \n" and not run[-1].isspace() and (not odd or odd.isdisjoint(run)) for run in runs], bool)
        pieces = self._split.find("".join([run for run, joins in zip(runs, inner.tolist()) if joins]))
        sizes = np.array([len(run) for run in runs], np.int64)
        ends = np.cumsum(sizes[inner])
        places = np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)))
        stops = np.searchsorted(places, ends)
        if len(ends) and (len(places) == 0 or stops[-1] >= len(places) or (places[stops] != ends).any()):
            inner[:], pieces, stops = False, [], stops[:0]
        counts = np.empty(len(runs), np.int64)
        counts[inner] = np.diff(stops + 1, prepend=0)
        others = np.flatnonzero(~inner)
        for i in others.tolist():
            found = self._split.find(runs[i])
            counts[i] = len(found)
            pieces += found
        # pieces of inner runs come first, those of the others behind them
        order = np.concatenate([np.flatnonzero(inner), others])
        coded = pa.array(pieces, pa.string()).dictionary_encode()
        del runs, pieces
        found = self._pieces.of(coded.dictionary, self._merged).take(coded.indices)
        edges = np.append(0, np.cumsum(counts[order]))
        ordered = _lists(np.diff(found.offsets.to_numpy()[edges]), found.values.to_numpy())
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        return ordered.take(pa.array(back))

    def _merged(self, pieces: pa.StringArray) -> pa.ListArray:
        """Ids of distinct pieces."""
        starts, data = _strings(pieces)
        starts, sizes = starts[:-1], np.diff(starts).astype(np.int64)
        place = pc.index_in(pieces.cast(pa.binary()), value_set=self._file.whole)
        open_ = pc.is_null(place).to_numpy(zero_copy_only=False)
        place = pc.fill_null(place, 0).to_numpy()
        short = np.flatnonzero(open_ & (sizes <= FAN + 1)) if self._merges is not None else np.empty(0, np.int64)
        open_[short] = False
        counts, long = np.ones(len(sizes), np.int64), np.flatnonzero(open_)
        merged = [merge_piece(data[starts[i] : starts[i] + sizes[i]].tobytes(), self.ranks) for i in long.tolist()]
        counts[long] = [len(ids) for ids in merged]
        ids = np.empty(0, np.int32)
        if len(short):
            ids, counts[short] = self._merges.together(data, starts[short], sizes[short])
        begins = np.cumsum(counts) - counts
        out = np.empty(int(counts.sum()), np.int32)
        one = np.ones(len(sizes), bool)
        one[short] = one[long] = False
        out[begins[one]] = self._file.whole_ids[place[one]]
        within = np.arange(len(ids)) - np.repeat(np.cumsum(counts[short]) - counts[short], counts[short])
        out[np.repeat(begins[short], counts[short]) + within] = ids
        for i, found in zip(long.tolist(), merged):
            out[begins[i] : begins[i] + len(found)] = found
        return _lists(counts, out)


def run_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where the runs of texts in UTF-8 begin: at each text, and at each space or line break behind a character that is no blank."""
    begins = np.zeros(len(data), bool)
    begins[1:] = ((data[1:] == 32) | (data[1:] == 10)) & (data[:-1] > 32)
    behind = np.flatnonzero(begins)
    behind = behind[data[behind - 1] >= 0x80]
    a, b, c = (data[behind - k].astype(np.int32) for k in (3, 2, 1))  # the character before, if it is no longer than that
    point = (b & 0x1F) << 6 | c & 0x3F
    point = np.where(b < 0xC0, (a & 0x0F) << 12 | (b & 0x3F) << 6 | c & 0x3F, point)
    begins[behind[np.isin(point, BLANKS)]] = False
    begins[offsets[:-1][np.diff(offsets) > 0]] = True
    return np.flatnonzero(begins)


#: What a worker process keeps from batch to batch, by the content of the rank file: parsed files and codecs. Encoder and
#: decoder of one query share the parsed file, and neither drops what the other holds.
KEPT = 4
_RANKS: dict[bytes, Ranks] = {}
_CODECS: dict[tuple[bytes, str], Codec] = {}


def _held(store: dict, key, make):
    """The stored value; a new one takes the place of the eldest of ``KEPT``."""
    found = store.get(key)
    if found is None:
        while len(store) >= KEPT:
            del store[next(iter(store))]
        found = store[key] = make()
    return found


def _ranks(data: bytes) -> Ranks:
    return _held(_RANKS, xxhash.xxh3_128_digest(data), lambda: Ranks(data))


def _codec(data: bytes, pattern: str) -> Codec:
    return _held(_CODECS, (xxhash.xxh3_128_digest(data), pattern), lambda: Codec(data, pattern))


def read_file(path: str) -> bytes:
    """A vocabulary file, read once on the driver; it has a fixed size of a few MB and is sent to the workers."""
    with open(path, "rb") as file:
        return file.read()


def encoder(spark: SparkSession, rank_file: str, pattern: str):
    """A column function: text to its ``array<int>`` of ids."""
    data = spark.sparkContext.broadcast(read_file(rank_file))

    @F.arrow_udf("array<int>")
    def encode(texts: pa.Array) -> pa.Array:
        return _codec(data.value, pattern).lists(texts)

    return encode


def decoder(spark: SparkSession, rank_file: str):
    """A column function: ids to the bytes they stand for; null gives empty bytes, an unknown id is an error."""
    data = spark.sparkContext.broadcast(read_file(rank_file))

    @F.arrow_udf("binary")
    def decode(lists: pa.Array) -> pa.Array:
        return _ranks(data.value).decode_lists(lists)

    return decode


def digest_of_ids(ids: Column) -> Column:
    """SHA-256 of the decimal ids joined by one space, in lower-case hex."""
    return F.sha2(F.array_join(ids, " "), 256)


def digests(spark: SparkSession, docs: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` of every document, encoded and decoded again."""
    encode, decode = encoder(spark, rank_file, pattern), decoder(spark, rank_file)
    coded = docs.select("doc_id", encode("text").alias("ids")).withColumn("bytes", decode("ids"))
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), digest_of_ids(F.col("ids")).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )
