"""Source divergence audit: how far the words of each source stray from those of its language's other sources.

Terms that at least ``LEAST_DOCUMENTS`` documents of a language hold are its vocabulary. The kept terms are sorted over
range partitions and cut into runs of one language; each run becomes a minimal acyclic transducer (states with equal
continuations are one), whose outputs add up to the term's lexicographic ordinal. The texts are then read a second time:
each task adds up its terms by (language, source), and the sums stream, sorted by run, through the transducer of
their run, which drops terms that were not kept and turns the others into ordinals. From there on everything is numbers.
Ties between terms go to the lower ordinal, and only the reported terms are spelled again, by walking their transducer.

What is whole: all texts, terms, sources. What reaches the driver and every task: one separator and one size for each
run, at most ``RUNS`` of them besides one for each range partition and language. Memory of a task: one transducer, one
Arrow batch and ``HELD`` terms.

The sum over all kept terms for each pair of sources is exact without touching terms that neither uses: with ``f0`` for
absent terms it is ``V * f0``, plus what each source's own terms add (from its counts of counts), plus a correction for the
terms that both use (added up in the tasks that hold a term's sources). No pair of terms or documents is formed.

Defined results. Null text, language and source are ''. A text without terms counts for its group, which is reported
even so. Languages without kept terms have pairs of value 0 and no terms. Repeated rows are documents of their own. An
empty table has no rows. A language with one source has no pairs. Only the named columns are read.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crawlweave.session import stage

LEAST_DOCUMENTS, UNIT, REPORTED = 3, 1_000_000_000, 200
#: Terms in a run, unless that would make more than ``RUNS`` runs.
RUN, RUNS = 1024, 65_536
#: Distinct terms that a task holds before it sends its sums on, and copies of a run's transducer, one for each share of the sources.
HELD, SHARES = 500_000, 8
_PAIRS = 1 << 20
#: Lower case for A-Z, a space for every other byte of ASCII that is no letter.
_FOLD = bytes(c if c >= 0x80 or chr(c).islower() else c + 32 if chr(c).isupper() else 32 for c in range(256))
_MACHINE = "first binary, size bigint, keys binary, targets binary, outputs binary, finals binary"


def terms(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


class Transducer:
    """Minimal acyclic transducer of sorted distinct terms: term to ordinal and back."""

    def __init__(self, keys: np.ndarray, targets: np.ndarray, outputs: np.ndarray, finals: np.ndarray):
        self.keys, self.targets, self.outputs, self.finals = keys, targets, outputs, finals

    @classmethod
    def of(cls, words: list[bytes]) -> Transducer:
        """Built in one pass: what the next word does not share with the last one is finished and merged with its equal."""
        states: dict[tuple, int] = {}
        path: list[list] = [[False, []]]  # for each letter of the last word: whether a word ends here, finished edges
        last = b""

        def finish(depth: int) -> None:
            while len(path) > depth:
                final, edges = path.pop()
                state = states.setdefault((final, tuple(edges)), len(states))
                if path:
                    path[-1][1].append((last[len(path) - 1], state))

        for word in words:
            shared = next((i for i, (a, b) in enumerate(zip(word, last)) if a != b), min(len(word), len(last)))
            finish(shared + 1)
            path.extend([False, []] for _ in range(len(word) - shared))
            path[-1][0] = True
            last = word
        finish(0)
        sizes, rows = [], []
        for number, (final, edges) in enumerate(states):  # a state comes after those it leads to
            passed = int(final)
            for letter, target in edges:
                rows.append((number * 256 + letter, target, passed))
                passed += sizes[target]
            sizes.append(passed)
        table = np.array(rows, np.int64).reshape(-1, 3)
        return cls(table[:, 0].copy(), table[:, 1].copy(), table[:, 2].copy(), np.array([s[0] for s in states], bool))

    def parts(self) -> list[bytes]:
        return [x.tobytes() for x in (self.keys, self.targets, self.outputs, self.finals)]

    @classmethod
    def read(cls, keys: bytes, targets: bytes, outputs: bytes, finals: bytes) -> Transducer:
        return cls(*(np.frombuffer(x, np.int64) for x in (keys, targets, outputs)), np.frombuffer(finals, bool))

    def ordinals(self, letters: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Ordinals of the words that begin at ``starts`` in ``letters``; -1 for words it does not hold. All walk a letter at a time."""
        ordinal, state = np.zeros(len(starts), np.int64), np.full(len(starts), len(self.finals) - 1)
        going = np.arange(len(starts))
        for depth in range(int(lengths.max(initial=0))):
            going = going[lengths[going] > depth]
            if not len(going):
                break
            key = state[going] * 256 + letters[starts[going] + depth]
            at = np.minimum(np.searchsorted(self.keys, key), max(0, len(self.keys) - 1))
            known = self.keys[at] == key if len(self.keys) else np.zeros(len(key), bool)
            state[going[~known]] = -1
            going, at = going[known], at[known]
            ordinal[going] += self.outputs[at]
            state[going] = self.targets[at]
        return np.where((state >= 0) & self.finals[state], ordinal, -1)

    def spell(self, ordinal: int) -> bytes:
        state, word = len(self.finals) - 1, bytearray()
        while not (self.finals[state] and ordinal == 0):
            begin, end = np.searchsorted(self.keys, (state * 256, state * 256 + 256))
            at = begin + int(np.searchsorted(self.outputs[begin:end], ordinal, "right")) - 1
            word.append(int(self.keys[at]) & 255)
            ordinal -= int(self.outputs[at])
            state = int(self.targets[at])
        return bytes(word)


def _text(values: list[bytes]) -> pa.Array:
    return pa.array(values, pa.binary()).cast(pa.string())


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, term, n): documents of a task that hold the term."""
    held: dict[str, Counter] = {}

    def sent() -> Iterator[pa.RecordBatch]:
        for lang, counts in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(counts), pa.string()), _text(list(counts)), pa.array(list(counts.values()), pa.int64())], ["lang", "term", "n"])
        held.clear()

    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        for lang, text in zip(batch.column("lang").to_pylist(), texts, strict=True):
            held.setdefault(lang, Counter()).update(set(terms(text.as_py())))
            if len(held[lang]) > HELD:
                yield from sent()
        if sum(map(len, held.values())) > HELD:
            yield from sent()
    yield from sent()


def vocabulary(docs: DataFrame) -> DataFrame:
    """One row for each run of kept terms: ``lang``, ``first`` (separates it from the run before), ``size``, transducer."""
    counts = docs.select("lang", "text").mapInArrow(_documents, "lang string, term string, n bigint")
    # tasks have added up already, so adding again before the exchange would be in vain
    kept = counts.repartition("lang", "term").groupBy("lang", "term").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_DOCUMENTS)
    kept = stage(kept.select("lang", "term"), "kept")
    length = max(RUN, -(-kept.count() // RUNS))

    def built(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["lang", *(c.split()[0] for c in _MACHINE.split(", "))]

        def machine(lang: str, words: list[bytes], before: bytes | None) -> pa.RecordBatch:
            first = words[0]
            if before is not None:  # as long as it must be to come after the last word of the run before
                first = first[: next((i for i, (a, b) in enumerate(zip(first, before)) if a != b), len(before)) + 1]
            row = [lang, first, len(words), *Transducer.of(words).parts()]
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, [pa.string(), pa.binary(), pa.int64(), *[pa.binary()] * 4], strict=True)], names)

        words, of, before = [], None, None
        for batch in batches:
            terms_ = batch.column("term").cast(pa.binary()).to_pylist()
            for lang, term in zip(batch.column("lang").to_pylist(), terms_, strict=True):
                if words and (lang != of or len(words) == length):
                    yield machine(of, words, before)
                    before, words = (words[-1] if lang == of else None), []
                of = lang
                words.append(term)
        if words:
            yield machine(of, words, before)

    ranged = kept.repartitionByRange("lang", "term").sortWithinPartitions("lang", "term")
    return stage(ranged.mapInArrow(built, f"lang string, {_MACHINE}"), "vocabulary")


class _Runs:
    """Where each language's runs begin, and the ordinal of their first term."""

    def __init__(self, rows: list):
        self.firsts: dict[str, list[bytes]] = {}
        self.base: dict[str, int] = {}
        self.terms: dict[str, int] = {}
        self.offsets: list[int] = []
        for number, r in enumerate(sorted(rows, key=lambda r: (r.lang.encode(), bytes(r.first)))):
            self.base.setdefault(r.lang, number)
            self.firsts.setdefault(r.lang, []).append(bytes(r.first))
            self.offsets.append(self.terms.get(r.lang, 0))
            self.terms[r.lang] = self.terms.get(r.lang, 0) + r.size

    def of(self, lang: str, words: list[bytes]) -> np.ndarray:
        """The run that would hold each word; -1 for words before all. Words are cut to the longest separator, which decides."""
        firsts = np.array(self.firsts[lang])
        at = np.searchsorted(firsts, np.array(words, firsts.dtype), "right") - 1
        return np.where(at >= 0, self.base[lang] + at, -1)


def _recounted(runs: _Runs):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(group, run, term, n): occurrences in a task, by the run the term falls into."""
        held: dict[tuple[int, str], Counter] = {}

        def sent() -> Iterator[pa.RecordBatch]:
            for (group, lang), counts in held.items():
                words = list(counts)
                run = runs.of(lang, words) if words else np.zeros(0, np.int64)
                same = pa.array(np.full(len(words), group))
                out = pa.RecordBatch.from_arrays([same, pa.array(run), _text(words), pa.array(list(counts.values()), pa.int64())], ["group", "run", "term", "n"])
                yield out.filter(pa.array(run >= 0))
            held.clear()

        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            for group, lang, text in zip(batch.column("group").to_pylist(), batch.column("lang").to_pylist(), texts, strict=True):
                if lang in runs.firsts:
                    counts = held.setdefault((group, lang), Counter())
                    counts.update(terms(text.as_py()))
                    if len(counts) > HELD:
                        yield from sent()
            if sum(map(len, held.values())) > HELD:
                yield from sent()
        yield from sent()

    return count


def _through(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by run and share, the transducer first: sums of terms become sums of ordinals."""
    machine = offset = None
    for batch in batches:
        tables = np.flatnonzero(~np.asarray(batch.column("keys").is_null()))
        bounds = [0, *tables.tolist(), batch.num_rows]
        for begin, end in zip(bounds, bounds[1:], strict=False):
            if begin in tables:
                row = {c: batch.column(c)[begin].as_py() for c in ("keys", "targets", "outputs", "finals", "offset")}
                offset = row.pop("offset")
                machine = Transducer.read(**row)
                begin += 1
            if end <= begin:
                continue
            part = batch.slice(begin, end - begin)
            words = pa.concat_arrays([part.column("term").cast(pa.large_binary())])
            ends = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
            letters = np.frombuffer(words.buffers()[2] or b"", np.uint8)
            ordinal = machine.ordinals(letters, ends[:-1], np.diff(ends))
            known = pa.array(ordinal >= 0)
            out = pa.RecordBatch.from_arrays([part.column("group"), part.column("run"), pa.array(ordinal + offset), part.column("n")], ["group", "run", "ordinal", "n"])
            yield out.filter(known)


def _spelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by run, the transducer first: ordinals become terms."""
    machine, offset = None, 0
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            if r["keys"] is not None:
                machine, offset = Transducer.read(r["keys"], r["targets"], r["outputs"], r["finals"]), r["offset"]
            else:
                out.append((r["group"], machine.spell(r["ordinal"] - offset), r["value"], r["rank"]))
        if out:
            group, item, value, rank = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(group, pa.int64()), _text(list(item)), pa.array(value, pa.int64()), pa.array(rank, pa.int64())], ["group", "item", "value", "rank"])


def _with_machines(rows: DataFrame, machines: DataFrame, share: Column, shares: int) -> DataFrame:
    """``rows`` (with ``run``) behind their run's transducer, so that a task can stream them through it."""
    copies = machines.withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1)))).drop("lang", "first", "size")
    both = copies.unionByName(rows.withColumn("share", share), allowMissingColumns=True)
    return both.repartition("run", "share").sortWithinPartitions("run", "share", F.col("keys").isNull())


def _common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by ordinal: for pairs of groups that use a term, what it adds beyond their parts for it alone."""
    sums: dict[tuple[int, int], int] = {}
    f = lambda p, q: (p - q) * (p - q) // q

    def add(group: np.ndarray, p: np.ndarray, p0: np.ndarray, sizes: np.ndarray) -> None:
        starts = np.cumsum(sizes) - sizes
        i = np.repeat(np.arange(len(group)), np.repeat(sizes, sizes))
        j = np.arange(len(i)) - np.repeat(np.cumsum(np.repeat(sizes, sizes)) - np.repeat(sizes, sizes), np.repeat(sizes, sizes)) + np.repeat(np.repeat(starts, sizes), np.repeat(sizes, sizes))
        i, j = i[i != j], j[i != j]
        value = f(p[i], p[j]) - f(p[i], p0[j]) - f(p0[i], p[j]) + f(p0[i], p0[j])
        names, code = np.unique(group, return_inverse=True)
        pair, place = np.unique(code[i] * len(names) + code[j], return_inverse=True)
        total = np.zeros(len(pair), np.int64)
        np.add.at(total, place, value)
        for a, b, v in zip(names[pair // len(names)].tolist(), names[pair % len(names)].tolist(), total.tolist(), strict=True):
            sums[a, b] = sums.get((a, b), 0) + v

    def sent() -> Iterator[pa.RecordBatch]:
        if sums:
            a, b = zip(*sums, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(list(sums.values()), pa.int64())], ["group", "other", "value"])
            sums.clear()

    held = [np.zeros(0, np.int64)] * 4
    for last, batch in _and_end(batches):
        now = [np.zeros(0, np.int64)] * 4 if last else [batch.column(c).to_numpy() for c in ("ordinal", "group", "p", "p0")]
        held = [np.concatenate(x) for x in zip(held, now, strict=True)]
        cuts = np.flatnonzero(np.diff(held[0])) + 1
        ready = len(held[0]) if last else int(cuts[-1]) if len(cuts) else 0
        sizes = np.diff([0, *cuts[cuts < ready], ready])
        begin = first = 0
        for at in range(1, len(sizes) + 1):  # as many whole terms at once as make a bounded number of pairs
            if at == len(sizes) or int((sizes[first : at + 1] ** 2).sum()) > _PAIRS:
                end = begin + int(sizes[first:at].sum())
                add(*(x[begin:end] for x in held[1:]), sizes[first:at])
                begin, first = end, at
        held = [x[ready:] for x in held]
        if len(sums) > HELD:
            yield from sent()
    yield from sent()


def _and_end(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, pa.RecordBatch | None]]:
    for batch in batches:
        yield False, batch
    yield True, None


def _rate(n: Column, total: Column, size: Column) -> Column:
    """``1 + floor(UNIT * (n + 1) / (total + size))`` in whole numbers of any size."""
    wide = lambda c: c.cast("decimal(20,0)")
    return F.call_function("div", F.lit(UNIT).cast("decimal(11,0)") * wide(n + 1), wide(total + size)) + 1


def _stray(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def audit(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """``lang``, ``source``, ``part`` (pair or term), ``item``, ``value``, ``rank``."""
    spark = docs.sparkSession
    none = F.lit("")
    docs = docs.select(F.coalesce(F.col(lang).cast("string"), none).alias("lang"), F.coalesce(F.col(source).cast("string"), none).alias("source"), F.coalesce(F.col(text), none).alias("text"))
    machines = vocabulary(docs)
    runs = _Runs(machines.select("lang", "first", "size").collect())
    numbered = [(k, bytes(f), b + i, runs.offsets[b + i]) for k, b in runs.base.items() for i, f in enumerate(runs.firsts[k])]
    numbers = spark.createDataFrame(numbered, "lang string, first binary, run bigint, offset bigint")
    machines = stage(machines.join(numbers, ["lang", "first"]), "machines")

    group = F.xxhash64("lang", "source").alias("group")  # 64 bits name a pair of language and source
    groups = docs.select("lang", "source").distinct().select("*", group)
    sums = docs.select(group, "lang", "text").mapInArrow(_recounted(runs), "group bigint, run bigint, term string, n bigint")
    sums = sums.repartition("group", "run", "term").groupBy("group", "run", "term").agg(F.sum("n").alias("n"))
    share = F.pmod(F.xxhash64("group"), F.lit(SHARES)).cast("int")
    found = _with_machines(sums, machines, share, SHARES).mapInArrow(_through, "group bigint, run bigint, ordinal bigint, n bigint")
    found = stage(found, "ordinals")

    sizes = spark.createDataFrame(list(runs.terms.items()), "lang string, size bigint")
    totals = found.groupBy("group").agg(F.sum("n").alias("total"))
    groups = groups.join(totals, "group", "left").join(sizes, "lang", "left").na.fill(0, ["total", "size"])
    whole = F.sum("total").over(Window.partitionBy("lang"))
    absent = lambda total: F.when(F.col("size") > 0, _rate(F.lit(0).cast("long"), total, F.col("size"))).otherwise(1)
    groups = stage(groups.withColumn("lang_total", whole).withColumn("p0", absent(F.col("total"))), "groups")
    rates = groups.select("group", "lang", "total", "lang_total", "size", "p0")
    # A run belongs to one language, so run and ordinal name a term.
    rows = stage(found.join(rates, "group").withColumn("p", _rate(F.col("n"), F.col("total"), F.col("size"))), "rates")

    of_lang = rows.groupBy("run", "ordinal").agg(F.sum("n").alias("lang_n"))
    strays = rows.join(of_lang, ["run", "ordinal"]).withColumn("q", _rate(F.col("lang_n"), F.col("lang_total"), F.col("size")))
    strays = strays.where("p > q").select("group", "run", "ordinal", _stray(F.col("p"), F.col("q")).alias("value"))
    best = Window.partitionBy("group").orderBy(F.desc("value"), "ordinal")
    top = strays.withColumn("rank", F.row_number().over(best).cast("long")).where(F.col("rank") <= REPORTED)
    spelled = _with_machines(top, machines, F.lit(0), 1).mapInArrow(_spelled, "group bigint, item string, value bigint, rank bigint")
    named = groups.select("group", "lang", "source")
    term_part = spelled.join(named, "group").select("lang", "source", F.lit("term").alias("part"), "item", "value", F.col("rank").cast("int"))

    one = groups.select("lang", "group", "source", "size", "p0")
    two = groups.select("lang", F.col("group").alias("other"), F.col("source").alias("item"), F.col("p0").alias("q0"))
    pairs = one.join(two, "lang").where("group <> other")
    f0 = _stray(F.col("p0"), F.col("q0"))
    alike = rows.groupBy("lang", "group", "p", "p0").agg(F.count("*").alias("terms"))
    alone = alike.join(two, "lang").where("group <> other")
    mine = F.col("terms") * (_stray(F.col("p"), F.col("q0")) - f0)
    theirs = F.col("terms") * (_stray(F.col("q0"), F.col("p")) - _stray(F.col("q0"), F.col("p0")))
    ways = F.array(F.struct(F.col("group"), F.col("other"), mine.alias("value")), F.struct(F.col("other").alias("group"), F.col("group").alias("other"), theirs.alias("value")))
    used = rows.select("run", "ordinal", "group", "p", "p0").repartition("run", "ordinal").sortWithinPartitions("run", "ordinal")
    both = used.select(F.xxhash64("run", "ordinal").alias("ordinal"), "group", "p", "p0").mapInArrow(_common, "group bigint, other bigint, value bigint")
    added = alone.select(F.inline(ways)).unionAll(both).groupBy("group", "other").agg(F.sum("value").alias("value"))
    value = F.col("size") * f0 + F.coalesce("value", F.lit(0))
    pairs = pairs.join(added, ["group", "other"], "left").select("lang", "source", "group", "item", value.alias("value"))
    rank = F.row_number().over(Window.partitionBy("group").orderBy(F.desc("value"), "item"))
    pair_part = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", rank.alias("rank"))
    return pair_part.unionAll(term_part)
