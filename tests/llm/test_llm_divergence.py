"""Source divergence against whole-number arithmetic in plain Python, and the transducer against a sorted list."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from crawlweave.llm import divergence

SCHEMA = "text string, lang string, source string"


def brute(rows):
    docs = [(l or "", s or "", [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t or "")]) for t, l, s in rows]
    out = []
    for lang in {d[0] for d in docs}:
        seen = Counter(t for l, _, ws in docs if l == lang for t in set(ws))
        kept = sorted((t for t, n in seen.items() if n >= 3), key=str.encode)
        counts = {s: Counter() for l, s, _ in docs if l == lang}
        for l, s, ws in docs:
            if l == lang:
                counts[s].update(w for w in ws if seen[w] >= 3)
        whole = sum(counts.values(), Counter())
        rate = lambda c: {t: 1 + 10**9 * (c[t] + 1) // (sum(c.values()) + len(kept)) for t in kept}  # noqa: E731,B023
        p, q = {s: rate(c) for s, c in counts.items()}, rate(whole)
        f = lambda a, b: (a - b) * (a - b) // b
        for s in counts:
            pairs = sorted(((-sum(f(p[s][t], p[o][t]) for t in kept), o.encode(), o) for o in counts if o != s))
            terms = sorted((-f(p[s][t], q[t]), t.encode(), t) for t in kept if counts[s][t] and p[s][t] > q[t])
            out += [(lang, s, "pair", o, -v, r) for r, (v, _, o) in enumerate(pairs, 1)]
            out += [(lang, s, "term", t, -v, r) for r, (v, _, t) in enumerate(terms[:200], 1)]
    return sorted(out)


def check(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3).selectExpr("*", "1 as n", "'r' as run", "2 as `group`", "3 as item")
    got = divergence.audit(df)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == brute(rows)


def corpus(n=300):
    draw = random.Random(3)
    words = [f"{a}{b}" for a in ("ab", "Ba", "é", "zz", "日本", "q") for b in ("", "x", "xy", "ÄÖ", "n")] + ["the"] * 30
    rows = []
    for i in range(n):
        lang, source = draw.choice(["en"] * 3 + ["de", None, "xx"]), draw.choice(["hot"] * 4 + ["s1", "S2", "é", None])
        text = " ".join(draw.choice(words) + draw.choice(["", ".", "-1", "_"]) for _ in range(draw.choice([0, 3, 40])))
        rows.append((text, lang, source))
    return rows + [(None, "en", "empty"), ("123 ...", "zz", "only"), ("once", "once", "a"), ("once", "once", "b"), ("a " * 5000, "en", "long")] * 2


def test_equals_plain_arithmetic(spark):
    check(spark, corpus())


def test_many_runs(spark, monkeypatch):
    monkeypatch.setattr(divergence, "RUN", 3)
    check(spark, corpus(120))


def test_small_memory_gives_the_same_sums(monkeypatch):
    """Sums that a task sends early add up to those it would send at its end."""
    rows = corpus(100)
    batches = [pa.RecordBatch.from_pydict({"text": [t or "" for t, _, _ in rows[i : i + 7]], "lang": [x or "" for _, x, _ in rows[i : i + 7]]}) for i in range(0, len(rows), 7)]
    draw = np.random.default_rng(1)
    ordinal = np.sort(draw.integers(0, 40, 300))
    rates = {"ordinal": ordinal, "group": draw.integers(0, 9, 300), "p": draw.integers(1, 10**9, 300), "p0": draw.integers(1, 10**6, 300)}
    rates = pa.RecordBatch.from_pydict({k: pa.array(v) for k, v in rates.items()})

    def sums():
        out = []
        for made in (divergence._documents(iter(batches)), divergence._common(iter([rates.slice(i, 11) for i in range(0, 300, 11)]))):
            total = Counter()
            for batch in made:
                for *key, n in zip(*(batch.column(i).to_pylist() for i in range(3))):
                    total[tuple(key)] += n
            out.append(total)
        return out

    want = sums()
    monkeypatch.setattr(divergence, "HELD", 5)
    monkeypatch.setattr(divergence, "_PAIRS", 20)
    assert sums() == want


@pytest.mark.parametrize("rows", [[], [(None, None, None)], [("one two", "en", "a"), ("three", "en", "b")], [("one", "en", "a")] * 3])
def test_edges(spark, rows):
    check(spark, rows)


def test_transducer_orders_and_spells():
    draw = random.Random(5)
    words = sorted({"".join(draw.choice("abcé") for _ in range(draw.randrange(1, 7))).encode() for _ in range(800)} | {b"a" * 400})
    machine = divergence.Transducer.read(*divergence.Transducer.of(words).parts())
    others = [b"", b"zzz", b"a" * 399, b"ab" * 50]
    asked = words + others
    ends = np.cumsum([len(w) for w in asked])
    letters = np.frombuffer(b"".join(asked), np.uint8)
    got = machine.ordinals(letters, ends - [len(w) for w in asked], np.array([len(w) for w in asked]))
    assert got.tolist() == list(range(len(words))) + [words.index(w) if w in words else -1 for w in others]
    assert [machine.spell(i) for i in range(len(words))] == words


def test_transducer_is_minimal():
    """As many states as there are different sets of continuations."""
    words = sorted(f"{a}{b}".encode() for a in ("on", "off", "up") for b in ("", "s", "ing", "load", "loads"))
    prefixes = {w[:i] for w in words for i in range(len(w) + 1)}
    rests = {frozenset(w[len(p) :] for w in words if w.startswith(p)) for p in prefixes}
    assert len(divergence.Transducer.of(words).finals) == len(rests)


def test_sums_of_tasks_are_added_after_the_exchange_only(spark, monkeypatch):
    plans, stage = {}, divergence.stage

    def seen(df, name):
        plans[name] = df._jdf.queryExecution().toString()
        return stage(df, name)

    monkeypatch.setattr(divergence, "stage", seen)
    docs = spark.createDataFrame([("alpha beta", "en", s) for s in "abc"] * 3, "text string, lang string, source string")
    assert divergence.audit(docs).where("part = 'term'").count() == 0
    for name in ("kept", "ordinals"):
        lines = plans[name].split("== Physical Plan ==")[1].splitlines()
        adds = max(i for i, line in enumerate(lines) if "partial_sum(n" in line)
        assert any("Exchange hashpartitioning" in line and "term" in line for line in lines[adds:])


def test_terms_are_runs_of_letters_and_other_bytes():
    every = bytes(range(256)) + b"aB" + bytes(range(256))
    assert divergence.terms(every) == re.findall(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", every.replace(b"B", b"b").translate(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))))
