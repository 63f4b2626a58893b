"""Near duplicates against a comparison of all pairs, with lists long enough for every path."""

import random
import re

from crawlweave.llm import minhash


def whole_set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    sets = [(k, whole_set(t)) for k, t in rows if k is not None]
    parent = {k: k for k, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            both = len(s & t)
            if s and t and 100 * both >= 75 * (len(s) + len(t) - both) and find(a) != find(b):
                parent[max(find(a), find(b))] = min(find(a), find(b))
    return sorted((k if k is not None else -1, len(whole_set(t)), find(k) if k is not None else None, k is None or find(k) == k) for k, t in rows)


def corpus():
    draw = random.Random(11)
    fresh = lambda n: [f"w{draw.randrange(10**6)}" for _ in range(n)]
    rows, base, passage = [], fresh(150), fresh(60)
    for _ in range(90):  # near copies, many of them too far from each other
        copy = list(base)
        for _ in range(draw.randrange(0, 9)):
            copy[draw.randrange(150)] = f"e{draw.randrange(10**6)}"
        rows.append(" ".join(copy))
    for _ in range(40):  # unlike texts that share a passage; every fifth has a near copy of its own
        own = fresh(draw.choice([10, 40, 200]))
        rows.append(" ".join(own + passage))
        if draw.random() < 0.2:
            rows.append(" ".join(own + passage + ["tail"]))
    rows += [" ".join(base).upper()] * 30 + ["one two", "One  two", "three", "", None, " \n"]
    rows += [" ".join(fresh(4000))] * 2
    draw.shuffle(rows)
    return [(i, t) for i, t in enumerate(rows)]


def check(spark, rows):
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = minhash.near_duplicates(df.selectExpr("doc_id", "text", "1 as n", "2 as component_id", "3 as a")).collect()
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.n_shingles, r.component_id, r.kept) for r in got) == brute(rows)


def test_components(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 16)
    check(spark, corpus())


def test_gaps_and_repeated_rows(spark):
    a, b = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    check(spark, [(5, a), (5, a), (5, b), (7, b), (None, a), (None, None), (9, None), (9, "x"), (3, a + " z"), (4, "x")])


def test_empty_table(spark):
    assert minhash.near_duplicates(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []


def test_least_shared_is_exact_for_small_sets():
    assert [minhash.least_shared(n) for n in (1, 4, 5, 48)] == [1, 3, 4, 36]
    assert 20 < minhash.least_shared(1000) < 36
