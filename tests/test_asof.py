"""As-of join and rules in force against plain Python."""

import random

import pytest

from crawlweave.operators import robots
from crawlweave.operators.asof import asof_join


def check(spark, rows, versions):
    left = spark.createDataFrame(rows, "id bigint, k string, t bigint, since string").withColumnRenamed("since", "note").repartition(5)
    right = spark.createDataFrame(versions, "k string, since bigint, v string, more array<string>").repartition(3)
    got = asof_join(left, right, ["k"], "t", "since", ["v", "more"])
    want = []
    for i, k, t, note in rows:
        fit = [(s, v, m) for kk, s, v, m in versions if kk == k and s is not None and t is not None and s <= t]
        s, v, m = max(fit, default=(None, None, None))
        want.append((i, k, t, note, s, v, m))
    assert got.columns == ["id", "k", "t", "note", "since", "v", "more"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_hot_key_gaps_and_ties(spark):
    draw = random.Random(4)
    keys = ["hot"] * 5 + ["a", "b", None, "none"]
    rows = [(i, draw.choice(keys), draw.choice([None, *range(0, 500, 5)]), draw.choice("xy")) for i in range(3000)]
    versions = [(draw.choice(keys[:-1]), draw.choice([None, *range(20, 520, 7)]), f"v{j}", [f"m{j}"]) for j in range(300)]
    check(spark, rows, versions)


@pytest.mark.parametrize("rows, versions", [([], []), ([(1, "a", 5, "x")], []), ([], [("a", 1, "v", [])]), ([(1, "a", 5, "x")] * 2, [("a", 5, "v", ["m"]), ("a", 6, "w", None)])])
def test_edges(spark, rows, versions):
    check(spark, rows, versions)


def test_rules_are_those_of_the_cached_copy(spark):
    """A file served after the fetch counts only once the copy is half an hour old."""
    minute = 60_000
    base = "http://h.example.com"
    versions = [(base, 0, 200, "User-agent: *\nDisallow: /a"), (base, 10 * minute, 200, "User-agent: *\nDisallow: /b"), (base, 50 * minute, 404, "")]
    versions = spark.createDataFrame(versions, "base_url string, served_ms bigint, status int, body string")
    rows = [(i, f"{base}/{p}", t * minute) for i, (p, t) in enumerate([("a", 5), ("b", 6), ("b", 34), ("b", 36), ("a", 37), ("b", 64), ("b", 67), ("a", 68)])]
    rows.append((99, "http://other.example.com/a", 5 * minute))
    df = spark.createDataFrame(rows, "seq bigint, url string, t_ms bigint")
    got = robots.rules_in_force(df, versions, "crawlbot", "t_ms", "seq").orderBy("seq").collect()
    # fetched at 5, again at 36 (the second file) and at 67 (no file any more)
    assert [r.allowed for r in got] == [False, True, True, False, True, False, True, True, True]
    assert [r.refetched for r in got] == [True, False, False, True, False, False, True, False, True]
    assert [r.served_ms for r in got][:4] == [0, 0, 0, 10 * minute]
