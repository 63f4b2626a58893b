"""Range joins against all pairs."""

import random

import pytest

from crawlweave.operators import intervals

LEFT, RIGHT = "id bigint, k string, a bigint, b bigint", "k string, name bigint, c bigint, d bigint"


def check(spark, left, right, width=10):
    got = intervals.overlap_join(spark.createDataFrame(left, LEFT).repartition(3), spark.createDataFrame(right, RIGHT).repartition(3), ["k"], ("a", "b"), ("c", "d"), width)
    assert got.columns == ["id", "k", "a", "b", "name", "c", "d"]
    ok = lambda s, e: s is not None and e is not None and s < e
    want = [(i, k, a, b, n, c, d) for i, k, a, b in left for q, n, c, d in right if k == q and ok(a, b) and ok(c, d) and a < d and c < b]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_overlaps(spark):
    draw = random.Random(5)
    keys = ["hot"] * 4 + ["a", None]

    def span(most):
        start = draw.randrange(-200, 400)
        return draw.choice([None, start, start, start, start]), start + draw.randrange(-3, most)

    left = [(i, draw.choice(keys), *span(30)) for i in range(250)]
    right = [(draw.choice(keys), i, *span(300)) for i in range(60)]
    check(spark, left, right)
    check(spark, left * 2, right[:5] * 2, width=1000)


@pytest.mark.parametrize("left, right", [([], []), ([(1, "a", 0, 5)], []), ([(1, "a", 0, 5)], [("a", 1, 5, 9), ("a", 2, 4, 5), ("b", 3, 0, 9)])])
def test_edges(spark, left, right):
    check(spark, left, right)


def test_points_of_a_hot_crawl(spark):
    """One crawl with nearly all rows is as many groups as it has bins."""
    points = spark.range(50_000).selectExpr("id", "if(id % 100 = 0, 2, 1) as crawl", "id * 3 as t")
    spans = spark.range(500).selectExpr("1 as crawl", "id as span", "id * 300 as lo", "id * 300 + 150 as hi")
    got = intervals.point_join(points, spans, ["crawl"], "t", ("lo", "hi"), 1000)
    assert got.where("t % 300 >= 150 or t div 300 <> span").count() == 0
    assert got.count() == points.where("crawl = 1 and t % 300 < 150").count()
    assert got.columns == ["id", "crawl", "t", "span", "lo", "hi"]


def test_state_intervals(spark):
    rows = [(1, 1, 10, "start"), (1, 2, 20, "page"), (1, 3, 30, "pause"), (1, 4, 50, "resume"), (1, 5, 90, "end"), (2, 6, 5, "page"), (2, 7, 7, "start")]
    log = spark.createDataFrame(rows, "crawl_id bigint, event_id bigint, t_ms bigint, action string")
    got = sorted(map(tuple, intervals.state_intervals(log).collect()), key=str)
    assert got == [(1, "finished", 90, None), (1, "paused", 30, 50), (1, "running", 10, 30), (1, "running", 50, 90), (2, "running", 7, None)]
