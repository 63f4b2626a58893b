"""Embedding near duplicates by lattice hashing against all pairs."""

import math

import numpy as np
import pytest

from crawlweave.llm import lattice

SCHEMA = "vec_id bigint, embedding array<double>, label int"


def brute(rows):
    ok = [i for i, (_, v, l) in enumerate(rows) if l is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = [0] * len(rows)
    for a, i in enumerate(ok):
        for j in ok[:a]:
            (_, v, l), (_, w, m) = rows[i], rows[j]
            if l == m and len(v) == len(w):
                x, y = (np.array(z) / max(map(abs, z)) for z in (v, w))
                if x @ y / math.sqrt((x @ x) * (y @ y)) >= 0.93:
                    links[i] += 1
                    links[j] += 1
                    parent[find(i)] = find(j)
    least = {}
    for i, (k, _, _) in enumerate(rows):
        r = find(i)
        least[r] = min((x for x in (least.get(r), k) if x is not None), default=None)
    return sorted(((k, links[i], least[find(i)], least[find(i)] is None or k == least[find(i)]) for i, (k, _, _) in enumerate(rows)), key=str)


def check(spark, rows, schema=SCHEMA):
    df = spark.createDataFrame(rows, schema).repartition(3)
    got = lattice.near_duplicates(df.selectExpr("*", "1 as id", "2 as size", "'x' as n_links", "3 as a", "4 as cell"))
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


def at_cosine(draw, x, c):
    z = draw.normal(size=len(x))
    u = x / np.linalg.norm(x)
    z -= (z @ u) * u
    return c * u + math.sqrt(1 - c * c) * z / np.linalg.norm(z)


def planted(width=48):
    draw = np.random.default_rng(2)
    vectors, labels = [], []
    for k in range(25):
        base = draw.normal(size=width)
        vectors += [base, 3 * at_cosine(draw, base, draw.uniform(0.94, 0.999)), at_cosine(draw, base, draw.uniform(0.85, 0.92))]
        labels += [k % 3] * 3
    hot = draw.normal(size=width)  # a group of near copies, its links not all between all
    vectors += [at_cosine(draw, hot, draw.uniform(0.955, 0.999)) for _ in range(90)] + [hot] * 4
    labels += [1] * 90 + [1, 1, 2, 1]
    ids = draw.permutation(len(vectors))
    return [(int(i), [float(x) for x in v], int(l)) for i, v, l in zip(ids, vectors, labels)]


def test_equals_all_pairs(spark):
    check(spark, planted())


def test_blocks_of_a_crowded_cell(spark, monkeypatch):
    monkeypatch.setattr(lattice, "BLOCK", 8)
    monkeypatch.setattr(lattice, "_PAIRS", 50)
    check(spark, planted())


def test_gaps_and_repeats(spark):
    a, b, zero = [1.0, 2.0, -1.0, 0.5], [-2.0, 1.0, 0.0, 0.25], [0.0] * 4
    rows = [(5, a, 1), (3, [2 * x for x in a], 1), (9, a, 2), (9, a, None), (2, a, 1), (2, a, 1), (None, a, 1), (8, b, 1), (None, b, 3), (None, b, 3)]
    rows += [(11, zero, 1), (12, zero, 1), (13, None, 1), (14, [], 1), (15, [None] + a[1:], 1), (16, [math.nan] + a[1:], 1), (17, [math.inf] + a[1:], 1)]
    rows += [(20, a[:3], 1), (21, a[:3], 1), (22, [x * 1e200 for x in a], 1), (23, [x * 1e-200 for x in a], 1), (4, [1.0], 1), (6, [5.0], 1)]
    check(spark, rows)


@pytest.mark.parametrize("rows", [[], [(1, None, 1)], [(1, [1.0, 0.0], 1)]])
def test_nothing_to_link(spark, rows):
    check(spark, rows)


def test_recall_at_the_threshold():
    """Pairs of cosine 0.93 to 0.96 meet nearly always; unlike ones seldom."""
    draw = np.random.default_rng(4)
    x = draw.normal(size=(3000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    group = np.zeros(len(x), np.int64)

    def meet(y):
        (own, near), (own_y, near_y) = lattice.cells(x, group), lattice.cells(y, group)
        return ((own == own_y) | (near == own_y[:, :, None]).any(2) | (near_y == own[:, :, None]).any(2)).any(1).mean()

    assert meet(np.array([at_cosine(draw, v, 0.93) for v in x])) > 0.99
    assert meet(np.array([at_cosine(draw, v, 0.96) for v in x])) > 0.999
    assert meet(np.roll(x, 1, 0)) < 0.05
    assert not set(lattice.cells(x[:50], group[:50])[0].ravel()) & set(lattice.cells(x[:50], group[:50] + 1)[0].ravel())


def test_decoding_finds_the_nearest_lattice_point():
    draw = np.random.default_rng(6)
    x = draw.normal(size=(500, 8)) * 3
    point = lattice.decode(x)
    moves = lattice.shortest()
    assert len(moves) == 240 and np.allclose((moves**2).sum(1), 2)
    assert ((point * 2) % 1 == 0).all() and (point.sum(1) % 2 == 0).all()
    mine = ((x - point) ** 2).sum(1)
    assert (mine <= 1 + 1e-9).all()  # no point is farther from the lattice than 1
    for move in moves:
        assert (mine <= ((x - point - move) ** 2).sum(1) + 1e-9).all()
