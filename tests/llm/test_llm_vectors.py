"""Vector code compression against plain numpy."""

import hashlib
import math

import numpy as np
import pytest

from crawlweave.llm import vector_codes


def usable(v, width):
    return v is not None and len(v) == width and all(x is not None and math.isfinite(x) and abs(x) < 65536 for x in v)


def brute_codes(rows, width):
    """``rows``: (vec_id, vector, label); the contract's rounds written out."""
    kept = sorted((r for r in rows if usable(r[1], width)), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return []
    q = [[math.floor(1024 * x) for x in v] for _, v, _ in kept]
    n, codes, errors, flat = width // 4, [""] * len(kept), [0] * len(kept), []
    for p in range(4):
        parts = [v[p * n : (p + 1) * n] for v in q]
        book = [list(x) for x in parts[:256]]

        def assign(parts=parts, book=book):
            return [min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(book)) for x in parts]

        for _ in range(4):
            found = assign()
            for e in range(len(book)):
                own = [x for x, (_, f) in zip(parts, found) if f == e]
                if own:
                    book[e] = [sum(c) // len(own) for c in zip(*own)]
        for i, (d, e) in enumerate(assign()):
            codes[i] += f"{e:02x}"
            errors[i] += d
        flat += [str(x) for c in book for x in c]
    sha = hashlib.sha256(",".join(flat).encode()).hexdigest()
    total = {}
    for (_, _, label), e in zip(kept, errors):
        total[label] = total.get(label, 0) + e
    return sorted(((k, c, e, total[l], sha) for (k, _, l), c, e in zip(kept, codes, errors)), key=str)


def check(spark, rows, width, parts=3):
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int").repartition(parts)
    df = df.selectExpr("*", "1 as code", "2 as _row", "3 as _q", "4 as error", "5 as entry")
    got = vector_codes.compress(df)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == brute_codes(rows, width)


def test_codes_equal_plain_rounds(spark):
    draw = np.random.default_rng(3)
    rows = [(int(i), [float(x) for x in draw.normal(size=8)], int(draw.integers(3))) for i in draw.permutation(700)]
    hot = [float(x) for x in draw.normal(size=8)]  # a third of all rows sit on one entry
    rows += [(1000 + i, [x + float(draw.normal()) / 500 for x in hot], 1) for i in range(350)]
    check(spark, rows, 8)


def test_codes_with_gaps_ties_and_repeats(spark):
    good = [(5, [0.5, -0.5, 1.0, 2.0], 1), (5, [0.5, -0.5, 1.0, 2.0], 1), (5, [0.25, -0.5, 1.0, 2.0], None), (7, [0.0, -0.0, 1e-9, -1e-9], None), (None, [1.0, 1.0, 1.0, 1.0], 2)]
    bad = [(1, None, 1), (2, [None, 1.0, 1.0, 1.0], 1), (3, [math.nan, 1.0, 1.0, 1.0], 1), (8, [math.inf, 1.0, 1.0, 1.0], 1), (9, [1.0, 2.0], 1), (10, [1.0] * 8, 1), (11, [1e6, 0.0, 0.0, 0.0], 1), (12, [], 1)]
    check(spark, good + bad, 4)
    check(spark, [(i, [float(i % 3)] * 4, 0) for i in range(600)], 4)


def test_large_components_stay_exact(spark):
    draw = np.random.default_rng(5)
    check(spark, [(i, [float(x) for x in draw.uniform(-65535, 65535, size=4)], 0) for i in range(300)], 4)


@pytest.mark.parametrize("rows", [[], [(1, None, 1), (2, [None], 1)]])
def test_codes_of_nothing(spark, rows):
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    assert vector_codes.compress(df).collect() == []


def test_only_movers_leave_their_partition(spark):
    """Residents keep partition and owner through a round; movers arrive at the partition of their new owner."""
    draw = np.random.default_rng(9)
    parts = draw.integers(-50, 50, (400, 2)).astype(np.int64)
    books = [parts[:8].copy() for _ in range(4)]
    entries, errors = vector_codes.nearest(parts, books[0])
    ones = np.ones(8, np.int64)
    start = spark.sparkContext.parallelize(list(vector_codes._dealt(0, entries, (np.arange(400), parts, errors), ones)), 3)
    state = start.partitionBy(5, vector_codes._home)
    newer = [b + 3 for b in books]
    place = lambda rdd: dict(
        x for part in rdd.mapPartitionsWithIndex(lambda i, b: [[(int(r), (i, o)) for o, (rows, _, _) in b for r in rows]]).collect() for x in part
    )
    before, after = place(state), place(vector_codes._migrated(vector_codes._reassigned(state, newer, [ones] * 4), 5))
    want, _ = vector_codes.nearest(parts, newer[0])
    assert {r: o[1] for r, (_, o) in after.items()} == dict(enumerate(want.tolist()))
    assert any(want != entries) and any(want == entries)
    for r in range(400):
        if want[r] == entries[r]:
            assert after[r] == before[r]
        assert after[r][0] == vector_codes._home(after[r][1]) % 5
