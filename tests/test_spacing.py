"""The parallel minimum gap equals the serial rule, however keys and buckets are cut."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from crawlweave.operators import politeness, spacing
from crawlweave.operators.spacing import greedy_spacing


def serial(rows):
    last, out = {}, {}
    for key, clock, tie, gap in sorted(rows, key=lambda r: (r[1], r[2])):
        if key is None:
            out[tie] = (True, None, 0)
        elif key not in last or clock - last[key] >= gap:
            last[key] = clock
            out[tie] = (True, clock, 0)
        else:
            out[tie] = (False, last[key], gap - (clock - last[key]))
    return out


@pytest.mark.parametrize("seed, width, horizon", [(1, 50, 2_000), (2, 1_000, 5_000), (3, 7, 300), (4, 100_000, 1_000)])
def test_equals_serial_rule(spark, seed, width, horizon):
    rnd = random.Random(seed)
    # one hot key, several small ones, missing keys, mixed gaps and many equal clocks
    keys = ["hot"] * 6 + ["a", "b", "c", None]
    rows = [(rnd.choice(keys), rnd.randrange(-horizon // 4, horizon), i, rnd.choice([3, 3, 10, 60])) for i in range(3_000)]
    df = spark.createDataFrame(rows, "host string, t bigint, seq bigint, gap bigint")
    got = greedy_spacing(df, ["host"], "t", F.col("gap"), "seq", width).collect()
    assert {r["seq"]: (r["granted"], r["last_grant"], r["wait"]) for r in got} == serial(rows)


def test_large_gap_reaches_over_many_buckets(spark):
    rows = [("h", t, t, 500) for t in range(0, 3_000, 7)]
    df = spark.createDataFrame(rows, "host string, t bigint, seq bigint, gap bigint")
    got = greedy_spacing(df, ["host"], "t", F.col("gap"), "seq", 10).collect()
    assert {r["seq"]: (r["granted"], r["last_grant"], r["wait"]) for r in got} == serial(rows)


def test_small_arrow_batches_do_not_split_groups(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        rows = [(f"h{i % 3}", i * 2, i, 9) for i in range(400)]
        df = spark.createDataFrame(rows, "host string, t bigint, seq bigint, gap bigint")
        got = greedy_spacing(df, ["host"], "t", F.col("gap"), "seq", 100).collect()
        assert {r["seq"]: (r["granted"], r["last_grant"], r["wait"]) for r in got} == serial(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_first_is_free_second_waits_and_is_deferred(spark):
    df = spark.createDataFrame([("h", 0, 1), ("h", 100, 2), ("h", 600, 3)], "host string, t_ms bigint, seq bigint")
    delay = politeness.effective_delay(F.lit(0).cast("bigint"))
    out = politeness.throttle(df, "t_ms", delay, "seq")
    assert [(r["granted"], r["wait"]) for r in out.orderBy("seq").collect()] == [(True, 0), (False, 400), (True, 0)]
    later = politeness.deferred(out, "t_ms").collect()
    assert [(r["seq"], r["not_before"]) for r in later] == [(2, 500)]


def test_pages_without_host_wait_for_none(spark):
    df = spark.createDataFrame([(None, 1, 500), (None, 2, 900), ("h", 3, 500), ("h", 4, 500), (None, 70_000, 5)], "host string, n bigint, d bigint")
    out = politeness.slot_plan(df, F.col("d"), "n", start_ms=7).collect()
    assert {(r["host"], r["n"]): (r["slot"], r["planned_ms"]) for r in out} == {
        (None, 1): (1, 7), (None, 2): (1, 7), ("h", 3): (1, 7), ("h", 4): (2, 507), (None, 70_000): (1, 7),
    }


def test_slot_plan_waits_own_delay(spark):
    df = spark.createDataFrame([("h", 1, 500), ("h", 2, 2000), ("h", 3, 500), ("g", 9, 700)], "host string, n bigint, d bigint")
    out = politeness.slot_plan(df, F.col("d"), "n", start_ms=10).collect()
    assert {(r["host"], r["n"]): (r["slot"], r["planned_ms"]) for r in out} == {
        ("h", 1): (1, 10), ("h", 2): (2, 2010), ("h", 3): (3, 2510), ("g", 9): (1, 10),
    }


def test_one_host_with_a_long_history(spark):
    """Twenty thousand buckets of one host: three levels of composed step functions."""
    n = 400_000
    gap = F.when(F.col("seq") % 11 == 0, 37).otherwise(13).cast("bigint")
    df = spark.range(n).selectExpr("'h' as host", "id * 5 + pmod(xxhash64(id), 4) as t", "id as seq")
    got = greedy_spacing(df, ["host"], "t", gap, "seq", 100).where("granted").orderBy("seq").select("seq", "t").collect()
    rows = df.withColumn("gap", gap).orderBy("t", "seq").collect()
    last, want = None, []
    for r in rows:
        if last is None or r.t - last >= r.gap:
            last = r.t
            want.append((r.seq, r.t))
    assert [tuple(r) for r in got] == want


def test_composed_blocks_act_like_their_parts():
    """A block's step function, from its parts', ends every possible last grant where the parts one by one do."""
    draw = np.random.default_rng(3)
    for _ in range(30):
        points = np.sort(draw.choice(np.arange(640, 1280), draw.integers(1, 60), replace=False))
        pdf = pd.DataFrame({"key": "h", "bucket": points // 10, "clock": points, "gap": draw.choice([15, 40, 90], len(points)), "tie": 0})
        steps = spacing._summaries(pdf.sort_values(["bucket", "clock"], ignore_index=True), 10)
        parts = steps.rename(columns={"bucket": "part"}).assign(bucket=1).sort_values(["part", "upto"], ignore_index=True)
        block = spacing._composed(parts, 640)
        for last in [-10_000, *range(500, 640)]:
            one = last
            for _, own in parts.groupby("part"):
                fit = own[own["upto"] >= one]
                one = int(fit["leaves"].iloc[0]) if len(fit) else one
            fit = block[block["upto"] >= last]
            assert (int(fit["leaves"].iloc[0]) if len(fit) else last) == one
