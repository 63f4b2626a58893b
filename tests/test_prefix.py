"""Bucketed running values equal plain windows on a table where one key holds most rows."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from crawlweave.operators import prefix
from crawlweave.operators.counters import rolling_rate
from crawlweave.operators.skew import dimension_join


@pytest.fixture(scope="module")
def rows(spark):
    rnd = random.Random(5)
    data = [(rnd.choice(["hot", "hot", "hot", "x", "y"]), i * 3, rnd.randrange(10), rnd.choice([None, 1, 2])) for i in range(2_000)]
    return spark.createDataFrame(data, "k string, seq bigint, v bigint, m int").repartition(7)


def same(left, right):
    assert left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


@pytest.mark.parametrize("exclusive", [False, True])
def test_running_total(rows, exclusive):
    w = Window.partitionBy("k").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1 if exclusive else 0)
    got = prefix.running_total(rows, ["k"], ["seq"], prefix.block("seq", 100), {"t": F.col("v")}, exclusive)
    same(got, rows.withColumn("t", F.coalesce(F.sum("v").over(w), F.lit(0))))


def test_first_of_key(rows):
    w = Window.partitionBy("k").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    got = prefix.running_total(rows, ["k"], ["seq"], prefix.block("seq", 100), {"t": F.col("v")}, firsts={"f": F.col("seq")})
    same(got.select("k", "seq", "f"), rows.select("k", "seq", F.first("seq").over(w).alias("f")))


@pytest.mark.parametrize("exclusive", [False, True])
def test_carry_forward(rows, exclusive):
    w = Window.partitionBy("k").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1 if exclusive else 0)
    got = prefix.carry_forward(rows, ["k"], ["seq"], prefix.block("seq", 60), {"c": F.col("m")}, exclusive)
    same(got, rows.withColumn("c", F.last("m", ignorenulls=True).over(w)))


def test_trailing_count(rows):
    w = Window.partitionBy("k").orderBy("seq").rangeBetween(-100, 0)
    got = prefix.trailing_count(rows, ["k"], "seq", 100, "n")
    same(got, rows.withColumn("n", F.count(F.lit(1)).over(w)).select(*got.columns))


def test_number_by_range(spark, rows):
    w = Window.partitionBy("k").orderBy("v", "seq")
    start = spark.createDataFrame([("x", 1000)], "k string, used bigint")
    got = prefix.number_by_range(rows, ["k"], ["v", "seq"], "n", "t", start)
    used = F.when(F.col("k") == "x", 1000).otherwise(0)
    same(got.select("k", "seq", "n"), rows.select("k", "seq", (F.row_number().over(w) + used).cast("bigint").alias("n")))


def test_dimension_join_with_hot_and_missing_keys(spark, rows):
    facts = rows.unionByName(spark.createDataFrame([(None, -1, 0, None)], rows.schema))
    dims = spark.createDataFrame([("hot", "H"), ("x", "X"), ("z", "Z")], "k string, name string")
    got = dimension_join(facts, dims, "k", "seq")
    same(got.select("k", "seq", "name"), facts.join(dims, "k", "left").select("k", "seq", "name"))


def test_rate_divides_by_active_seconds(spark):
    log = spark.createDataFrame([(1, 0), (1, 500), (1, 30_000), (1, 30_500), (1, 90_000)], "crawl_id bigint, t_ms bigint")
    got = rolling_rate(log).orderBy("t_ms").collect()
    # counts 1 2 3 3 1 over max(1, elapsed) seconds, at most 30
    assert [(r["rate_n"], r["rate"]) for r in got] == [(1, 1.0), (2, 2.0), (3, 0.1), (3, 0.1), (1, 0.0)]


def test_rows_without_key_or_clock_stay(spark):
    rows = [(None, 1), (None, 5), ("a", None), ("a", 2), (None, None)]
    df = spark.createDataFrame(rows, "k string, seq bigint")
    counted = prefix.trailing_count(df, ["k"], "seq", 10, "n").collect()
    assert sorted((str(r["k"]), r["seq"] or 0, r["n"]) for r in counted) == [
        ("None", 0, 0), ("None", 1, 1), ("None", 5, 2), ("a", 0, 0), ("a", 2, 1),
    ]
    summed = prefix.running_total(df, ["k"], ["seq"], prefix.block("seq"), {"n": F.lit(1)}).collect()
    assert sorted((str(r["k"]), r["n"]) for r in summed) == [("None", 1), ("None", 2), ("None", 3), ("a", 1), ("a", 2)]
    placed = prefix.number_by_range(df, ["k"], ["seq"], "n", "placed").collect()
    assert sorted((str(r["k"]), r["n"]) for r in placed) == [("None", 1), ("None", 2), ("None", 3), ("a", 1), ("a", 2)]
