"""Requests that come too early run later: batch and stream against the rule written row by row."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructType

from crawlweave.operators import politeness
from crawlweave.plans import catalog
from crawlweave.session import new_path
from crawlweave.streaming import feed, gate

SCHEMA = "seq bigint, host string, t_ms bigint, gap bigint"


def served(rows):
    last, out = {}, []
    for seq, host, t, gap in sorted((r for r in rows if r[1] is not None), key=lambda r: (r[2], r[0])):
        at = t if host not in last else max(t, last[host] + gap)
        last[host] = at
        out.append((seq, host, t, gap, at))
    return sorted(out + [(s, None, t, g, t) for s, h, t, g in rows if h is None])


def requests(n, hosts=4):
    draw = random.Random(7)
    rows = [(i, draw.choice([f"h{k}" for k in range(hosts)] + ["hot"] * 3 + [None]), 1_000_000 + draw.randrange(40_000), draw.choice((200, 500, 900))) for i in range(n)]
    return rows


def test_dispatch_times(spark):
    rows = requests(3000)
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    got = politeness.dispatch_times(df, "t_ms", F.col("gap"), "seq")
    assert got.columns == [*df.columns, "granted_ms"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(served(rows), key=str)


def test_dispatch_times_of_one_huge_host(spark):
    n = 200_000
    df = spark.range(n).selectExpr("id as seq", "'one' as host", "id div 7 as t_ms", "3L as gap").repartition(8)
    got = politeness.dispatch_times(df, "t_ms", F.col("gap"), "seq")
    assert got.where("granted_ms <> 3 * seq").count() == 0  # asked 7 times a tick, served every third


def test_dispatch_times_of_nothing(spark):
    assert politeness.dispatch_times(spark.createDataFrame([], SCHEMA), "t_ms", F.col("gap"), "seq").collect() == []


@pytest.fixture(scope="module")
def streamed(spark):
    """Six files in time order but mixed within ten seconds, and a closing tick."""
    rows, path = requests(900), new_path(spark, "requests")
    by_time = sorted(rows, key=lambda r: r[2] + random.Random(r[0]).randrange(10_000))
    for k in range(6):
        spark.createDataFrame(by_time[k * 150 : k * 150 + 150], SCHEMA).coalesce(1).write.mode("append").parquet(path)
    spark.createDataFrame([(None, None, 9_000_000_000, None)], SCHEMA).coalesce(1).write.mode("append").parquet(path)
    stream = feed.file_feed(spark, path, SCHEMA, "*.parquet", files_per_trigger=1)
    return rows, gate.gated_feed(stream, "host", "t_ms", "gap", "seq", lateness="10 seconds")


def test_gate_grants_every_row_once(streamed):
    rows, sink = streamed
    got = [tuple(r) for r in sink.all().where("seq is not null").collect()]
    assert sorted(got, key=str) == sorted(served(rows), key=str)


def test_gate_runs_deferred_rows_while_the_feed_goes_on(streamed):
    rows, sink = streamed
    assert len(sink.batches) >= 7
    by_batch = [sink.batch(b).where("host is not null").agg(F.count("*"), F.min("granted_ms"), F.max("granted_ms")).first() for b in sink.batches]
    filled = [b for b in by_batch if b[0]]
    assert len(filled) >= 4  # not all at the end
    assert all(a[2] <= b[2] for a, b in zip(filled, filled[1:]))
    later = sink.all().where("granted_ms > t_ms + 5000").count()
    assert later > 50  # requests that waited over several micro-batches


class Held:
    """State of one key in memory; counts the rows of chunks that are read."""

    def __init__(self, *_):
        self.value, self.map, self.reads = None, {}, 0

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def updateValue(self, key, value):
        self.map[key] = value

    def getValue(self, key):
        self.reads += 1
        return self.map[key]

    def removeKey(self, key):
        del self.map[key]

    def clear(self):
        self.value, self.map = None, {}


class Handle:
    def __init__(self):
        self.timers = set()

    def getValueState(self, *_):
        return Held()

    getMapState = getValueState

    def registerTimer(self, ms):
        self.timers.add(ms)


class Now:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms


def played(batches, watermarks):
    """The gate of one host over micro-batches, each followed by the timers its watermark passes; frames by micro-batch and the gate."""
    host = gate._Gate(StructType().add("seq", LongType()).add("host", StringType()).add("t_ms", LongType()).add("gap", LongType()), "host", "t_ms", "gap", "seq", 60_000)
    host.init(handle := Handle())
    out = []
    for rows, mark in zip(batches, watermarks):
        frames = [pd.DataFrame(rows[i : i + 50], columns=["seq", "host", "t_ms", "gap"]) for i in range(0, len(rows), 50)]
        out.append(list(host.handleInputRows(("h",), iter(frames), Now(0))))
        while due := sorted(t for t in handle.timers if t <= mark):
            handle.timers.remove(due[0])
            out[-1] += host.handleExpiredTimer(("h",), Now(mark), None)
    return [[tuple(r) for f in frames for r in f.itertuples(index=False)] for frames in out], host


@pytest.mark.parametrize("seed", range(6))
def test_gate_cuts_queues_into_chunks(monkeypatch, seed):
    monkeypatch.setattr(gate, "CHUNK_ROWS", 7)
    monkeypatch.setattr(gate, "SORTED_ROWS", 100)
    draw = random.Random(seed)
    rows = [(i, "h", draw.randrange(20_000), draw.choice((1, 30, 200))) for i in range(700)]
    rows.sort(key=lambda r: r[2] + draw.randrange(3000))
    batches = [rows[i : i + 140] for i in range(0, 700, 140)] + [[]]
    marks = [min([r[2] for later in batches[i + 1 :] for r in later], default=10**9) - 1 for i in range(6)]
    got, host = played(batches, marks)
    assert [r for batch in got for r in batch] == sorted(served(rows), key=lambda r: r[4])
    assert all(r[4] <= mark for batch, mark in zip(got, marks) for r in batch)
    assert not host.chunks.map and host.runs.value is None


def test_gate_reads_a_long_queue_only_as_far_as_it_runs():
    n = 60 * gate.CHUNK_ROWS
    rows = [(i, "h", i // 1000, 10) for i in range(n)]
    got, host = played([rows] + [[]] * 40, [n // 1000 + 100 * k for k in range(41)])
    assert [r[4] for batch in got for r in batch] == [10 * i for i in range((n // 1000 + 4000) // 10 + 1)]
    assert host.chunks.reads < 200  # the whole queue, each time, would be 2,400


def test_more_events_make_no_more_micro_batches(spark):
    folder = new_path(spark, "many-files")
    columns = ["id as event_id", "timestamp_ntz'2024-01-01 00:00:00' as ts", "id % 40 as user_id", "'view' as event_type", "1D as value", "'' as props"]
    spark.range(1200).selectExpr(*columns).repartition(12).write.parquet(f"{folder}/events.parquet")
    with_files = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        sink = feed.collect_feed(catalog._late_events(spark, folder, closed=True)(), "events")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", with_files)
    assert sink.all().count() == 1201
    assert 4 <= len(sink.batches) <= 5
    assert sink.batch(sink.batches[-1]).where("event_id is null").count() == 1  # the tick comes last
