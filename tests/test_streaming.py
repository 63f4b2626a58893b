"""Streams over several micro-batches give the batch result."""

import pytest
from pyspark.sql import functions as F

from crawlweave.operators import counters, exports, lifecycle, robots
from crawlweave.operators.spacing import greedy_spacing
from crawlweave.plans import inputs
from crawlweave.session import new_path
from crawlweave.sources import tables, topics
from crawlweave.streaming import feed, live, rules_cache

PARTS = 4


@pytest.fixture(scope="module")
def folder(spark, sf, tmp_path_factory):
    """The events as several files that arrive in time order."""
    out = tmp_path_factory.mktemp("feed")
    pdf = inputs.events(spark, sf).toPandas().sort_values("event_id")
    size = -(-len(pdf) // PARTS)
    for i in range(PARTS):
        path = out / f"events-{i}.parquet"
        pdf.iloc[i * size : (i + 1) * size].to_parquet(path, coerce_timestamps="us", index=False)
        import os

        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))
    return str(out)


@pytest.fixture(scope="module")
def batch(spark, sf):
    return inputs.crawl_log(spark, sf)


def rows_of(spark, folder):
    return feed.file_feed(spark, folder, tables.EVENTS_SCHEMA, "events-*.parquet", files_per_trigger=1)


def log_of(spark, folder):
    return inputs.crawl_log_of(rows_of(spark, folder))


def same(left, right):
    assert sorted(map(tuple, left.collect()), key=repr) == sorted(map(tuple, right.select(*left.columns).collect()), key=repr)


def test_feed_arrives_in_batches(spark, folder, batch):
    sink = feed.collect_feed(log_of(spark, folder).select("seq", "depth", "url"), "feed")
    assert len(sink.batches) == PARTS
    same(sink.all(), batch)


def test_depths(spark, folder, batch):
    sink = feed.collect_feed(feed.running_depths(log_of(spark, folder)), "depths", "complete")
    same(sink.latest(), counters.depth_counts(batch))


def test_hosts(spark, folder, batch):
    sink = feed.collect_feed(feed.running_hosts(log_of(spark, folder)), "hosts")
    same(sink.all().groupBy("crawl_id").agg(F.count("host").alias("unique_hosts")), counters.unique_hosts(batch, "crawl_id"))
    about = feed.HostSketches(spark).run(log_of(spark, folder))
    exact = {r[0]: r[1] for r in counters.unique_hosts(batch, "crawl_id").collect()}
    assert all(abs(r[1] - exact[r[0]]) <= 0.1 * exact[r[0]] + 1 for r in about.collect())


def test_rate(spark, folder, batch):
    windows = feed.sliding_rate(feed.collect_seconds(log_of(spark, folder)))
    per_window = batch.groupBy("crawl_id", F.window("ts", "30 seconds", "1 second").alias("w")).agg(F.count(F.lit(1)).alias("pages"))
    want = per_window.select("crawl_id", F.unix_seconds("w.start").alias("window_start"), "pages")
    same(windows.select("crawl_id", "window_start", "pages"), want)


def test_last_n(spark, folder, batch):
    same(feed.keep_last(log_of(spark, folder).select("seq", "url"), "seq", 70), exports.last_n(batch.select("seq", "url"), "seq", 70))


def test_throttle_carries_state(spark, folder, batch):
    hour = F.lit(3_600_000).cast("bigint")
    stream = log_of(spark, folder).select("seq", "host", "t_ms", hour.alias("gap"))
    got = feed.spaced_feed(stream, "host", "t_ms", "gap", "seq")
    same(got.drop("gap"), greedy_spacing(batch.select("seq", "host", "t_ms"), ["host"], "t_ms", hour, "seq"))


def test_lifecycle_carries_state(spark, sf, folder):
    got = feed.lifecycle_feed(inputs.lifecycle_of(rows_of(spark, folder)))
    same(got, lifecycle.lifecycle_states(inputs.lifecycle(spark, sf)))


def test_stats_add_up(spark, folder, batch):
    state = F.when(F.col("depth") == 0, "failed").otherwise("processed")
    got = feed.periodic_stats(log_of(spark, folder).select("crawl_id", state.alias("state")))
    same(got, counters.stats_row(batch.select("crawl_id", state.alias("state"))))


def test_dedup_within_watermark(spark, folder, batch):
    got = feed.collect_feed(feed.dedup(log_of(spark, folder).select("url", "ts", "seq")), "dedup").all()
    assert got.count() == batch.select("url").distinct().count()


def test_sketches_of_many_hosts_stay_within_their_error(spark):
    rows = spark.range(60_000).selectExpr("id % 2 as crawl_id", "concat('http://h', if(id % 2 = 0, id, id % 700), '.org/') as url")
    sketches = feed.HostSketches(spark)
    for number, part in enumerate(rows.randomSplit([1.0] * 5, 3)):
        sketches.step(part, number)
    sketches.step(rows.limit(0), 5)
    got = {r.crawl_id: r.about_hosts for r in sketches.counts().collect()}
    assert abs(got[0] / 30_000 - 1) < 0.05 and abs(got[1] / 350 - 1) < 0.05


def test_live_stats_are_published_while_the_stream_runs(spark, folder, batch):
    state = F.when(F.col("depth") == 0, "failed").otherwise("processed")
    path = new_path(spark, "growing")
    log = batch.select("crawl_id", "t_ms", state.alias("state"))
    log.where("t_ms % 2 = 0").write.parquet(path)
    stream = spark.readStream.schema("crawl_id bigint, t_ms bigint, state string").parquet(path)
    hour = 3_600_000
    running = live.start_stats(stream, interval_ms=hour, trigger={"processingTime": "0 seconds"})
    try:
        running.query.processAllAvailable()
        half = running.rows().agg(F.sum("processed")).first()[0]
        assert running.query.isActive and half > 0
        log.where("t_ms % 2 = 1").write.mode("append").parquet(path)
        running.query.processAllAvailable()
        rows = running.rows().collect()
        assert running.query.isActive
    finally:
        running.query.stop()
    want = {}
    for crawl, t, kind in [tuple(r) for r in log.collect()]:
        want.setdefault(crawl, []).append((t // hour, kind))
    for crawl, seen in want.items():
        own = sorted((r for r in rows if r.crawl_id == crawl), key=lambda r: r.until_ms)
        first, last = min(seen)[0], max(seen)[0]
        assert [r.until_ms for r in own] == [(t + 1) * hour for t in range(first, last + 1)]
        for r in own:
            assert (r.processed, r.failed) == tuple(sum(t < r.until_ms // hour and k == kind for t, k in seen) for kind in ("processed", "failed"))
    assert rows[0].stats.startswith('{"queue":0,"inFlight":0,"rejected":0,"failed":')


def test_rules_cache_over_micro_batches_equals_the_as_of_join(spark):
    """Mixed order within a minute, a hot site, files that change while a copy is in force, a bad address."""
    import random

    draw, minute = random.Random(2), 60_000
    bodies = ["User-agent: *\nDisallow: /a", "User-agent: *\nDisallow: /b\nAllow: /b/c", "User-agent: crawlbot\nDisallow: /"]
    sites = ["http://hot.org"] * 4 + ["http://b.org", "http://c.org"]
    asked = [(i, draw.choice(sites) + draw.choice(["/a", "/b", "/b/c", ""]), draw.randrange(1, 200 * minute)) for i in range(600)] + [(600, "no address", 5 * minute)]
    files = [(draw.choice(sites[:5]), draw.randrange(0, 200 * minute), draw.choice([200, 200, 404]), draw.choice(bodies)) for _ in range(40)]
    schemas = "seq bigint, url string, t_ms bigint", "base_url string, served_ms bigint, status int, body string"
    paths = [new_path(spark, "asked"), new_path(spark, "served")]
    tick = 10**9
    for rows, at, schema, path, end in ((asked, 2, schemas[0], paths[0], (None, "http://tick.org/", tick)), (files, 1, schemas[1], paths[1], ("http://tick.org", tick, 200, ""))):
        rows = sorted(rows, key=lambda r: r[at] + draw.randrange(minute))
        for k in range(4):
            spark.createDataFrame(rows[k::4] if k < 0 else rows[k * len(rows) // 4 : (k + 1) * len(rows) // 4], schema).coalesce(1).write.mode("append").parquet(path)
        spark.createDataFrame([end], schema).coalesce(1).write.mode("append").parquet(path)
    streams = [feed.file_feed(spark, p, s, "*.parquet", files_per_trigger=1) for p, s in zip(paths, schemas)]
    judged = rules_cache.judged_feed(*streams, agent="crawlbot", lateness="70 minutes")
    got = feed.collect_feed(judged, "judged")
    assert len(got.batches) >= 4
    want = robots.rules_in_force(spark.createDataFrame(asked, schemas[0]), spark.createDataFrame(files, schemas[1]), "crawlbot", "t_ms", "seq")
    columns = ["seq", "base_url", "refetched", "rules_fetched_ms", "served_ms", "allowed"]
    same(got.all().where("seq is not null").select(*columns), want.select(*columns))


def test_snapshot_then_only_new_rows(spark):
    path, checkpoint, schema = new_path(spark, "sink"), new_path(spark, "cp"), "seq bigint, value string"
    spark.createDataFrame([(1, "a"), (2, "b")], schema).write.parquet(path)
    sink = feed.BatchTable(spark, "tail", schema)
    read = lambda: feed.snapshot_then_tail(spark.readStream.schema(schema).parquet(path), sink, checkpoint)
    assert sorted(r[0] for r in read().collect()) == [1, 2]
    spark.createDataFrame([(3, "c")], schema).write.mode("append").parquet(path)
    assert [r[0] for r in read().collect()] == [3]
    assert read().count() == 0


def test_table_of_an_earlier_run_goes_on(spark, folder, batch):
    path, checkpoint = new_path(spark, "stats"), new_path(spark, "cp")
    stream = lambda: log_of(spark, folder).select("crawl_id", F.lit("processed").alias("state"))
    feed.periodic_stats(stream(), path=path, checkpoint=checkpoint)
    again = feed.periodic_stats(stream(), path=path, checkpoint=checkpoint)
    same(again, counters.stats_row(batch.select("crawl_id", F.lit("processed").alias("state"))))


def test_topic_options():
    env = {"KAFKA_SSL_TRUSTSTORE_LOCATION": "/t.jks", "KAFKA_SSL_STORE_PASSWORD": "pw"}
    sink, source = topics.sink_options("b:1", "t", env), topics.source_options("b:1", "t", env)
    assert sink["kafka.acks"] == "1" and sink["topic"] == "t" and source["subscribe"] == "t"
    assert source["startingOffsets"] == "latest"
    for options in (sink, source):
        assert options["kafka.security.protocol"] == "SSL"
        assert options["kafka.ssl.truststore.location"] == "/t.jks"
        assert options["kafka.ssl.endpoint.identification.algorithm"] == "https"
    assert topics.tls_options({})["kafka.ssl.truststore.location"] == "certs/kafka.truststore.jks"


def test_topic_frame(spark):
    df = spark.createDataFrame([(2, "http://h/a|b")], "depth int, url string")
    assert tuple(topics.topic_messages(df).first()) == ("2|http://h/a|b", "2|http://h/a|b")
