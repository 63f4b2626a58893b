"""The live crawl feed: sources, sinks that survive restarts, and running statistics."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlweave.functions import urls
from crawlweave.operators.counters import stats_row
from crawlweave.operators.exports import DISPLAY_CAPACITY, last_n
from crawlweave.operators.lifecycle import lifecycle_states
from crawlweave.operators.skew import dimension_join
from crawlweave.operators.spacing import greedy_spacing
from crawlweave.session import new_path, pin

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def file_feed(spark: SparkSession, folder: str, schema: str, pattern: str, files_per_trigger: int | None = None) -> DataFrame:
    """Stream of the parquet files in ``folder`` that match ``pattern``, oldest first."""
    reader = pin(spark).readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder)


def drain(
    feed: DataFrame,
    on_batch: Callable[[DataFrame, int], None],
    mode: str = "append",
    checkpoint: str | None = None,
    trigger: dict | None = None,
) -> None:
    """Run the stream over what is available now; the state lives in RocksDB, off the heap."""
    spark = feed.sparkSession
    previous = spark.conf.get(STATE_STORE, None)
    spark.conf.set(STATE_STORE, ROCKSDB)
    try:
        query = (
            feed.writeStream.outputMode(mode)
            .option("checkpointLocation", checkpoint or new_path(spark, "stream-checkpoint"))
            .foreachBatch(on_batch)
            .trigger(**(trigger or {"availableNow": True}))
            .start()
        )
        query.awaitTermination()
    finally:
        if previous:
            spark.conf.set(STATE_STORE, previous)
        else:
            spark.conf.unset(STATE_STORE)


class BatchTable:
    """A sink table partitioned by micro-batch; writing a batch again replaces it.

    Give ``path`` to go on with the table of an earlier run, next to the stream's own checkpoint.
    """

    def __init__(self, spark: SparkSession, name: str, schema: str, path: str | None = None):
        self.spark, self.path = spark, path or new_path(spark, name)
        self.schema = f"{schema}, batch bigint"
        self.batches = self._written() if path else []

    def _written(self) -> list[int]:
        try:
            found = self.spark.read.schema(self.schema).parquet(self.path)
        except AnalysisException:  # nothing there yet
            return []
        return sorted(r[0] for r in found.select("batch").distinct().collect())

    def write(self, batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{self.path}/batch={batch_id}")
        if batch_id not in self.batches:
            self.batches.append(batch_id)

    def _versions(self, batches: list[int]) -> DataFrame:
        if not batches:
            return self.spark.createDataFrame([], self.schema)
        # one scan; the filter on the folder column prunes the rest. Asked for are neighbours, so a range names them.
        return self.spark.read.schema(self.schema).parquet(self.path).where(F.col("batch").between(batches[0], batches[-1]))

    def all(self) -> DataFrame:
        return self._versions(self.batches).drop("batch")

    def since(self, count: int) -> DataFrame:
        """Rows of all batches but the first ``count``."""
        return self._versions(self.batches[count:]).drop("batch")

    def batch(self, batch_id: int) -> DataFrame:
        return self._versions([batch_id]).drop("batch")

    def before(self, batch_id: int) -> DataFrame:
        """The newest version older than ``batch_id``, so a repeated batch starts from the same state."""
        return self._versions([b for b in self.batches if b < batch_id][-1:]).drop("batch")

    def latest(self) -> DataFrame:
        """The last complete-mode result or state version."""
        return self._versions(self.batches[-1:]).drop("batch")

    def upserted(self, keys: list[str]) -> DataFrame:
        """Update-mode results: the newest row per key."""
        versions = self._versions(self.batches)
        values = [c for c in versions.columns if c not in (*keys, "batch")]
        newest = versions.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch").alias("__v"))
        return newest.select(*keys, "__v.*")


def schema_of(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def collect_feed(feed: DataFrame, name: str, mode: str = "append", checkpoint: str | None = None) -> BatchTable:
    sink = BatchTable(feed.sparkSession, name, schema_of(feed))
    drain(feed, sink.write, mode, checkpoint)
    return sink


def snapshot_then_tail(feed: DataFrame, sink: BatchTable, checkpoint: str) -> DataFrame:
    """First call: everything the feed holds. Later calls with the same checkpoint: only new rows."""
    before = len(sink.batches)
    drain(feed, sink.write, checkpoint=checkpoint)
    return sink.since(before)


def dedup(feed: DataFrame, url: str = "url") -> DataFrame:
    """Seen set over the whole feed; its state is keyed by address, on disk, and drops nothing for lateness."""
    return feed.dropDuplicates([url])


def running_depths(feed: DataFrame) -> DataFrame:
    return feed.groupBy("depth").agg(F.count(F.lit(1)).alias("pages"))


def running_hosts(feed: DataFrame, key: str = "crawl_id") -> DataFrame:
    """First sight of each (key, host); counting the result is exact and its state is keyed finely."""
    hosts = feed.select(key, urls.live_host(F.col("url")).alias("host")).where(F.col("host") != "")
    return hosts.dropDuplicates([key, "host"])


class HostSketches:
    """Distinct hosts per key by mergeable sketches: each micro-batch writes one sketch per key, reading unites them.

    A sketch has ``2 ** log_size`` registers at most, whatever the number of hosts, and a relative standard error of about
    ``1.04 / sqrt(2 ** log_size)``: 1.6 % for the usual 4,096.
    """

    def __init__(self, spark: SparkSession, key: str = "crawl_id", log_size: int = 12, path: str | None = None):
        self.key, self.log_size = key, log_size
        self.sink = BatchTable(spark, "host-sketches", f"`{key}` bigint, sketch binary", path)

    def step(self, batch: DataFrame, batch_id: int) -> None:
        host = urls.live_host(F.col("url"))
        hosts = batch.select(F.col(self.key).cast("bigint").alias(self.key), F.when(host != "", host).alias("host")).where("host is not null")
        self.sink.write(hosts.groupBy(self.key).agg(F.hll_sketch_agg("host", F.lit(self.log_size)).alias("sketch")), batch_id)

    def run(self, feed: DataFrame, checkpoint: str | None = None) -> DataFrame:
        drain(feed, self.step, checkpoint=checkpoint)
        return self.counts()

    def counts(self) -> DataFrame:
        united = self.sink.all().groupBy(self.key).agg(F.hll_union_agg("sketch").alias("sketch"))
        return united.select(self.key, F.hll_sketch_estimate("sketch").alias("about_hosts"))


def per_second(batch: DataFrame, key: str = "crawl_id", clock: str = "ts") -> DataFrame:
    """Pages per one-second bucket of a batch; counts of several batches add up."""
    second = F.unix_seconds(F.col(clock).cast("timestamp")).alias("second")
    return batch.groupBy(key, second).agg(F.count(F.lit(1)).alias("n"))


def collect_seconds(feed: DataFrame, key: str = "crawl_id", clock: str = "ts", checkpoint: str | None = None) -> DataFrame:
    """Pages per one-second bucket of the feed.

    Each micro-batch writes its own counts and they are added when read, so the stream has no state
    and a late row counts like any other.
    """
    sink = BatchTable(feed.sparkSession, "seconds", f"{schema_of(feed.select(key))}, second bigint, n bigint")
    drain(feed.select(key, clock), lambda batch, number: sink.write(per_second(batch, key, clock), number), checkpoint=checkpoint)
    return sink.all().groupBy(key, "second").agg(F.sum("n").alias("n"))


def sliding_rate(seconds: DataFrame, key: str = "crawl_id", window_s: int = 30) -> DataFrame:
    """Counts and rates of all ``window_s`` windows that start at every second, from one-second buckets."""
    start = F.explode(F.sequence(F.col("second") - (window_s - 1), F.col("second")))
    spread = seconds.select(key, start.alias("window_start"), "n")
    counted = spread.groupBy(key, "window_start").agg(F.sum("n").alias("pages"))
    return counted.withColumn("rate", F.round(F.col("pages") / window_s, 1))


def keep_last(feed: DataFrame, order: str, n: int = DISPLAY_CAPACITY, path: str | None = None, checkpoint: str | None = None) -> DataFrame:
    """Newest ``n`` rows after the feed; each micro-batch merges its own newest into the table."""
    versions = BatchTable(feed.sparkSession, "last-n", schema_of(feed), path)

    def merge(batch: DataFrame, batch_id: int) -> None:
        newest = versions.before(batch_id).unionByName(last_n(batch, order, n))
        versions.write(last_n(newest, order, n), batch_id)

    drain(feed, merge, checkpoint=checkpoint)
    return versions.latest()


def spaced_feed(
    feed: DataFrame, key: str, clock: str, gap: str, order: str, path: str | None = None, checkpoint: str | None = None
) -> DataFrame:
    """Greedy minimum gap per key over a stream: the politeness gate and the rules cache.

    The state is the last grant per key. A micro-batch is resolved by the batch operator, which
    splits hot keys by time, with the state as a grant that precedes the batch. A row that arrives
    with a clock before the state is taken at the state's clock, as if it came now.
    """
    spark = feed.sparkSession
    outcome = f"{schema_of(feed)}, granted boolean, last_grant bigint, wait bigint"
    results = BatchTable(spark, "spaced", outcome, path and f"{path}/rows")
    states = BatchTable(spark, "spaced-state", f"`{key}` string, last_grant bigint", path and f"{path}/state")

    def step(batch: DataFrame, batch_id: int) -> None:
        state = states.before(batch_id)
        known = dimension_join(batch, state.withColumnRenamed("last_grant", "__from"), key, order)
        now = F.greatest(F.col(clock), F.coalesce("__from", F.col(clock)))
        rows = known.select(*batch.columns, now.alias("__now"), F.lit(False).alias("__state"))
        grants = state.select(
            key, F.col("last_grant").alias("__now"), F.lit(1).cast("bigint").alias(gap),
            F.lit(-1).cast("bigint").alias(order), F.lit(True).alias("__state"),
        )
        merged = rows.unionByName(grants, allowMissingColumns=True)
        spaced = greedy_spacing(merged, [key], "__now", F.col(gap), order).where(~F.col("__state"))
        results.write(spaced.select(*batch.columns, "granted", "last_grant", "wait"), batch_id)
        newest = results.batch(batch_id).where(F.col(key).isNotNull()).select(key, "last_grant")
        states.write(state.unionByName(newest).groupBy(key).agg(F.max("last_grant").alias("last_grant")), batch_id)

    drain(feed, step, checkpoint=checkpoint)
    return results.all()


def lifecycle_feed(
    feed: DataFrame, crawl: str = "crawl_id", clock: str = "t_ms", tie: str = "event_id",
    path: str | None = None, checkpoint: str | None = None,
) -> DataFrame:
    """Lifecycle state after every row of a stream of actions, by the batch operator.

    The state of a crawl is handed to the next micro-batch as the actions that lead to it, placed
    before all others (clocks and ties are not negative).
    """
    spark = feed.sparkSession
    results = BatchTable(spark, "lifecycle", f"{schema_of(feed)}, state_before string, state string", path and f"{path}/rows")
    states = BatchTable(spark, "lifecycle-state", f"`{crawl}` bigint, state string", path and f"{path}/state")
    replay = (
        F.when(F.col("state") == "running", F.array(F.lit("start")))
        .when(F.col("state") == "paused", F.array(F.lit("start"), F.lit("pause")))
        .when(F.col("state") == "finished", F.array(F.lit("start"), F.lit("end")))
    )

    def step(batch: DataFrame, batch_id: int) -> None:
        state = states.before(batch_id)
        actions = state.select(crawl, F.lit(-1).cast("bigint").alias(clock), F.posexplode(replay).alias(tie, "action"))
        actions = actions.withColumn(tie, F.col(tie).cast("bigint") - 2)
        rows = lifecycle_states(batch.unionByName(actions, allowMissingColumns=True), crawl, clock, tie)
        results.write(rows.where(F.col(tie) >= 0).select(*batch.columns, "state_before", "state"), batch_id)
        last = results.batch(batch_id).groupBy(crawl).agg(F.max_by("state", F.struct(clock, tie)).alias("state"))
        kept = state.join(last, crawl, "left_anti")
        states.write(kept.unionByName(last), batch_id)

    drain(feed, step, checkpoint=checkpoint)
    return results.all()


def periodic_stats(
    feed: DataFrame, trigger: dict | None = None, path: str | None = None, checkpoint: str | None = None
) -> DataFrame:
    """Counters per crawl after the feed, one stats record per crawl and trigger.

    Each micro-batch adds its own counts to the running ones. In production the trigger is
    ``{"processingTime": "1 second"}``.
    """
    versions = BatchTable(feed.sparkSession, "stats", "crawl_id bigint, state string, rows bigint", path)

    def step(batch: DataFrame, batch_id: int) -> None:
        counts = batch.groupBy("crawl_id", "state").agg(F.count(F.lit(1)).alias("rows"))
        total = counts.unionByName(versions.before(batch_id)).groupBy("crawl_id", "state").agg(F.sum("rows").alias("rows"))
        versions.write(total, batch_id)

    drain(feed, step, checkpoint=checkpoint, trigger=trigger)
    return stats_row(versions.latest(), rows=F.col("rows"))
