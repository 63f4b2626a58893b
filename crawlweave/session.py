"""Session set-up and the shared folder for intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_CONF = "spark.checkpoint.dir"
_FREE_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app: str = "crawlweave", master: str | None = None, **conf: str) -> SparkSession:
    """Create a session with the settings the operators were tuned for.

    On a cluster leave ``master`` unset and let spark-submit decide; adaptive execution sizes the
    shuffle partitions, coalesces small ones, splits skewed ones and broadcasts a join side only
    when its measured size is below the threshold.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin(spark: SparkSession) -> SparkSession:
    """All epoch arithmetic assumes that zone-less timestamps are UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, taken from ``spark.checkpoint.dir``.

    A local session without that setting gets a folder below its warehouse; on a cluster a missing
    setting is an error, because a machine-local folder would not survive a lost executor.
    """
    context = spark.sparkContext
    configured = spark.conf.get(_CHECKPOINT_CONF, None) or context.getConf().get(_CHECKPOINT_CONF, None)
    folder = configured or context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise ValueError(f"set {_CHECKPOINT_CONF} to a folder shared by all executors")
    warehouse = (spark.conf.get("spark.sql.warehouse.dir", None) or "spark-warehouse").rstrip("/")
    context.setCheckpointDir(f"{warehouse}/shared-{uuid.uuid4().hex}")
    return context.getCheckpointDir()


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, free: bool = False) -> DataFrame:
    """Write ``df`` as a columnar table in the shared folder and return the table.

    This cuts the lineage of iterative jobs: a lost executor costs a re-read, not a recomputation
    of earlier rounds, and the file sizes give the planner real statistics. With ``free`` Spark removes
    the shuffle files of the write as soon as the table is there.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    before = spark.conf.get(_FREE_CONF, None)
    if free:
        spark.conf.set(_FREE_CONF, "true")
    try:
        df.write.parquet(path)
    finally:
        if free:
            spark.conf.unset(_FREE_CONF) if before is None else spark.conf.set(_FREE_CONF, before)
    return spark.read.schema(df.schema).parquet(path)
