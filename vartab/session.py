"""Session helpers: a sensible local session for tests and benches, and a
per-run work folder inside the cluster's shared checkpoint directory."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Defaults that matter for this workload; anything already set by the
# cluster (spark-defaults, --conf) wins because getOrCreate keeps it.
_SQL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "vartab", driver_memory: str = "16g") -> SparkSession:
    """Return the active session, creating a local one when none exists.

    In local mode the driver JVM is also the only executor, so its heap is
    the whole working memory; ``driver_memory`` is applied only there (and
    only when the JVM is started here). On a cluster, executor sizing comes
    from the cluster's own configuration.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        if master.startswith("local") and driver_memory:
            builder = builder.config("spark.driver.memory", driver_memory)
    builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in _SQL_DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Uses what the cluster configured (``spark.checkpoint.dir`` or an
    already-set SparkContext checkpoint dir). Only when neither is set,
    as in a bare local test session, a fresh local folder is created.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        conf_dir = tempfile.mkdtemp(prefix="vartab-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def session_beside(spark: SparkSession, settings: dict[str, str]) -> SparkSession:
    """A session beside ``spark``, with its settings but for ``settings``. Frames read in
    it are planned so; ``spark`` itself, and every other query of it, keeps its own."""
    beside = spark.newSession()
    for key, value in {**spark.conf.getAll, **settings}.items():
        if key.startswith("spark.sql.") and spark.conf.isModifiable(key):
            beside.conf.set(key, value)
    return beside


# A task's share of what is read and shuffled, in packed bytes (less, if the caller says
# so): the stored lines are ten times as long unpacked. And the share of the input that
# gets a shuffle partition of its own, before adaptive execution puts small ones together.
READ_BYTES = SHUFFLE_BYTES = 16 << 20
INPUT_BYTES, MOST_PARTITIONS = 1 << 20, 2000


def shuffle_partitions(spark: SparkSession, input_bytes: int) -> int:
    """Shuffle partitions that grow with the input, so that a task's part of it does not;
    never fewer than ``spark`` has."""
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    own = int(spark.conf.get(key, None) or spark.conf.get("spark.sql.shuffle.partitions"))
    return max(own, min(MOST_PARTITIONS, -(-input_bytes // INPUT_BYTES)))


def planned_bytes(*tables: DataFrame) -> int:
    """Bytes of the files behind ``tables`` (just read, nothing derived)."""
    return sum(int(str(t._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) for t in tables)


def _least(spark: SparkSession, key: str, most: int) -> str:
    jvm = spark.sparkContext._jvm
    return str(min(most, jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key))))


def measured_session(spark: SparkSession) -> SparkSession:
    """A session beside ``spark`` that broadcasts a join side for its measured size only
    and whose tasks hold at most ``READ_BYTES`` and about ``SHUFFLE_BYTES`` of packed input.

    Before anything has run, Spark takes a side to be as large as its packed files and
    every text as 20 bytes: a few MB of Parquet whose rows are made into long texts, or
    multiplied, then pass for small and are gathered in the driver. Adaptive execution
    knows the bytes of a side and still broadcasts what is below the caller's bound."""
    bound = spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold", None) or spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    shares = {"spark.sql.files.maxPartitionBytes": READ_BYTES, "spark.sql.adaptive.advisoryPartitionSizeInBytes": SHUFFLE_BYTES}
    return session_beside(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": bound,
                                  **{k: _least(spark, k, most) for k, most in shares.items()}})


def grow_partitions(spark: SparkSession, input_bytes: int) -> None:
    """Lets a session of its own (``measured_session``) start from ``shuffle_partitions``."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(shuffle_partitions(spark, input_bytes)))


# Tasks that list the folders of a table, however many folders it has. The driver keeps
# a record of every task that has run.
LISTING_TASKS = 256


def listing_session(spark: SparkSession) -> SparkSession:
    """A session beside ``spark`` that lists many folders with at most ``LISTING_TASKS``
    tasks, and not with one for each."""
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    return session_beside(spark, {key: str(min(LISTING_TASKS, int(spark.conf.get(key))))})


CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """What frames of ``spark`` that are made and run in here leave in shuffle files is
    deleted as soon as each of their actions ends, and not when the driver's garbage
    collector comes upon them: a query of several stored steps then holds the shuffles of
    one step at a time. For tables that are written and small results that are collected;
    a frame that is run again later would have to make its shuffles anew."""
    before = spark.conf.get(CLEANUP_CONF, None)
    spark.conf.set(CLEANUP_CONF, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP_CONF)
        else:
            spark.conf.set(CLEANUP_CONF, before)


def work_dir(spark: SparkSession, label: str = "work") -> str:
    """A new, unique (not yet existing) path under the shared checkpoint
    directory; writers create it."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/vartab-{label}-{uuid.uuid4().hex[:12]}"


def drop_path(spark: SparkSession, path: str) -> None:
    """Deletes a folder under the shared checkpoint directory that this program
    wrote and no longer reads; anything else is left alone."""
    if not path.startswith(f"{ensure_checkpoint_dir(spark).rstrip('/')}/vartab-"):
        raise ValueError(f"not a work folder: {path}")
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
