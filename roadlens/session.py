"""SparkSession construction and cluster-safe scratch locations."""

from __future__ import annotations

import math
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on. The session zone must be UTC: hour/day parts,
# schedule lookups and the time dimension are all defined on UTC instants.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Streaming session windows merge sessions map-side before the shuffle
    # (batch sessions are bucketed instead, see operators/trajectory.py).
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    # Generated methods above HotSpot's 8000-byte JIT limit run interpreted; at
    # this limit Spark splits such stages instead (3x faster ping validation).
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "roadlens", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the library assumes.

    On a cluster ``master`` is left to spark-submit; tests pass ``local[N]``.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    # getOrCreate on an existing session ignores builder settings, so the
    # run-time SQL settings are applied to it again; a failure is an error.
    apply_sql_conf(spark, conf)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_sql_conf(spark: SparkSession, conf: dict) -> None:
    """Set every run-time SQL setting of ``conf``; static ones belong to the builder."""
    for k, v in conf.items():
        if k.startswith("spark.sql.") and spark.conf.isModifiable(k):
            spark.conf.set(k, v)


def is_local(spark: SparkSession) -> bool:
    """True where driver and executors are one process, so local folders are shared."""
    return re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master) is not None


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only in a one-process ``local`` session may the setting be absent; a fresh
    scratch folder is then created and registered. On a cluster a missing
    setting is an error: a machine-local folder would be written by one
    executor and read, silently empty, by another.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="roadlens-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder name below the shared checkpoint folder.

    Nothing is created here: Spark's writers create it through the file
    system that the path (or the default file system) names.
    """
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system and path object of ``path``, wherever it lies."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` is there, on whatever file system it names."""
    fs, p = file_system(spark, path)
    return fs.exists(p)


def partition_values(spark: SparkSession, root: str, column: str) -> list[str]:
    """Values of the first-level partition folders ``column=value``, from one listing; no file is opened, no job runs."""
    fs, p = file_system(spark, root)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]
    return sorted(n.split("=", 1)[1] for n in names if n.startswith(column + "="))


# Shuffle sizing for cluster runs: target bytes of shuffle data per partition and
# the ratio of shuffled bytes to compressed Parquet input (rows decompress and
# widen; map-side partial aggregation removes copies first).
TARGET_SHUFFLE_PARTITION_BYTES = 256 * 1024 * 1024
SHUFFLE_EXPANSION = 2.0
MIN_SHUFFLE_PARTITIONS = 200
SPARK_DEFAULT_SHUFFLE_PARTITIONS = "200"
# State stores per stateful operator of a stream. The number is baked into a
# stream's checkpoint and every store costs each micro-batch, so it follows
# the cluster's cores, never the size of a batch table.
STATE_STORES_PER_CORE = 2
# Shuffle bytes of a task that sorts a part of a micro-batch for a sink: its rows
# are some ten times that in memory, beside a persisted micro-batch.
STREAM_TASK_BYTES = 16 * 1024 * 1024
ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def shuffle_partitions_for(input_bytes: int) -> int:
    """Initial shuffle partitions for ``input_bytes`` of compressed input (no upper bound)."""
    return max(MIN_SHUFFLE_PARTITIONS, math.ceil(input_bytes * SHUFFLE_EXPANSION / TARGET_SHUFFLE_PARTITION_BYTES))


def input_bytes(df) -> int:
    """Size of a file-based DataFrame's input from the file listing (no job)."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def size_for_input(spark: SparkSession, input_path: str) -> None:
    """Batch shuffle settings from the input's size, only where left at Spark's defaults.

    ``spark.sql.shuffle.partitions`` follows the input, so a 100 TB run does not
    funnel every shuffle through 200 partitions; AQE coalesces small partitions
    and splits skewed ones from there, with its advisory size at the same
    target. The rule is one and the same on every master: it never lowers
    Spark's default and never touches a value that was set.
    """
    conf = spark.conf
    if conf.get("spark.sql.shuffle.partitions") == SPARK_DEFAULT_SHUFFLE_PARTITIONS:
        n = shuffle_partitions_for(input_bytes(spark.read.parquet(input_path)))
        if n > MIN_SHUFFLE_PARTITIONS:
            conf.set("spark.sql.shuffle.partitions", str(n))
            conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(TARGET_SHUFFLE_PARTITION_BYTES))


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream_session(spark: SparkSession, state_partitions: int | None = None) -> SparkSession:
    """A sibling session for streaming queries with its own state settings.

    Its ``spark.sql.shuffle.partitions`` (the number of state stores) is
    ``state_partitions`` or two per core, independent of the batch session's;
    state lives in RocksDB (off-heap, changelog checkpoints), so it is bounded
    by disk, not by executor heap.
    """
    s = spark.newSession()
    apply_sql_conf(s, BASE_CONF)
    n = state_partitions or max(8, STATE_STORES_PER_CORE * spark.sparkContext.defaultParallelism)
    s.conf.set("spark.sql.shuffle.partitions", str(n))
    if not spark.sparkContext.getConf().contains(ADVISORY):
        s.conf.set(ADVISORY, str(STREAM_TASK_BYTES))
    s.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    s.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    # a count of a store's rows costs one more look-up for every row put or removed
    s.conf.set("spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows", "false")
    return s
