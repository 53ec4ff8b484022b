"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every query relies on. Days are cut in UTC. Adaptive execution picks the
# join side to broadcast from measured sizes and splits skewed join partitions, also where the
# split costs an extra exchange (a hot machine joined and then grouped on the same key).
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}

# Settings only a new session takes. Call sites for error messages cost several JVM round trips
# per column expression.
START_CONF = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


# Shuffles on a cluster start with this many partitions per core, or as many as the input needs; adaptive
# execution merges those that turn out small. The default of 200 would never be raised.
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
PARTITIONS_PER_CORE = 4
MIN_PARTITIONS = 2_000
# What one of them should hold at most when the whole input is shuffled.
PARTITION_BYTES = 128 << 20


def initial_partitions(cores: int, input_bytes: int = 0) -> int:
    return max(cores * PARTITIONS_PER_CORE, MIN_PARTITIONS, -(-input_bytes // PARTITION_BYTES))


def configure(spark: SparkSession, input_bytes: int = 0) -> SparkSession:
    """Apply the runtime settings to an existing session; an own partition number is kept.

    A job that knows the size of what it shuffles passes it; partitions then follow it.
    """
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    local = spark.sparkContext.master.startswith("local")
    if not local and spark.conf.get(INITIAL_PARTITIONS, None) is None:
        cores = spark.sparkContext.defaultParallelism
        spark.conf.set(INITIAL_PARTITIONS, str(initial_partitions(cores, input_bytes)))
    return spark


def build_session(app_name: str, **conf: str) -> SparkSession:
    """Session for a job submitted to a cluster; master and sizes come from spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**RUNTIME_CONF, **START_CONF, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder all executors can reach.

    The cluster names the shared folder in ``spark.checkpoint.dir``. Only a local session
    without that setting falls back to a temporary folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder shared by the cluster")
        root = tempfile.mkdtemp(prefix="rigpulse-")
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def saved(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """The frame's rows as they are now, read back from the shared folder."""
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
