"""Session helpers: sane defaults for local tests, cluster settings untouched."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings this library relies on. They are applied only where the session
# does not already define them, so a cluster's own configuration wins.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # many small groups with exact median/percentile: stay hash-based longer
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "4096",
    # AQE merges small shuffle partitions up to this size and splits skewed ones
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
}


def shuffle_partitions_for(input_bytes: int, target_bytes: int = 256 * 1024 * 1024, minimum: int = 200) -> int:
    """A starting ``spark.sql.shuffle.partitions`` for a job reading ``input_bytes``.

    Sized so that a shuffle partition of the widest stage stays near
    ``target_bytes`` before AQE coalescing (100 TB -> about 400k partitions);
    AQE then merges the small ones to the advisory size.
    """
    return max(minimum, -(-int(input_bytes) // int(target_bytes)))


def get_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "loomfeat") -> SparkSession:
    """Build (or reuse) a session. Used by tests, bench and examples."""
    running = SparkSession.getActiveSession()
    if running is not None:  # a session that exists keeps its own settings
        ensure_checkpoint_dir(running)
        return running
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("LOOMFEAT_DRIVER_MEMORY", "16g"))
    )
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder of the cluster.

    ``spark.checkpoint.dir`` is read from the session; only on a local master
    (tests) a private folder is created when it is unset. On a cluster such a
    folder would be another one on each machine, so an unset folder is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="loomfeat-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tables/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and read it back.

    The lineage ends there, and later passes read only the columns that they use.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished jobs now: it does so when their plans are collected."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


@contextmanager
def held(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """``df`` written as by ``written``, for passes that end within the block; the table goes with it."""
    spark, path = df.sparkSession, scratch_dir(df.sparkSession, name)
    try:
        df.write.parquet(path, compression="zstd")
        free_shuffles(spark)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
        free_shuffles(spark)
