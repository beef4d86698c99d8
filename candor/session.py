"""Session helpers: build a local session for tests/bench, find the checkpoint folder."""

from __future__ import annotations

import ctypes
import gc
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that matter at scale: AQE re-plans shuffles at runtime (partition coalescing,
# skew-join splitting, broadcast conversion from runtime sizes).
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "candor") -> SparkSession:
    """A local session for tests and benchmarks (UI off, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for k, v in SCALE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set("candor.local.slots", str(spark.sparkContext.defaultParallelism))
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's reliable checkpoint folder, which all executors must share.

    That is the one set on the context or in ``spark.checkpoint.dir``. Where neither is set, as in tests, it is a
    folder in the session's warehouse. On a cluster, a warehouse on a local disk is refused: executors don't share it.
    """
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        named = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        if not named and not sc.master.startswith("local") and (warehouse.startswith("file:") or ":/" not in warehouse):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(named or f"{warehouse}/_checkpoints")
    return sc.getCheckpointDir()


def kept(df: DataFrame) -> DataFrame:
    """``df`` written once to the checkpoint folder as compressed columns, and read back: a fraction of a checkpoint's disk."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/kept-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Shuffle files of finished jobs go now; else they stay until the driver happens to collect its garbage."""
    for _ in range(2):  # events that are on their way still hold the plans of their jobs
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(0.5)


def trim() -> None:
    """Memory that a Python worker has freed goes back to the system, as the worker waits beside the tasks of later stages."""
    gc.collect()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass
