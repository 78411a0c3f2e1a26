"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime settings every job relies on. UTC keeps instants and the warehouse
# date aligned; local wall time is always derived explicitly.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.streaming.stateless.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # State of streams lives on disk and is written as changes.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cpus: int | str = "*", memory: str = "8g", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and benchmarks; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("gridmill")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of its own: on a cluster a
    machine-local folder would be lost with its executor.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    fallback = tempfile.mkdtemp(prefix="gridmill-")
    sc.setCheckpointDir(fallback)
    return fallback


def scratch(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return os.path.join(shared_dir(spark), "gridmill", f"{label}-{uuid.uuid4().hex[:12]}")


def checkpointed(df):
    """Cut lineage with a reliable checkpoint in the shared folder."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)
