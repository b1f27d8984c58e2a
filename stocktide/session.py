"""Session settings and the scratch location."""

from __future__ import annotations

import gc
import tempfile
import time
import uuid

from pyspark.sql import SparkSession

# Settings the operators are written for. Skewed joins are split and skewed
# writes rebalanced by adaptive execution; broadcast sides are chosen by Spark
# from measured size (spark.sql.autoBroadcastJoinThreshold), not by hints.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # decided by adaptive execution from the sizes it has measured: broadcast a side up to 64 MB,
    # hash instead of sort-merge where every partition of the build side stays under 64 MB
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    "spark.sql.optimizer.dynamicPartitionPruning.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
    # streams: sessions of one key are merged in each task before the shuffle; state lies on disk, not on the heap
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # no call-site capture per expression: it doubles the driver's cost of building wide plans
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app_name: str = "stocktide", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for written intermediate tables and stream checkpoints.

    A cluster names it in ``spark.checkpoint.dir``. Only a local master, as in
    tests, may fall back to a temporary folder of this machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    return tempfile.mkdtemp(prefix="stocktide-")


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new, not yet existing directory under the scratch root."""
    return f"{scratch_root(spark)}/{purpose}-{uuid.uuid4().hex}"


def release(spark: SparkSession) -> None:
    """Lets Spark drop the shuffle files of plans that nothing refers to any more.

    Two rounds: what the first frees here lets go of the plans on Spark's side, which the second finds.
    """
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.2)
