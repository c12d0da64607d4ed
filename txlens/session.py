"""Session settings and the shared checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings the library relies on. All but the time zone are Spark defaults; they are
# stated because the plans count on them (skewed joins are split at run time).
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(app: str = "txlens", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin the session zone: hour-of-day and weekday features are defined in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's ``spark.checkpoint.dir``; fall back to a temp folder in local mode only."""
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        sc.setCheckpointDir(shared)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="txlens-checkpoint-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
