"""Session helpers: settings the operators rely on, and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"

# Dates are compared as calendar days, so the zone is pinned. Adaptive execution picks broadcast
# joins from measured sizes, splits skewed join partitions and merges small ones; no operator
# hints a broadcast by hand.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def spark_session(app_name: str = "tidegauge", master: str | None = None, **settings) -> SparkSession:
    """Get or create a session with the settings above; keyword settings use `_` for `.`."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **{k.replace("_", "."): v for k, v in settings.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def has_checkpoint_dir(spark: SparkSession) -> bool:
    return bool(spark.conf.get(CHECKPOINT_SETTING, None) or spark.sparkContext.getCheckpointDir())


def use_checkpoint_dir(spark: SparkSession) -> str:
    """Point the context at the shared folder the cluster names."""
    folder = spark.sparkContext.getCheckpointDir() or spark.conf.get(CHECKPOINT_SETTING, None)
    if not folder:
        raise ValueError(f"{CHECKPOINT_SETTING} must name a folder that all executors share")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_folder(spark: SparkSession) -> str:
    """The shared folder that the cluster names; in local mode without one, a temporary folder."""
    if not has_checkpoint_dir(spark):
        context = spark.sparkContext
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError(f"{CHECKPOINT_SETTING} must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="tidegauge-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        context.setCheckpointDir(folder)
    return use_checkpoint_dir(spark)


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage by a reliable checkpoint, so that a lost executor loses no finished work."""
    use_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
