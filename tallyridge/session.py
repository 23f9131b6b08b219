"""Session factory and the settings every operator relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Wall-clock timestamps are handled as TIMESTAMP_NTZ. A UTC session zone makes the
# NTZ <-> TIMESTAMP casts inside date_trunc and unix_micros an identity.
_RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}
# Recording a Python call site for every column expression slows down plan building.
_STARTUP = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def build_session(app_name: str = "tallyridge", master: str | None = None, **conf: str) -> SparkSession:
    """A session for local use; on a cluster the submit configuration wins."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**_RUNTIME, **_STARTUP, **conf}.items():
        builder = builder.config(key, value)
    return prepare_session(builder.getOrCreate())


def prepare_session(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in _RUNTIME.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def checkpoint_dir(spark: SparkSession, default: str | None = None) -> str | None:
    """Shared folder for checkpoints: the cluster's own setting, else ``default``."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or default
    if folder and spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder
