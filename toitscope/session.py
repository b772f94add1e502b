"""Session settings the jobs rely on, and the shared folder for files between steps."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Split a hot key's partition even when a later step needs another shuffle for it.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Department codes are text ("06", "2A"): never let folder names become numbers.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}

OWN_FOLDER = "spark.toitscope.shared.dir"


def build_session(
    app: str = "toitscope", master: str | None = None, settings: dict[str, str] | None = None
) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``, or else by ``name_shared_folder``.

    An error when neither names one.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(OWN_FOLDER, None)
    if not named:
        raise ValueError("set spark.checkpoint.dir to a folder shared by the driver and all executors")
    return named.rstrip("/")


def name_shared_folder(spark: SparkSession) -> str:
    """For callers whose session sets none (Spark takes that setting at its start only): a folder in its warehouse.

    On a cluster the warehouse has to be one that all machines reach: a local folder is an error.
    """
    if not spark.conf.get("spark.checkpoint.dir", None):
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        local = warehouse.split(":")[0] in ("file", warehouse)
        if local and spark.conf.get("spark.master", "local").split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder shared by the driver and all executors")
        spark.conf.set(OWN_FOLDER, f"{warehouse}/shared")
    return shared_folder(spark)
