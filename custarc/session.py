"""Spark session settings the models are tuned for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution picks join strategies from measured sizes and splits oversized join
# partitions. All of these can be set on a running session.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

# Only when the session is built: without the debugging option Python does not record the
# call site of every column expression, which takes longer than planning these models.
BUILD_SETTINGS = {
    "spark.ui.enabled": "false",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session that already exists."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def session(
    app: str = "custarc", master: str | None = None, settings: dict[str, str] | None = None
) -> SparkSession:
    """Build (or get) a tuned session; ``settings`` override the defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_SETTINGS, **BUILD_SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
