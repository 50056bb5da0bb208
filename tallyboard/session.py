"""Session settings the jobs rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution splits hot join keys and sizes shuffles from what was really written.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot key costs more than the extra shuffle that splitting it may need.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Tasks keep the first rows of a chart for limits up to that of a series, and send on no others.
    "spark.sql.optimizer.windowGroupLimitThreshold": "10000",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Column calls need no record of the line they came from; keeping it makes wide plans slow to build.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(app: str = "tallyboard", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings above; on a cluster leave ``master`` to spark-submit.

    ``extra`` takes settings with dots written as double underscores, for example
    ``spark__sql__shuffle__partitions="8"``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    for name, value in extra.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()
