"""Session settings that suit the engine, for jobs that start their own session."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Settings for any deployment; sizes are left to the cluster.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # pages differ in size a hundredfold: small batches keep the parser's memory even
    "spark.sql.execution.arrow.maxRecordsPerBatch": "256",
    # parsing costs far more than reading, so tasks should hold fewer pages than scans do
    "spark.sql.files.maxPartitionBytes": "32m",
    # plans hold large expressions: recording a Python call site for each part is costly
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
}


def builder(app_name: str = "pagetables") -> SparkSession.Builder:
    """A session builder with ``SETTINGS``; master and sizes are the caller's."""
    found = SparkSession.builder.appName(app_name)
    for key, value in SETTINGS.items():
        found = found.config(key, value)
    return found
