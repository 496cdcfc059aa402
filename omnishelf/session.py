"""Session settings the plans rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Correctness: instants become dates in UTC whatever the cluster's zone is.
CORRECTNESS = {"spark.sql.session.timeZone": "UTC"}

# Scale: run-time re-planning, and splitting of hot join partitions even where the split costs one
# more exchange. Broadcasts follow the session's own spark.sql.autoBroadcastJoinThreshold.
SCALE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings to a session that already runs; all of them may change at run time."""
    for key, value in {**CORRECTNESS, **SCALE}.items():
        spark.conf.set(key, value)
    return spark
