"""Session settings for the reports."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # epoch seconds become dates in this zone
    "spark.sql.session.timeZone": "UTC",
    # joins choose by the sizes that a run finds, and split hot keys
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # hash join instead of two sorts where every partition of one side is this small
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    # rounds of the ranking leave checkpoints behind; drop them when nothing reads them
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def configured(builder: SparkSession.Builder) -> SparkSession.Builder:
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder
