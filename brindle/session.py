"""A session with the settings that the engine assumes."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(app: str = "brindle", **conf: str) -> SparkSession:
    """UTC session zone, ANSI arithmetic, adaptive execution, checkpoint files that go with their last use; anything in `conf` wins."""
    settings = {"spark.sql.session.timeZone": "UTC", "spark.sql.ansi.enabled": "true", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true", "spark.cleaner.referenceTracking.cleanCheckpoints": "true"} | conf
    builder = SparkSession.builder.appName(app)
    for k, v in settings.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()
