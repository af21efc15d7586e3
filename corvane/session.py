"""A session with the settings the engine expects; a cluster's own settings win where they are set by spark-submit."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(name: str = "corvane", **conf: str) -> SparkSession:
    settings = {"spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true", "spark.sql.execution.arrow.pyspark.enabled": "true", "spark.ui.showConsoleProgress": "false"}
    return SparkSession.builder.appName(name).config(map=settings | conf).getOrCreate()
