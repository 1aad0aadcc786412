"""Session factory with the settings the operators assume."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build(app: str = "celltrove", master: str | None = None, **more: str) -> SparkSession:
    """A session with SETTINGS; ``more`` takes settings with underscores for dots."""
    builder = SparkSession.builder.appName(app).config(map=SETTINGS | {k.replace("_", "."): v for k, v in more.items()})
    return (builder.master(master) if master else builder).getOrCreate()
