"""A session with the settings that the engine relies on: ANSI casts, UTC, adaptive plans."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def session(master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName("hearken")
    if master:
        builder = builder.master(master)
    for key, value in (SETTINGS | {k.replace("_", "."): v for k, v in extra.items()}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
