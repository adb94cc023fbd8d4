"""The session that every entry point uses."""

from __future__ import annotations

from pyspark.sql import SparkSession


def get_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """UTC, ANSI and adaptive execution; anything else comes from the cluster or from conf."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    fixed = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.showConsoleProgress": "false",
    }
    return builder.config(map=fixed | conf).getOrCreate()
