"""Session factory with the settings the plans of this library expect."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def session(app: str = "rostrum", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution and UTC; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    } | {k.replace("__", "."): v for k, v in conf.items()}
    return builder.config(map=settings).getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data directory, read lazily."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
