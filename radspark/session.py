"""Session with the settings the engine relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Settings for any size; partition counts and memory are left to the cluster.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.python.filterPushdown.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}

#: Images are megabytes each: few rows per Arrow batch keep a worker's memory level.
IMAGE_BATCH_ROWS = 16


def build(master: str | None = None, app: str = "radspark", workers: int | None = None, **settings: str) -> SparkSession:
    """A session: ``local`` (one thread), ``multiprocess`` (``workers`` threads) or any master URL."""
    builder = SparkSession.builder.appName(app)
    if master == "local":
        builder = builder.master("local[1]")
    elif master == "multiprocess":
        builder = builder.master(f"local[{workers or '*'}]")
    elif master:
        builder = builder.master(master)
    return builder.config(map=SETTINGS | settings).getOrCreate()
