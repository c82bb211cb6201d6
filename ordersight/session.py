"""Session defaults the library is written for."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app_name: str = "ordersight", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC dates, ANSI casts and adaptive execution.

    Cluster settings (executors, memory, ``spark.checkpoint.dir``) come from
    spark-submit; extra keyword settings use ``__`` for ``.`` and win over the
    defaults below.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        # A table bucketed by order_id then meets (order_id, line) without a shuffle.
        "spark.sql.requireAllClusterKeysForCoPartition": "false",
        # Building a column costs fewer calls to the JVM without call-site records.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
