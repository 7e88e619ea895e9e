"""Session settings shared by the batch and streaming jobs."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app_name: str = "pressbeat", master: str | None = None, **extra: str) -> SparkSession:
    """A session with adaptive execution, Arrow exchange, Kryo and UTC.

    ``master`` is left to spark-submit unless given.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.serializer", "org.apache.spark.serializer.KryoSerializer")
    builder = builder.config("spark.ui.enabled", "false")
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def local_session(cpus: int | str = 8, **extra: str) -> SparkSession:
    """Session for tests and the benchmark on one machine."""
    settings = {
        "spark.sql.shuffle.partitions": str(cpus),
        "spark.driver.memory": os.environ.get("PRESSBEAT_DRIVER_MEMORY", "12g"),
        "spark.sql.streaming.metricsEnabled": "false",
        **extra,
    }
    spark = build_session(master=f"local[{cpus}]", **settings)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Pin the run-time settings the results depend on in a session built elsewhere."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def derived_session(spark: SparkSession, **settings: str) -> SparkSession:
    """A session of the same application with the settings of ``spark`` and its own on top; ``spark`` keeps what it has."""
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if value is not None and spark.conf.isModifiable(key):
            own.conf.set(key, value)
    for key, value in settings.items():
        own.conf.set(key, value)
    return own
