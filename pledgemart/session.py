"""Session settings the library relies on."""

from __future__ import annotations

import re

from pyspark.sql import SparkSession

# Naive timestamps are UTC; dt stays text; a repeated JSON key keeps its last value.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
}

# Sizes that a session may have smaller, not larger: a task that reads 64 MB of packed shuffle rows, as is the
# default, sorts gigabytes of wide ones, and one that reads 128 MB of a packed file holds as much in its first
# aggregate. Of many partitions AQE makes as few as that size allows.
MOST_BYTES = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": 16 << 20, "spark.sql.files.maxPartitionBytes": 16 << 20}
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
LEAST_PARTITIONS = 400

# Fixed once a session runs, so only a session started here gets it: recording the Python line
# of every column takes a fifth of the time to build these wide plans.
START_SETTINGS = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def configure(spark: SparkSession) -> SparkSession:
    """Put the settings on any session, also one that the library did not start."""
    for key, value in SQL_SETTINGS.items():
        if spark.conf.get(key, None) != value and spark.conf.isModifiable(key):
            spark.conf.set(key, value)
    for key, most in MOST_BYTES.items():
        if _bytes(spark.conf.get(key)) > most:
            spark.conf.set(key, str(most))
    if spark.conf.get(INITIAL_PARTITIONS, None) is None and int(spark.conf.get("spark.sql.shuffle.partitions")) < LEAST_PARTITIONS:
        spark.conf.set(INITIAL_PARTITIONS, str(LEAST_PARTITIONS))
    return spark


_UNITS = {"": 0, "k": 10, "m": 20, "g": 30, "t": 40, "p": 50}


def _bytes(size: str) -> int:
    """A size as Spark writes it: ``67108864b``, ``64m``, ``64MB``."""
    number, unit = re.fullmatch(r"\s*(\d+)\s*([kmgtp]?)b?\s*", str(size).lower()).groups()
    return int(number) << _UNITS[unit]


def build_session(app_name: str = "pledgemart", **settings: str) -> SparkSession:
    """A session with the library's settings; cluster sizing stays with the submitter."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SQL_SETTINGS, **START_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def require_utc(spark: SparkSession) -> None:
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "+00:00", "Z"):
        raise ValueError(f"session time zone must be UTC, not {zone}; call session.configure(spark)")
