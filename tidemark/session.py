"""Session defaults: adaptive execution, UTC, skew splitting."""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # hot addresses, pages and companies: split their partitions in joins
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a join may be split even if its output has to be shuffled again
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Set the runtime options the operators are written for."""
    for key, value in DEFAULTS.items():
        spark.conf.set(key, value)
    return spark


def session(name: str = "tidemark") -> SparkSession:
    """Session of the surrounding cluster (``spark-submit``) with the defaults applied."""
    return apply_defaults(SparkSession.builder.appName(name).getOrCreate())
