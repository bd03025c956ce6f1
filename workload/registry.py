"""All registered queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import apply_defaults
from workload import (  # noqa: F401
    bid_queries,
    content_queries,
    core_queries,
    email_queries,
    lookup_queries,
    pixel_queries,
    scoring_queries,
)
from workload.base import ORACLES, RUNNERS, canonical, compose
from workload.steps import Steps


def _runner(fn) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return canonical(fn(Steps(apply_defaults(spark), sf_dir)))

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _runner(fn) for name, fn in RUNNERS.items()}


def oracle_sql() -> dict[str, str]:
    return {name: compose(sql) for name, sql in ORACLES.items()}
