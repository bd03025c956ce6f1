import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tidemark.session import apply_defaults

    s = (
        SparkSession.builder.master("local[*]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        # compiling code costs more than it saves on a few rows
        .config("spark.sql.codegen.wholeStage", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield apply_defaults(s)
    s.stop()


@pytest.fixture(scope="session")
def steps(spark):
    from workload.steps import Steps

    return Steps(spark, DATA)


def rows(df):
    """Rows as a sorted list of tuples, NULLs first."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [(v is not None, str(v)) for v in r])


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
