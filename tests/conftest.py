import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
TESTS = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, TESTS)
# the workers import helpers of the test modules; the package itself is shipped
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [TESTS, os.environ.get("PYTHONPATH")]))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    from docenrich.cluster import ship_package

    ship_package(session, os.path.join(ROOT, "checks"))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
