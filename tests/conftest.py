import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = os.environ.get("LESSONLENS_TEST_SF", "/root/testdata/sf0.001")
SF_ORACLE = os.environ.get("LESSONLENS_ORACLE_SF", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from lessonlens.session import tune

    import tempfile

    s = (SparkSession.builder.master("local[*]")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="lessonlens-wh-"))
         .config("spark.driver.memory", "8g")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    tune(s)
    yield s


@pytest.fixture(scope="session")
def sources(spark):
    from lessonlens.sources.fixtures import sources_for

    return sources_for(spark, SF_SMALL)


@pytest.fixture(scope="session")
def duck_small():
    from oracle.compare import duck_connect

    return duck_connect(SF_SMALL)
