import tempfile

import pytest
from llm_rows import DOCUMENT, SMALL, odd_rows
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def llm(spark) -> SparkSession:
    """The session with the operators' settings and a checkpoint folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="llm-test-"))
    from lessonlens.llm.common import prepare

    return prepare(spark)


@pytest.fixture(scope="session")
def documents(llm):
    return llm.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def odd(llm):
    """The odd rows, with further columns whose names the operators use themselves."""
    from pyspark.sql import functions as F

    frame = llm.createDataFrame(odd_rows(), DOCUMENT)
    return frame.withColumns({c: F.lit(1) for c in (
        "fp", "component_id", "score", "label_id", "x", "item_id", "doc", "tie", "z", "runs", "__keep")})


@pytest.fixture(scope="session")
def nothing(llm):
    return llm.createDataFrame([], DOCUMENT)
