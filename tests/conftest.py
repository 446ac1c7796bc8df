import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def session() -> SparkSession:
    builder = (
        SparkSession.builder.master("local[8]")
        .appName("trolley-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="trolley-warehouse-"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture(scope="session")
def spark():
    return session()


@pytest.fixture(scope="session", autouse=True)
def small_ensembles():
    """A few rounds and trees in the registered model queries: the tests look
    at their results' form, and at models of given settings."""
    from trolley.operators import learn
    from trolley.workspace import Workspace

    for settings in (learn.SUBMIT, learn.CROSS_VALIDATE, learn.CATEGORICAL):
        settings["maxIter"] = 5
    Workspace.trees = 2


@pytest.fixture(scope="session", autouse=True)
def small_search():
    """Few folds and rounds in the registered searches for a number of rounds."""
    from trolley.operators import learn

    learn.SEARCH.update(k=2, max_rounds=5)
    learn.ROUND_SWEEP[:] = [2, 4]
