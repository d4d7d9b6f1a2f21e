import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).parent.parent))


@pytest.fixture(scope="session")
def spark():
    session = (SparkSession.builder.master("local[4]").appName("tests")
               .config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
               .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def numeric(spark):
    return spark.createDataFrame(
        [("0", 1.0, 2.0, 3.0), ("1", 1.0, 1.0, 1.0), ("2", 2.0, 3.0, 4.0), ("3", 0.0, 0.0, 0.0)],
        "id string, c0 double, c1 double, c2 double")


@pytest.fixture(scope="session")
def grouped(spark):
    return spark.createDataFrame(
        [("a", "A", 1, 2), ("b", "A", 5, 10), ("c", "A", 2, 4), ("d", "B", 2, 1),
         ("e", "B", 1, 1), ("f", "B", 2, 2), ("g", "C", 9, 4), ("h", "D", 0, 0)],
        "id string, group string, X long, Y long")


@pytest.fixture(scope="session")
def missing(spark):
    return spark.createDataFrame(
        [("0", 1.0, 2.0, 3.0), ("1", None, None, None), ("2", 2.0, None, 4.0), ("3", 0.0, 0.0, None)],
        "id string, c0 double, c1 double, c2 double")
