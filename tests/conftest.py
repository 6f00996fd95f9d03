import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pressmill.session import configure  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    builder = (
        SparkSession.builder.master("local[8]").appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    )
    session = configure(builder).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def values(spark):
    """Values of one column expression over rows of given columns."""
    def run(rows, schema, column):
        df = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], f"_i int, {schema}")
        return [r["v"] for r in df.select("_i", column.alias("v")).orderBy("_i").collect()]
    return run
