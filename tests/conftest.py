import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from cargolens.session import get_session, tune  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
        "spark.driver.memory": "6g",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))})
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(autouse=True)
def settings_taken_back(spark):
    """What a table query sets for itself isn't there for the next test."""
    yield
    tune(spark)


@pytest.fixture(scope="session")
def evaluate(spark):
    """Values of a Column function over literal rows of one column ``x``."""
    def run(function, values, kind):
        from pyspark.sql import functions as F
        rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i INT, x {kind}")
        return [r["y"] for r in rows.select("i", function(F.col("x")).alias("y"))
                .orderBy("i").collect()]
    return run
