import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from grantflow.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """Evaluate a column over given text values."""
    from pyspark.sql import functions as F

    def run(build, values, type_name="string"):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {type_name}")
        rows = df.select("i", build(F.col("v")).alias("out")).orderBy("i").collect()
        return [r.out for r in rows]

    return run
