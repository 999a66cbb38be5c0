import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent.parent))

from opinara.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return local_session(8)


@pytest.fixture(scope="session")
def folder():
    return SMALL


@pytest.fixture
def value(spark):
    """Values of an expression over one column ``x`` of given values."""

    def run(values, kind, expression):
        from pyspark.sql import functions as F

        rows = spark.createDataFrame([(n, v) for n, v in enumerate(values)], f"n int, x {kind}")
        return [r.y for r in rows.select("n", expression(F.col("x")).alias("y")).orderBy("n").collect()]

    return run
