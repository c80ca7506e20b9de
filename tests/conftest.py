import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent.parent))


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import local_session

    return local_session(4, 4)


@pytest.fixture
def values(spark):
    """Evaluate an expression over a column `x` of the given values."""

    def run(expression, xs, kind="string"):
        df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], f"i int, x {kind}")
        return [r.v for r in df.select("i", expression.alias("v")).orderBy("i").collect()]

    return run
