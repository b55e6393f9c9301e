import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from scorecraft.session import get_spark
    s = get_spark("local[4]", shuffle_partitions=4)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def micro(spark):
    """FIXTURES.md C: x = 1..20, cat A/B/C, y with 12 ones, score s = x/20."""
    y = [0, 0, 1, 0, 1, 0, 0, 1, 1, 0, 1, 0, 1, 1, 1, 0, 1, 1, 1, 1]
    rows = [(float(i), "A" if i <= 6 else "B" if i <= 13 else "C", float(y[i - 1]), i / 20.0) for i in range(1, 21)]
    return spark.createDataFrame(rows, "x double, cat string, y double, s double")
