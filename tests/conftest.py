import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from crowdspark.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(4, "tests", shuffle_partitions=4)


@pytest.fixture(scope="session")
def rows(spark):
    """Rows of text columns: ``rows("a b", [("1", "2")])``."""
    return lambda columns, values: spark.createDataFrame(values, ", ".join(f"{c} string" for c in columns.split()))
