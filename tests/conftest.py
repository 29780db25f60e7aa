import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from wearline.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session("tests", cores=4, memory="6g", shuffle_partitions=4)


@pytest.fixture
def rows(spark):
    """Evaluate expressions over literal rows and return plain tuples."""
    def run(data, schema, *expressions):
        df = spark.createDataFrame(data, schema)
        return [tuple(r) for r in df.select(*expressions).collect()]

    return run
