import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from rinkflow.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(4, shuffle_partitions=4, app_name="tests")
    session.sparkContext.setLogLevel("ERROR")
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    return session


@pytest.fixture
def column(spark):
    """Apply a column function to values: column(function, [values], type)."""

    def apply(function, values, dtype="string"):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
        return [r[0] for r in df.orderBy("i").select(function("v")).collect()]

    return apply
