import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from fraudlens.session import get_session
    s = get_session("local[*]", app="fraudlens-tests",
                    conf={"spark.sql.shuffle.partitions": "8"})
    yield s
    s.stop()


@pytest.fixture
def scratch(spark):
    from fraudlens.session import shared_dir
    return lambda name: shared_dir(spark, name)
