import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import local_session

    s = local_session("tidemark-tests", cores="*", extra={"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    yield s
    s.stop()
