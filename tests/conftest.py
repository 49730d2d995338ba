import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from lakeops.session import build_session
    s = build_session("local[*]", app="lakeops-tests",
                      conf={"spark.sql.shuffle.partitions": "8",
                            "spark.sql.session.timeZone": "UTC",
                            "spark.driver.memory": "4g"})
    yield s
    s.stop()
