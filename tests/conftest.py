import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from strata.session import get_session

    scratch = tempfile.mkdtemp(prefix="strata-tests-")
    s = get_session(
        master="local[4]",
        app_name="strata-tests",
        shuffle_partitions=4,
        extra_conf={"spark.checkpoint.dir": scratch, "spark.driver.memory": "4g"},
    )
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    from strata.session import new_scratch_path

    return lambda name="t": new_scratch_path(spark, name)
