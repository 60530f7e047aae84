import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from stationlake.session import get_session

    # the production settings, so that tests see the overwrite modes and the rest as a user does
    yield get_session("local[4]", 8, "stationlake-tests", {
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="stationlake-tests-"), "spark.driver.memory": "6g"})


@pytest.fixture()
def workdir(spark):
    from stationlake.session import shared_dir

    return shared_dir(spark, "test")
