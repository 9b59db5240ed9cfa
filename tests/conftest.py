import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DATA = os.environ.get("GRANTLENS_TESTDATA", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from grantlens.session import local_session

    session = local_session(8, "tests")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    from grantlens.sources.sinks import clear_work

    clear_work(session)
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return DATA
