import os

import pytest

from mendwork.functions.durable import clear_stages
from mendwork.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", os.environ.get("TEST_CPUS", "8"), shuffle_partitions=8)
    yield session
    clear_stages(session)
    session.stop()
