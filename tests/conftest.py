import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tremorline.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    scratch = tmp_path_factory.mktemp("shared").as_uri()
    session = local_session(8, "tremorline-tests", "4g", scratch)
    session.conf.set("spark.sql.shuffle.partitions", "3")
    yield session
    session.stop()
