import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerlark.session import local_session
from ledgerlark.sources.lake import Lake


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    session = local_session("tests", 4, **{"spark.checkpoint.dir": shared})
    yield session
    session.stop()


@pytest.fixture
def lake(spark, tmp_path):
    made = Lake(spark, str(tmp_path / "lake"), buckets=4)
    made.create()
    return made
