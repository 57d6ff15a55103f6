import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from recurra.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = local_session(cores="*", shuffle_partitions=8, app="recurra-tests",
                      warehouse=str(tmp_path_factory.mktemp("warehouse")))
    yield s
    s.stop()
