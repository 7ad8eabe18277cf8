import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent.parent / "tools"))


@pytest.fixture(scope="session")
def spark():
    from loomstat.session import local_session

    session = local_session(8, shuffle_partitions=8, app="tests")
    yield session
    session.stop()
