import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tools")]


@pytest.fixture(scope="session")
def spark():
    from tidewatch.session import local_session

    session = local_session("*", shuffle_partitions=4)
    yield session
    session.stop()
